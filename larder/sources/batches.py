"""Idempotent appends of several tables at once.

A batch is written table by table under ``<base>/<table>/batch=<id>``, and last a manifest ``<base>/manifest/batch=<id>`` with the row counts. Readers take the batches
that have a manifest, so a batch whose writer failed between two tables is not seen; a rerun with the same id replaces what it left. A batch that has its
manifest is done, and appending it again changes nothing. Every path is written by Spark, so any store that Spark writes to will do, and no server is needed.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.sources.staging import delete, exists

#: The tables of the survey database.
TABLES = ("hh_information", "food_group", "food_consumption", "fct", "base_ai", "ml_targets")
MANIFEST = "manifest"


def _place(base: str, table: str, batch_id: str) -> str:
    return f"{base.rstrip('/')}/{table}/batch={batch_id}"


def committed(spark: SparkSession, base: str) -> DataFrame:
    """(batch, table, rows) of all batches that are whole."""
    folder = f"{base.rstrip('/')}/{MANIFEST}"
    if not exists(spark, folder):
        return spark.createDataFrame([], "batch string, table string, rows bigint")
    # only folders with Spark's mark of a finished write count, the write of a manifest may have failed as well
    names = [row.batch for row in spark.read.schema("table string, rows bigint").json(folder).select(F.col("batch").cast("string")).distinct().collect()]
    whole = [f"{folder}/batch={name}" for name in sorted(names) if exists(spark, f"{folder}/batch={name}/_SUCCESS")]
    if not whole:
        return spark.createDataFrame([], "batch string, table string, rows bigint")
    found = spark.read.option("basePath", folder).schema("table string, rows bigint, batch string").json(whole)
    return found.select("batch", "table", "rows")


def append(base: str, batch_id: str, tables: Mapping[str, DataFrame], replace: bool = False) -> bool:
    """Append the tables as one batch; False if the batch was there already. ``replace`` writes a finished batch anew.

    ``batch_id`` holds letters, digits, ``-`` and ``_`` and is not a number, as it names folders. Row counts come from the jobs that write the rows.
    """
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_-]*", batch_id):
        raise ValueError(f"not a batch id: {batch_id!r}")
    if not tables:
        raise ValueError("a batch needs a table")
    spark = next(iter(tables.values())).sparkSession
    mark = _place(base, MANIFEST, batch_id)
    if exists(spark, f"{mark}/_SUCCESS"):
        if not replace:
            return False
        delete(spark, mark)  # from here on the batch is open again
    counts = []
    for name, df in tables.items():
        observation = Observation()
        df.observe(observation, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(_place(base, name, batch_id))
        counts.append((name, observation.get["rows"]))
    spark.createDataFrame(counts, "table string, rows bigint").coalesce(1).write.mode("overwrite").json(mark)
    return True


def read(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A table of all whole batches, with its ``batch``."""
    batches = [row.batch for row in committed(spark, base).filter(F.col("table") == table).orderBy("batch").collect()]
    if not batches:
        raise FileNotFoundError(f"no whole batch holds {table} under {base}")
    return spark.read.option("basePath", f"{base.rstrip('/')}/{table}").parquet(*[_place(base, table, b) for b in batches])
