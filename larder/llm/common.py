"""What the operators share: the definition of a word, intermediate tables, and small column helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but ASCII white space. ``bytes.split()`` cuts at exactly these six characters.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only for a local session that names none."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="larder-llm-"))
    return spark.sparkContext.getCheckpointDir()


def stage(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, a lost executor costs nothing, its size is known."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return freed memory to the system; allocators would hold it for the process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` with the memory it has freed given back at the end of its task. Workers are kept for later tasks, of other operators too, and what
    allocators hold back of one task adds to what the next one needs."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to ``value``, which is evaluated once per row however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """The words of a text as an array; none for a null text."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed != "", F.split(trimmed, BLANK_CLASS + "+")).otherwise(F.array().cast("array<string>"))


def with_rows(df: DataFrame, row: str = "row") -> DataFrame:
    """Every column of ``df`` in one struct, so that no name of its can clash with a column an operator adds."""
    return df.select(F.struct(*[df[f"`{c.replace('`', '``')}`"] for c in df.columns]).alias(row))
