"""Scans and sinks: CSV with ``NA`` for missing, parquet, named surveys, partitioned append, JDBC append."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.missing import nan_to_null, to_integer, to_number
from larder.functions.reference import COMPOSITION_COLUMNS

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType()}


def schema_of(**columns: str) -> T.StructType:
    """Schema from column names and type names."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


HH_INFO_SCHEMA = schema_of(
    hhid="string", adm1="string", adm2="string", res="string", sep_quintile="int", res_quintile="int", age_head="int",
    sex_head="string", educ_head="string", year="int", month="int", survey_wgt="double", afe="double", ea="int",
)
FOOD_CONSUMPTION_SCHEMA = schema_of(
    hhid="string", item_code="bigint", quantity_100g="double", food_group="string", quantity_g="double"
)
FCT_SCHEMA = schema_of(
    item_code="bigint", item_name="string", **{name: "double" for name in COMPOSITION_COLUMNS.values()}
)
BASE_AI_SCHEMA = schema_of(hhid="string", **{name: "double" for name in COMPOSITION_COLUMNS.values()})


class Survey(NamedTuple):
    """The three tables of one named survey."""

    hh_info: DataFrame
    food_consumption: DataFrame
    fct: DataFrame


def read_csv_na(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; ``NA``, blank and quoted-blank fields are NULL.

    Columns are matched by header name, so a file may hold more columns and in any order; the files of one folder must have
    one header, or the read fails. Text that does not parse as the declared type, and NaN, become NULL.
    """
    raw = spark.read.options(header=True, nullValue="NA", emptyValue="NA", enforceSchema=False).csv(path)

    def typed(field: T.StructField):
        if field.dataType == T.DoubleType():
            return to_number(field.name).alias(field.name)
        if field.dataType in (T.IntegerType(), T.LongType()):
            return to_integer(field.name, field.dataType.simpleString()).alias(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return raw.select(*[typed(f) for f in schema.fields])


def write_csv_na(df: DataFrame, path: str) -> None:
    """CSV with a header and ``NA`` for NULL."""
    df.write.mode("overwrite").options(header=True, nullValue="NA").csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return read_csv_na(spark, path, schema)
    df = spark.read.format(fmt).schema(schema).load(path)
    return df.withColumns({f.name: nan_to_null(f.name) for f in schema.fields if f.dataType == T.DoubleType()})


def household_data(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """The household table of a named survey."""
    return read_table(spark, f"{base}/{name}_hh_info", HH_INFO_SCHEMA, fmt)


def load_survey(spark: SparkSession, base: str, name: str, fmt: str = "parquet", fct_schema=FCT_SCHEMA) -> Survey:
    """The household, consumption and composition tables of a named survey."""
    return Survey(
        household_data(spark, base, name, fmt),
        read_table(spark, f"{base}/{name}_food_consumption", FOOD_CONSUMPTION_SCHEMA, fmt),
        read_table(spark, f"{base}/{name}_fct", fct_schema, fmt),
    )


def save_survey(survey: Survey, base: str, name: str, fmt: str = "parquet") -> None:
    """Write the three tables where ``load_survey`` finds them."""
    for table, df in zip(Survey._fields, survey):
        path = f"{base}/{name}_{table}"
        if fmt == "csv":
            write_csv_na(df, path)
        else:
            df.write.mode("overwrite").format(fmt).save(path)


def save_base_ai(base_ai: DataFrame, base: str, name: str, fmt: str = "parquet") -> None:
    """Write the intake table of a named survey where ``load_base_ai`` finds it."""
    path = f"{base}/{name}_base_ai"
    if fmt == "csv":
        write_csv_na(base_ai, path)
    else:
        base_ai.write.mode("overwrite").format(fmt).save(path)


def load_base_ai(spark: SparkSession, base: str, name: str, fmt: str = "parquet", schema=BASE_AI_SCHEMA) -> DataFrame:
    """The intake table of a named survey."""
    return read_table(spark, f"{base}/{name}_base_ai", schema, fmt)


def write_ordered(df: DataFrame, path: str, order_by: Sequence[Column], rows_per_file: int = 1_000_000) -> None:
    """Write ``df`` so that ``read_ordered`` gives its rows back in order, whatever their number.

    Rows are dealt by ranges of the order and of all other columns after it, so that many rows equal in the order don't land in one task,
    and sorted there. Each row keeps its range and its place in it; a file holds at most ``rows_per_file`` rows.
    """
    clash = {"__range", "__place"} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are used for the order")
    rest = [F.col(f"`{c}`") for c, kind in df.dtypes if not kind.startswith("map")]
    ordered = df.orderBy(*order_by, *rest).withColumns(
        {"__range": F.spark_partition_id(), "__place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    )
    ordered.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def read_ordered(spark: SparkSession, path: str, row_order: str = "row_order") -> DataFrame:
    """The rows of ``write_ordered`` with their number in the order, from 0. The rows before each range are a sum over one small row per range."""
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("__range", (F.sum("n").over(Window.orderBy("__range")) - F.col("n")).alias("start"))
    numbered = rows.join(starts, "__range").withColumn(row_order, F.col("start") + F.col("__place"))
    return numbered.drop("__range", "__place", "start")


def append_partitioned(df: DataFrame, path: str, partition_by=("iso3", "survey"), replace: bool = False) -> None:
    """Append to a table partitioned by country and survey.

    ``replace`` rewrites just the partitions present in ``df``, which makes a rerun after a failure safe.
    """
    writer = df.write.partitionBy(*partition_by)
    if replace:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int) -> None:
    """Append to a database table over at most ``connections`` parallel connections, as many as the database bears.

    The rows are repartitioned rather than coalesced, so the steps before the write keep their parallelism.
    """
    df.repartition(connections).write.jdbc(url, table, mode="append", properties=properties)
