"""Raw survey tables: column maps by table and version, and a side table of the cells that did not parse.

A map says under which raw name and as which type each working column comes. ``apply`` renames and types a table of text (or of typed
columns); a cell that holds something and is no value of its type becomes NULL there and a row of the quarantine, with the key of its row. ``store`` counts such
cells in the job that stores the table, so that a second pass for the quarantine is made only if there are any.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.missing import to_integer, to_number
from larder.operators.quality import Check
from larder.sources.staging import stage

#: Texts that stand for a missing value.
MISSING = ["NA", "", "NaN", "nan", "."]


class RawMap(NamedTuple):
    """Raw name -> (working name, type) of one table; ``key`` (working names) identifies a row in the quarantine."""

    table: str
    version: str
    columns: dict[str, tuple[str, str]]
    key: tuple[str, ...]


HOUSEHOLD, PERSON = {"y5_hhid": ("hhid", "string")}, {"y5_hhid": ("hhid", "string"), "indidy5": ("indid", "bigint")}
ITEM = {"itemcode": ("item_code", "bigint")}

# Raw names of the fifth wave, as its files have them.
_MAPS = [
    RawMap("cover", "y5", HOUSEHOLD | {
        "hh_a01_1": ("adm1", "string"), "hh_a02_1": ("adm2", "string"), "hh_a04_1": ("ea", "int"), "y5_rural": ("rural", "int"),
        "int_month_year": ("int_month_year", "int"), "y5_crossweight": ("survey_wgt", "double"),
    }, ("hhid",)),
    RawMap("roster", "y5", PERSON | {
        "hh_b02": ("sex", "int"), "hh_b04": ("age", "int"), "hh_b05": ("relationship", "int"), "hh_b07": ("eat7d", "int"),
        "hh_b15_2": ("moid", "bigint"),
    }, ("hhid", "indid")),
    RawMap("education", "y5", PERSON | {"hh_c07": ("educ", "string")}, ("hhid", "indid")),
    RawMap("pregnancies", "y5", PERSON | {"hh_d36a": ("pregnant", "int")}, ("hhid", "indid")),
    RawMap("child_ages", "y5", PERSON | {"age_months": ("age_months", "double")}, ("hhid", "indid")),
    RawMap("anthropometry", "y5", PERSON | {"hh_v05": ("weight", "double")}, ("hhid", "indid")),
    RawMap("expenditure", "y5", HOUSEHOLD | {"hhweight": ("hhweight", "double"), "expmR_pae": ("exp_pae", "double")}, ("hhid",)),
    RawMap("consumption_new", "y5", HOUSEHOLD | ITEM | {
        "hh_ja01": ("consumed", "int"), "hh_ja02_1": ("unit", "int"), "hh_ja02_2": ("quantity", "double"),
        "hh_ja02b_1": ("est_metric_unit", "int"), "hh_ja02b_2": ("est_metric_quantity", "double"),
        "hh_ja09_1": ("weighed_unit", "int"), "hh_ja09_2": ("weighed_quantity", "double"),
    }, ("hhid", "item_code")),
    RawMap("consumption_old", "y5", HOUSEHOLD | ITEM | {
        "hh_j01": ("consumed", "int"), "hh_j02_1": ("unit", "int"), "hh_j02_2": ("quantity", "double"),
    }, ("hhid", "item_code")),
    RawMap("items", "y5", ITEM | {"itemname": ("itemname", "string")}, ("item_code",)),
    RawMap("groups", "y5", ITEM | {"food_group": ("food_group", "string")}, ("item_code",)),
    RawMap("edible_new", "y5", ITEM | {"Edible_factor_in_FCT": ("edible_portion", "double")}, ("item_code",)),
    RawMap("edible_old", "y5", ITEM | {"mean_EP": ("edible_portion", "double")}, ("item_code",)),
    RawMap("unit_conv", "y5", ITEM | {"cons_unit": ("unit", "int"), "conv_fac": ("conv_fac", "double")}, ("item_code", "unit")),
]
RAW_MAPS = {(m.table, m.version): m for m in _MAPS}


def raw_map(table: str, version: str = "y5") -> RawMap:
    if (table, version) not in RAW_MAPS:
        raise KeyError(f"no map for {table}, version {version}; there are {sorted(RAW_MAPS)}")
    return RAW_MAPS[table, version]


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all cells as text; its columns are found by name, so there may be more, in any order."""
    return spark.read.options(header=True, emptyValue="", nullValue="NA", enforceSchema=False).csv(path)


def _typed(raw: str, kind: str) -> Column:
    name = f"`{raw.replace('`', '``')}`"
    text = f"CASE WHEN trim(CAST({name} AS STRING)) IN ({', '.join(repr(m) for m in MISSING)}) THEN NULL ELSE trim(CAST({name} AS STRING)) END"
    if kind == "double":
        return to_number(text)
    if kind in ("int", "bigint"):
        return to_integer(text, kind)
    return F.expr(f"CAST({text} AS {kind})")


def _failed(raw: str, kind: str) -> Column:
    """Whether a cell holds something that is no value of its type."""
    name = f"`{raw.replace('`', '``')}`"
    holds = F.expr(f"coalesce(trim(CAST({name} AS STRING)) NOT IN ({', '.join(repr(m) for m in MISSING)}), false)")
    return holds & _typed(raw, kind).isNull()


def _require(df: DataFrame, mapping: RawMap) -> None:
    lacking = [raw for raw in mapping.columns if raw not in df.columns]
    if lacking:
        raise ValueError(f"{mapping.table} ({mapping.version}) lacks the columns {lacking}")


def apply(df: DataFrame, mapping: RawMap) -> DataFrame:
    """The working columns of a raw table, typed; text that is no number, and NaN, become NULL."""
    _require(df, mapping)
    return df.select(*[_typed(raw, kind).alias(name) for raw, (name, kind) in mapping.columns.items()])


def unparsed(df: DataFrame, mapping: RawMap) -> DataFrame:
    """(table, version, row_key, column, raw_column, value) of each cell that did not parse; ``row_key`` joins the key cells as they came."""
    _require(df, mapping)
    raws = {name: raw for raw, (name, _) in mapping.columns.items()}
    key = F.concat_ws("/", *[F.coalesce(F.col(f"`{raws[k]}`").cast("string"), F.lit("NA")) for k in mapping.key])
    cells = [
        F.when(_failed(raw, kind), F.struct(F.lit(name).alias("column"), F.lit(raw).alias("raw_column"), F.col(f"`{raw}`").cast("string").alias("value")))
        for raw, (name, kind) in mapping.columns.items()
        if kind != "string"
    ]
    if not cells:
        cells = [F.lit(None).cast("struct<column: string, raw_column: string, value: string>")]
    found = df.select(key.alias("row_key"), F.explode(F.array_compact(F.array(*cells))).alias("cell"))
    return found.select(F.lit(mapping.table).alias("table"), F.lit(mapping.version).alias("version"), "row_key", "cell.*")


class Stored(NamedTuple):
    """A stored table, its unparsed cells, and the number of rows with any."""

    table: DataFrame
    unparsed: DataFrame
    bad_rows: int


def store(df: DataFrame, mapping: RawMap, limit: int | None = None, by: str | None = None, buckets: int | None = None) -> Stored:
    """Store the working table, and the quarantine if there is anything in it. More than ``limit`` rows with an unparsed cell are an error."""
    _require(df, mapping)
    bad = F.lit(False)
    for raw, (_, kind) in mapping.columns.items():
        if kind != "string":
            bad = bad | _failed(raw, kind)
    typed = df.select(*[_typed(raw, kind).alias(name) for raw, (name, kind) in mapping.columns.items()], bad.alias("__bad"))
    counts: dict[str, int] = {}
    table = stage(
        typed, f"raw-{mapping.table.replace('_', '-')}", by, buckets, checks=[Check("unparsed", "__bad", limit)], drop=["__bad"], counts=counts
    )
    side = unparsed(df, mapping)
    return Stored(table, stage(side, "unparsed") if counts["unparsed"] else side.limit(0), counts["unparsed"])

