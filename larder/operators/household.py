"""Household covariates: interview date, residence, head, expenditure quintiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import recode
from larder.operators.joins import na_join

# Codes of the cover and roster tables.
RESIDENCE = {1: "Rural", 2: "Urban"}
SEX = {1: "Male", 2: "Female"}
HEAD = 1

HH_INFO_COLUMNS = [
    "hhid", "adm1", "adm2", "res", "sep_quintile", "res_quintile", "age_head", "sex_head", "educ_head", "year", "month",
    "survey_wgt", "afe", "ea",
]


def interview_date(df: DataFrame, code: str = "int_month_year", first_year: int = 2020) -> DataFrame:
    """Year and month from a running month code: 1 is December of the first year, 14 is January two years on."""
    known = f"{code} BETWEEN 1 AND 14"
    return df.withColumns(
        {
            "year": F.expr(f"CASE WHEN {known} THEN CAST({first_year} + ({code} + 10) DIV 12 AS INT) END"),
            "month": F.expr(f"CASE WHEN {known} THEN CAST(({code} + 10) % 12 + 1 AS INT) END"),
        }
    ).drop(code)


def residence_recode(df: DataFrame, code: str = "rural") -> DataFrame:
    """Residence label; codes other than rural and urban are NULL."""
    return df.withColumn("res", recode(code, RESIDENCE)).drop(code)


def household_head(roster: DataFrame, education: DataFrame) -> DataFrame:
    """Sex, age and education of each household head; a household with two heads has two rows."""
    heads = roster.filter(F.col("relationship") == HEAD).select("hhid", "indid", "sex", "age")
    educated = na_join(heads, education.select("hhid", "indid", "educ"), ["hhid", "indid"], null_keys=["indid"])
    return educated.select(
        "hhid",
        recode("sex", SEX).alias("sex_head"),
        F.col("age").alias("age_head"),
        F.col("educ").alias("educ_head"),
    )


def assign_quintile(df: DataFrame, x: str, cuts: DataFrame, out: str, by: str | None = None) -> DataFrame:
    """Fifth of the distribution a value falls in; a value on a cut point belongs above it.

    Without ``by`` the single row of cut points enters as a scalar subquery. With ``by`` a row whose group has no cut
    points, or is NULL, gets NULL.
    """
    names = ["q20", "q40", "q60", "q80"]
    if by is None:
        points = df.withColumn("__cuts", cuts.select(F.struct(*names)).scalar())
    else:
        points = na_join(df, cuts.select(by, F.struct(*names).alias("__cuts")), by, null_keys=False)
    cases = " ".join(f"WHEN {x} < __cuts.{name} THEN {rank}" for rank, name in enumerate(names, start=1))
    cases = f"WHEN isnan(double({x})) THEN NULL {cases}"
    return points.withColumn(out, F.expr(f"CASE {cases} WHEN {x} >= __cuts.q80 THEN 5 END")).drop("__cuts")


def hh_info(cover: DataFrame, head: DataFrame, afe: DataFrame, quintiles: DataFrame) -> DataFrame:
    """One table of household covariates; a household without a known member equivalent has NULL ``afe``."""
    rows = na_join(cover, head, "hhid", null_keys=False)
    rows = na_join(rows, afe, "hhid", null_keys=False)
    rows = na_join(rows, quintiles.select("hhid", "sep_quintile", "res_quintile"), "hhid", null_keys=False)
    return rows.select(*HH_INFO_COLUMNS)
