"""Tables in the layout of the shared survey database."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import first_columns
from larder.operators.joins import na_join

HOUSEHOLD_COLUMNS = [
    "hhid", "adm1", "adm2", "ea", "res", "sep_quintile", "res_quintile", "year", "month", "survey_wgt", "afe",
]


def tagged(df: DataFrame, iso3: str, survey: str) -> DataFrame:
    """The table with country and survey as its first columns."""
    return first_columns(df.withColumns({"iso3": F.lit(iso3), "survey": F.lit(survey)}), "iso3", "survey")


def export_hh_information(hh: DataFrame, expenditure: DataFrame, iso3: str, survey: str) -> DataFrame:
    """Household table with per-capita expenditure."""
    spent = expenditure.select("hhid", F.col("exp_pae").alias("pc_expenditure"))
    return tagged(na_join(hh.select(*HOUSEHOLD_COLUMNS), spent, "hhid", null_keys=False), iso3, survey)


def food_groups(cons: DataFrame) -> DataFrame:
    return cons.select("item_code", "food_group").distinct()


def export_food_group(cons: DataFrame, iso3: str, survey: str) -> DataFrame:
    """Distinct (item, food group) pairs ordered by item, unknown items last."""
    return tagged(food_groups(cons).orderBy(F.asc_nulls_last("item_code")), iso3, survey)


def export_food_consumption(cons: DataFrame, iso3: str, survey: str) -> DataFrame:
    return tagged(cons.select("hhid", "item_code", "quantity_g", "quantity_100g"), iso3, survey)


def export_fct(fct: DataFrame, iso3: str, survey: str) -> DataFrame:
    return tagged(fct, iso3, survey)


def export_base_ai(base_ai: DataFrame, iso3: str, survey: str) -> DataFrame:
    return tagged(base_ai, iso3, survey)
