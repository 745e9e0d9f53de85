"""From raw consumption modules to grams per household, item and day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import first_columns, others, recode
from larder.functions.reference import FOOD_GROUP_CODES
from larder.operators.joins import na_entries, na_join, spread, union_by_name
from larder.sources.staging import stage

# Raw column names of the two consumption modules.
NEW_MODULE = {
    "y5_hhid": "hhid",
    "itemcode": "item_code",
    "hh_ja01": "consumed",
    "hh_ja02_1": "unit",
    "hh_ja02_2": "quantity",
    "hh_ja02b_1": "est_metric_unit",
    "hh_ja02b_2": "est_metric_quantity",
    "hh_ja09_1": "weighed_unit",
    "hh_ja09_2": "weighed_quantity",
}
OLD_MODULE = {
    "y5_hhid": "hhid",
    "itemcode": "item_code",
    "hh_j01": "consumed",
    "hh_j02_1": "unit",
    "hh_j02_2": "quantity",
}

QUANTITIES = ["quantity_g", "quantity_100g"]


def prepare_consumption(
    raw: DataFrame, items: DataFrame, edible: DataFrame, unit_conv: DataFrame, mapping: dict[str, str] = NEW_MODULE
) -> DataFrame:
    """Consumed rows with item name, edible portion and the conversion factor of the reported unit."""
    rows = (
        raw.select(*mapping)
        .withColumnsRenamed(mapping)
        .filter(F.col("consumed") == 1)
        .drop("consumed")
    )
    rows = na_join(rows, spread(items), "item_code")
    rows = na_join(rows, spread(edible), "item_code")
    rows = na_entries(rows, unit_conv, "item_code", ("unit", "unit", {c: c for c in others(unit_conv, ["item_code", "unit"])}))
    return first_columns(rows, "hhid", "item_code", "itemname")


def quantity_resolution(cons: DataFrame, unit_conv: DataFrame, metric_units=(1, 2, 3, 4)) -> DataFrame:
    """Grams from the first source that yields them: metric report, weighed amount, estimated metric amount."""
    weighed, estimated = ("weighed_unit", "unit", {"conv_fac": "weighed_fac"}), ("est_metric_unit", "unit", {"conv_fac": "est_fac"})
    rows = na_entries(cons, unit_conv, "item_code", weighed, estimated)
    units = ", ".join(str(u) for u in metric_units)
    grams = F.expr(
        f"""coalesce(
            nanvl(double(CASE WHEN unit IN ({units}) THEN quantity * conv_fac * edible_portion END), NULL),
            nanvl(double(weighed_quantity * weighed_fac * edible_portion), NULL),
            nanvl(double(est_metric_quantity * est_fac * edible_portion), NULL))"""
    )
    return rows.select("hhid", "item_code", "itemname", grams.alias("quantity_g")).withColumn(
        "quantity_100g", F.col("quantity_g") / 100
    )


def exclude_incomplete_groups(df: DataFrame, group: str = "hhid", required: str = "conv_fac") -> DataFrame:
    """Drop every group in which any row lacks the required value."""
    incomplete = df.filter(F.col(required).isNull()).select(group).distinct()
    return na_join(df, incomplete, group, "left_anti")


def quantity_old(cons: DataFrame) -> DataFrame:
    """Grams of the old module: one conversion factor for every unit."""
    grams = F.expr("quantity * conv_fac * edible_portion")
    return cons.select("hhid", "item_code", "itemname", grams.alias("quantity_g")).withColumn(
        "quantity_100g", F.col("quantity_g") / 100
    )


def combine_modules(*modules: DataFrame, recall_days: int = 7) -> DataFrame:
    """All modules in one table, quantities per day of the recall period."""
    return union_by_name(*modules).withColumns({c: F.col(c) / recall_days for c in QUANTITIES})


def food_group_recode(df: DataFrame, labels: dict[str, str] = FOOD_GROUP_CODES) -> DataFrame:
    """Survey labels of food groups to harmonised codes; unknown labels stay."""
    return df.withColumn("food_group", recode("food_group", labels, default="food_group"))


def attach_food_group(cons: DataFrame, groups: list[DataFrame], labels: dict[str, str] = FOOD_GROUP_CODES) -> DataFrame:
    """Food group of every row; an item that is listed in two groups yields a row for each."""
    item_groups = stage(food_group_recode(reduce(DataFrame.unionByName, groups).distinct(), labels), "item-groups")
    rows = na_join(cons, spread(item_groups), "item_code")
    return rows.select("hhid", "item_code", "quantity_100g", "food_group", "quantity_g")
