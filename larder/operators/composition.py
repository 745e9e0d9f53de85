"""The merged nutrient-composition table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import cast_numbers
from larder.functions.reference import COMPOSITION_COLUMNS
from larder.operators.joins import override_union


def composition_sheet(sheet: DataFrame, code: str, name: str) -> DataFrame:
    """Item, name and nutrients of one sheet under working names, all but the name as numbers."""
    columns = {code: "item_code", name: "item_name", **COMPOSITION_COLUMNS}
    numbers = cast_numbers(sheet.select(*columns).withColumnsRenamed(columns), keep=["item_name"])
    return numbers.withColumn("item_code", F.col("item_code").cast("bigint"))


def fct_build(primary: DataFrame, secondary: DataFrame, key: str = "item_code") -> DataFrame:
    """The newer sheet, completed with the items that only the older sheet has."""
    return override_union(primary, secondary, key)
