"""Nutrient intake per household and adult-female equivalent.

Household tables are keyed by a household id that is never NULL (``quality.null_keys`` checks it), so joins on it use plain
equality and share the hash partitioning of the sums per household.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import across, ending_with, others
from larder.functions.missing import safe_div, sum_or_zero, times
from larder.operators.grid import ITEM_COLUMNS, ImpliedGrid
from larder.operators.joins import na_join
from larder.operators.layers import CompositionLayers, Layer


class ZoneOverride(NamedTuple):
    """Composition of items that differs by zone, and the zone of each household."""

    fct: DataFrame
    zones: DataFrame
    zone: str = "zone"


def nutrients_of(fct: DataFrame, keys=()) -> list[str]:
    """Every column of a composition table that is not an identifier."""
    return others(fct, [*ITEM_COLUMNS, *keys])


def price(cons: DataFrame, fct: DataFrame, item_key=("item_code",)) -> DataFrame:
    """Consumption rows with the amount of each nutrient; an item without composition gets NULLs."""
    item_key = list(item_key)
    nutrients = nutrients_of(fct, item_key)
    rows = na_join(cons, fct.select(*item_key, *nutrients), item_key)
    return across(rows, nutrients, lambda c: times(c, "quantity_100g"))


def household_totals(priced: DataFrame, nutrients: list[str], keys=("hhid",)) -> DataFrame:
    """Sum of every nutrient per household, missing amounts skipped."""
    return priced.groupBy(*keys).agg(*[sum_or_zero(c).alias(c) for c in nutrients])


def per_afe(totals: DataFrame, hh: DataFrame, columns: list[str], keys=("hhid",)) -> DataFrame:
    """Household totals divided by the household's equivalents; NULL for a household without them."""
    rows = na_join(totals, hh.select(*keys, "afe"), list(keys), null_keys=False)
    return across(rows, columns, lambda c: safe_div(c, "afe")).drop("afe")


def apparent_intake(
    cons: DataFrame,
    fct: DataFrame,
    hh: DataFrame,
    override: ZoneOverride | None = None,
    keys=("hhid",),
    item_key=("item_code",),
) -> DataFrame:
    """Nutrients available per adult-female equivalent and day, one row per household that reported consumption.

    Rows are summed per household before the equivalents are joined, so the fact rows are shuffled once, after a partial
    sum on the map side. For several surveys in one table give ``keys=('survey', 'hhid')``. With ``override``, items that it lists
    take the composition of their household's zone, or none.
    """
    if override is not None:
        zones = override.zones.select("hhid", F.col(override.zone).alias("zone"))
        located = na_join(hh.select("hhid", "afe"), zones, "hhid", null_keys=False)
        layers = CompositionLayers([Layer(override.fct, zone=override.zone), Layer(fct)], nutrients_of(fct))
        return layers.intake(cons, located)
    nutrients = nutrients_of(fct, item_key)
    return per_afe(household_totals(price(cons, fct, item_key), nutrients, keys), hh, nutrients, keys)


def nutrient_density(cons: DataFrame, fct: DataFrame, energy: str = "energy_kcal") -> DataFrame:
    """Nutrients per 1000 kcal of the household's total, and that energy itself."""
    nutrients = nutrients_of(fct)
    totals = household_totals(price(cons, fct), nutrients).withColumn("energy_1000kcal", F.col(energy) / 1000)
    dense = across(
        totals, [c for c in nutrients if c != energy], lambda c: safe_div(c, "energy_1000kcal"), "{col}_1000kcal"
    )
    return dense.select("hhid", *ending_with(dense, "1000kcal"))


def consumed_items(hh: DataFrame, cons: DataFrame, fct: DataFrame) -> DataFrame:
    """The consumed rows of the grid of households and items, per equivalent; the other pairs are implied (see ``grid``)."""
    return ImpliedGrid(hh, cons, fct).rows()


def full_item_list(hh: DataFrame, cons: DataFrame, fct: DataFrame) -> DataFrame:
    """Every household by every item that was consumed at all, per equivalent: ``consumed_items``, and zeros for all other pairs."""
    return ImpliedGrid(hh, cons, fct).every()


def full_item_totals(hh: DataFrame, cons: DataFrame, fct: DataFrame, by: list[str]) -> DataFrame:
    """Sums of the grid's quantities and nutrients by item columns (item_code, item_name, food_group)."""
    return ImpliedGrid(hh, cons, fct).sum(by)


def food_group_mean_intake(hh: DataFrame, cons: DataFrame, fct: DataFrame) -> DataFrame:
    """Mean household intake per equivalent by food group over all households with ``afe`` above zero.

    Households that ate nothing of a group count as zero; what other households ate does not count.
    """
    return ImpliedGrid(hh, cons, fct).mean(["food_group"])


def food_group_matrix(
    hh: DataFrame, cons: DataFrame, fct: DataFrame, groups: list[str], column: str = "quantity_g"
) -> DataFrame:
    """One row per household and one column per food group with its intake per equivalent, zero where none was eaten."""
    return ImpliedGrid(hh, cons, fct).pivot("food_group", groups, column)
