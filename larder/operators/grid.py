"""The grid of all households and all items, with zeros where nothing was eaten.

Every (household, item) pair that was not consumed is zero if the household's ``afe`` is positive and missing otherwise. So sums, means, counts and pivots over
the grid follow in closed form from the consumed rows, the number of households and the number of items; no pair is made for its zero. ``every`` makes all
pairs, tile by tile.
"""

from __future__ import annotations

import math
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import across, others
from larder.functions.missing import safe_div, sum_or_zero, times
from larder.operators.joins import na_join
from larder.sources.staging import stage

ITEM_COLUMNS = ["item_code", "item_name"]
CONSUMED = ["quantity_100g", "quantity_g"]

#: Listed items by households of a tile of the grid, about, and the most partitions that tiles are dealt to.
TILE_ITEMS, TILE_HOMES, MOST_PARTITIONS = 500, 5_000, 4_096


class ImpliedGrid:
    """Households by the items of a composition table that were consumed at all, quantities and nutrients per equivalent.

    ``hh`` has hhid, afe and any columns to group by. As in the full grid, an item listed in two food groups contributes its consumption once per
    (recorded, listed) pair.
    """

    def __init__(self, hh: DataFrame, cons: DataFrame, fct: DataFrame):
        self.hh, self.cons, self.fct = hh, cons, fct
        self.nutrients = others(fct, ITEM_COLUMNS)
        self.columns = [*CONSUMED, *self.nutrients]

    @cached_property
    def listed(self) -> DataFrame:
        """The items of the grid: (item_code, food_group, item_name, nutrients), stored; an item may have several rows."""
        pairs = self.cons.select("item_code", "food_group").distinct()
        return stage(na_join(pairs, self.fct, "item_code", "inner"), "listed-items")

    def _eaten(self, by: list[str] = (), rows: Column | None = None) -> DataFrame:
        """Consumption per equivalent with the ``by`` columns of the household; rows meet their household before anything is summed, so
        that household sums need no second exchange."""
        homes = self.hh if rows is None else self.hh.filter(rows)
        extra = [c for c in by if c != "hhid"]
        met = na_join(self.cons, homes.select("hhid", "afe", *extra), "hhid", "inner", null_keys=False)
        return met

    def rows(self) -> DataFrame:
        """The pairs that were consumed; every other pair is implied. A household listed twice has its pairs twice."""
        homes = self.hh.select(F.col("hhid").alias("home"), "afe").groupBy("home", "afe").agg(F.count(F.lit(1)).cast("int").alias("copies"))
        met = na_join(self.cons, homes, [("hhid", "home")], "inner", null_keys=False)
        sums = met.groupBy("hhid", "afe", "copies", "item_code", "food_group").agg(*[sum_or_zero(c).alias(c) for c in CONSUMED])
        each = sums.withColumn("copy", F.explode(F.array_repeat(F.lit(0), "copies"))).drop("copy", "copies", "food_group")
        unit = across(each, CONSUMED, lambda c: safe_div(c, "afe"))
        return across(na_join(unit, self.listed, "item_code", "inner"), self.nutrients, lambda c: times(c, "quantity_100g"))

    def zeros(self) -> DataFrame:
        """The pairs that were not consumed: zero, or missing for a household without a positive ``afe``.

        Items are dealt to blocks and households to chunks. Each household comes once per block, with its consumed items of that block, and each item once
        per chunk; they meet in the tile of a block and a chunk. So the pairs are never shuffled, what is shuffled is their number by ``TILE_ITEMS``
        and by ``TILE_HOMES``, and a task buffers the items of one tile.
        """
        blocks = max(1, math.ceil(self.listed.count() / TILE_ITEMS))
        chunks = max(1, math.ceil(self.hh.count() / TILE_HOMES))
        tiles = min(blocks * chunks, MOST_PARTITIONS)
        block, chunk = (F.expr(f"pmod(hash({c}), {n})") for c, n in (("item_code", blocks), ("hhid", chunks)))

        def one_of(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

        eaten = self.cons.select("hhid", "item_code", block.alias("block")).groupBy("hhid", "block").agg(
            F.collect_set("item_code").alias("eaten"), F.bool_or(F.col("item_code").isNull()).alias("eaten_null")
        )
        zero = {c: safe_div("0.0D", "afe") for c in CONSUMED}
        homes = self.hh.select("hhid", "afe").withColumns(zero).withColumn("chunk", chunk).withColumn("block", one_of(blocks))
        homes = na_join(homes, eaten, ["hhid", "block"], null_keys=False).repartition(tiles, "block", "chunk")
        items = self.listed.withColumn("block", block).withColumn("chunk", one_of(chunks)).repartition(tiles, "block", "chunk")
        # a merge join holds the items of one tile; a broadcast would hold every item once per chunk
        pairs = na_join(homes, items.hint("merge"), ["block", "chunk"], "inner", null_keys=False)
        consumed = F.expr("CASE WHEN item_code IS NULL THEN eaten_null ELSE array_contains(eaten, item_code) END")
        rest = pairs.filter(~F.coalesce(consumed, F.lit(False))).drop("block", "chunk", "eaten", "eaten_null")
        return across(rest, self.nutrients, lambda c: times(c, "quantity_100g"))

    def every(self) -> DataFrame:
        """All pairs of households and listed items, consumed or not."""
        return self.rows().unionByName(self.zeros())

    def _sums(self, by_items: list[str], by_homes: list[str], homes: Column | None = None) -> DataFrame:
        """Sums of the consumed pairs. Nutrients are proportional to the quantity, so quantities are summed per item first, with a partial sum on
        the map side, and only those few rows meet the composition table."""
        unit = across(self._eaten(by_homes, homes), CONSUMED, lambda c: safe_div(c, "afe"))
        per_item = unit.groupBy(*by_homes, "item_code", "food_group").agg(*[sum_or_zero(c).alias(c) for c in CONSUMED])
        items = na_join(per_item.drop("food_group"), self.listed, "item_code", "inner")
        priced = across(items, self.nutrients, lambda c: times(c, "quantity_100g"))
        return priced.groupBy(*by_homes, *by_items).agg(*[sum_or_zero(c).alias(c) for c in self.columns])

    def counts(self, by_items: list[str] = (), by_homes: list[str] = ()) -> DataFrame:
        """(by_homes, by_items, households, items): households with a positive ``afe``, and grid items; their product is the number of cells that
        have a value. One row for every combination of the groups, consumed or not."""
        by_items, by_homes = list(by_items), list(by_homes)
        homes = self.hh.groupBy(*by_homes).agg(F.count_if(F.col("afe") > 0).alias("households"))
        groups = self.listed.groupBy(*by_items).agg(F.count(F.lit(1)).alias("items"))
        entry = F.struct(*by_items, "items")
        every = homes.withColumn("group", F.explode(groups.select(F.collect_list(entry)).scalar()))
        return every.select(*by_homes, *[F.col("group")[c].alias(c) for c in by_items], "households", F.col("group")["items"].alias("items"))

    def sum(self, by_items: list[str] = (), by_homes: list[str] = ()) -> DataFrame:
        """Sums by any columns of items and households; zero where a combination of groups has no consumption."""
        by_items, by_homes = list(by_items), list(by_homes)
        every = self.counts(by_items, by_homes).select(*by_homes, *by_items)
        sums = na_join(every, self._sums(by_items, by_homes), [*by_homes, *by_items]) if by_homes or by_items else self._sums([], [])
        return across(sums, self.columns, lambda c: F.coalesce(c, F.lit(0.0)))

    def mean(self, by_items: list[str] = (), by_homes: list[str] = (), per: str = "household") -> DataFrame:
        """Means over the households with a positive ``afe``, zeros included: of a household's total in the group, or ``per="cell"`` of a
        single cell. Without such households the mean is missing."""
        by_items, by_homes = list(by_items), list(by_homes)
        keys = [*by_homes, *by_items]
        sums = self._sums(by_items, by_homes, F.col("afe") > 0)
        counts = self.counts(by_items, by_homes)
        rows = na_join(counts, sums, keys) if keys else sums.withColumns({c: counts.select(c).scalar() for c in counts.columns})
        number = "households" if per == "household" else "households * items"
        rows = across(rows, self.columns, lambda c: safe_div(f"coalesce({c}, 0.0D)", number))
        return rows.drop("items") if per == "household" else rows

    def pivot(self, on: str, values: list, column: str = "quantity_g") -> DataFrame:
        """One row per household and one column per value of the item column ``on``: the household's sum of ``column`` there."""
        sums = [F.coalesce(F.sum(F.when(F.col(on) == F.lit(v), F.col(column))), F.lit(0.0)).alias(str(v)) for v in values]
        wide = self.rows().groupBy("hhid").agg(*sums)
        rows = na_join(self.hh.select("hhid", "afe"), wide, "hhid", null_keys=False)
        zero = F.when(F.col("afe") > 0, F.lit(0.0))
        return rows.select("hhid", "afe", *[F.coalesce(rows[_quoted(v)], zero).alias(str(v)) for v in values])


def _quoted(name) -> str:
    return "`" + str(name).replace("`", "``") + "`"
