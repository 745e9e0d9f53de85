"""Layered composition: nutrients of an item by the most specific table that lists it.

A layer is a composition table for one survey, for the survey each of its rows names, or for any; it may differ by zone. All layers become one
lookup of a row per item, whose layers are an array ordered from the most to the least specific: by zone before without, a named survey
before any, then the order in which layers were given. A consumption row meets it once, by item. What doesn't depend on the zone is priced
there and summed with a map-side combine; of items that have zones, the quantities are summed, and are priced when the household's zone
comes along with its equivalents. So there is one scan and one branch, however many surveys and zones there are.
"""

from __future__ import annotations

from functools import cached_property, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import others
from larder.functions.missing import safe_div, sum_or_zero, times
from larder.operators.joins import na_join
from larder.sources.staging import stage

SURVEY = "survey_id"


class Layer(NamedTuple):
    """A composition table; ``survey`` is a constant or a column of it, None for any survey, ``zone`` its zone column if it differs by zone."""

    table: DataFrame
    survey: Column | None = None
    zone: str | None = None


class CompositionLayers:
    """The lookup of some layers for ``nutrients`` (those of the last layer unless given).

    Rows of a survey that is NULL match rows of a layer whose survey is NULL. An item that a zone layer lists takes the composition of its
    household's zone, or none if the layer lacks that zone. A layer that lists an item twice counts it twice, as a join would.
    """

    def __init__(self, layers: list[Layer], nutrients: list[str] | None = None):
        self.layers = layers
        keys = {"item_code", "item_name", SURVEY, *[x.zone for x in layers if x.zone]}
        self.nutrients = nutrients or others(layers[-1].table, [c for c in layers[-1].table.columns if c in keys])
        self.zoned = any(layer.zone for layer in layers)

    @cached_property
    def lookup(self) -> DataFrame:
        """(item_code, layers), stored: a row per item."""
        parts = []
        for order, layer in enumerate(self.layers):
            specific = (0 if layer.zone else 2) + (0 if layer.survey is not None else 1)
            table = layer.table.filter(F.col(layer.zone).isNotNull()) if layer.zone else layer.table
            entry = F.struct(
                F.lit(specific * len(self.layers) + order).alias("priority"),
                F.lit(layer.survey is None).alias("any_survey"),
                (F.lit(None) if layer.survey is None else layer.survey).cast("string").alias(SURVEY),
                F.lit(layer.zone is not None).alias("by_zone"),
                (F.col(layer.zone) if layer.zone else F.lit(None)).cast("string").alias("zone"),
                F.struct(*[F.col(n).cast("double").alias(n) for n in self.nutrients]).alias("amounts"),
            )
            parts.append(table.select("item_code", entry.alias("layer")))
        rows = reduce(DataFrame.unionByName, parts)
        return stage(rows.groupBy("item_code").agg(F.sort_array(F.collect_list("layer")).alias("layers")), "composition-layers")

    def _of_survey(self, layers: Column, survey: Column) -> Column:
        return F.filter(layers, lambda x: x["any_survey"] | x[SURVEY].eqNullSafe(survey))

    def _best(self, layers: Column) -> Column:
        """The layers of the best priority; one that is NULL if there are none."""
        first = F.get(layers, 0)
        return F.when(F.size(layers) > 0, F.filter(layers, lambda x: x["priority"] == first["priority"])).otherwise(F.array(first))

    def resolve(self, df: DataFrame, survey: Column | None = None, zone: Column | None = None) -> DataFrame:
        """``df`` (with item_code) and the ``priority`` and ``amounts`` of what each row's survey and zone give."""
        survey = F.lit(None).cast("string") if survey is None else survey
        zone = F.lit(None).cast("string") if zone is None else zone
        rows = na_join(df, self.lookup, "item_code").withColumn("layers", self._of_survey(F.coalesce("layers", F.array()), survey))
        own = F.when(
            F.exists("layers", lambda x: x["by_zone"]), F.filter("layers", lambda x: x["by_zone"] & (x["zone"] == zone))
        ).otherwise(F.filter("layers", lambda x: ~x["by_zone"]))
        rows = rows.withColumn("layers", own).withColumn("layer", F.explode(self._best(F.col("layers"))))
        return rows.withColumns({"priority": F.col("layer")["priority"], "amounts": F.col("layer")["amounts"]}).drop("layers", "layer")

    def intake(self, cons: DataFrame, hh: DataFrame, keys: tuple[str, ...] = ("hhid",), survey: Column | None = None) -> DataFrame:
        """Nutrients per adult-female equivalent, one row per household of ``cons``; ``hh`` has the keys, afe, and the zone if layers need it.

        ``survey`` is the survey of a consumption row, ``keys`` what identifies a household; a survey key may be NULL, a household id not.
        """
        names, keys = self.nutrients, list(keys)
        may_be_null = [k for k in keys if k != "hhid"]
        survey = F.lit(None).cast("string") if survey is None else survey.cast("string")
        rows = cons.select(*keys, "item_code", F.col("quantity_100g").alias("q"), survey.alias("__survey"))
        rows = na_join(rows, self.lookup, "item_code")
        rows = rows.withColumn("layers", self._of_survey(F.coalesce("layers", F.array()), F.col("__survey")))
        plain = self._best(F.filter("layers", lambda x: ~x["by_zone"]))
        if not self.zoned:
            priced = rows.select(*keys, "q", F.explode(plain).alias("layer"))
            sums = priced.groupBy(*keys).agg(*[F.coalesce(F.sum(_amount(n)), F.lit(0.0)).alias(n) for n in names])
            known = na_join(sums, hh.select(*keys, "afe"), keys, null_keys=may_be_null)
            return known.select(*keys, *[safe_div(n, "afe").alias(n) for n in names])
        has_zones = F.exists("layers", lambda x: x["by_zone"])
        rows = rows.withColumn("by_zone", has_zones).withColumn("zoned_item", F.when(F.col("by_zone"), F.col("item_code")))
        priced = rows.select(
            *keys, "__survey", "by_zone", "zoned_item", "q", F.explode(F.when(F.col("by_zone"), F.array(F.get("layers", 0))).otherwise(plain)).alias("layer")
        )
        once = F.expr("CASE WHEN NOT by_zone THEN q END").alias("plain_q")
        priced = priced.withColumn("plain_q", once)
        sums = priced.groupBy(*keys, "__survey", "by_zone", "zoned_item").agg(
            F.expr("sum(CASE WHEN by_zone THEN q END)").alias("q"), *[F.sum(_amount(n, "plain_q")).alias(n) for n in names]
        )
        located = na_join(sums, hh.select(*keys, "afe", F.col("zone").cast("string").alias("zone")), keys, null_keys=may_be_null)
        lookup = self.lookup.withColumn("layers", F.filter("layers", lambda x: x["by_zone"])).filter(F.size("layers") > 0)
        met = na_join(located, lookup, [("zoned_item", "item_code")])
        found = F.filter(
            self._of_survey(F.coalesce("layers", F.array()), F.col("__survey")), lambda x: F.col("by_zone") & (x["zone"] == F.col("zone"))
        )
        met = met.withColumn("layer", F.explode(self._best(found)))
        amounts = [F.when(F.col("by_zone"), _amount(n)).otherwise(F.col(n)).alias(n) for n in names]
        rows = met.select(*keys, "afe", *amounts)
        sums = rows.groupBy(*keys, "afe").agg(*[sum_or_zero(n).alias(n) for n in names])
        return sums.select(*keys, *[safe_div(n, "afe").alias(n) for n in names])


def _amount(nutrient: str, quantity: str = "q") -> Column:
    return times(f"layer.amounts.`{nutrient}`", quantity)
