"""A mergeable histogram of moments: what a table says about its values per group, from one aggregate.

A cell is a (group, bucket of each column) with its number of rows and, per column, the lowest and highest value and the mean and spread
of the value and of its logarithm. Cells of a group merge into the group's count, mean and standard deviation, whatever the order.
Since buckets follow the order of values, the cells also tell which values lie above a cut point and in which buckets the middle
ranks are. Only cells that a cut point crosses, or that may hold a middle rank, are read again, so a cleaning by mean and deviation
followed by a median takes two passes over the rows and stores none of the others.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.missing import log10_ieee, nan_to_null
from larder.operators.joins import na_join
from larder.operators.quality import Check
from larder.operators.quantiles import LARGEST_BUCKET, MIDDLES, TARGET, TOTAL, WEIGHT, bucket_of, resolve, widen_medians
from larder.sources.staging import stage


#: Coarser than for quantiles: a cell should hold many rows of its group, and only few cells are read again.
BUCKETS_PER_OCTAVE = 16


class MomentHistogram:
    """The histogram of ``columns`` of ``rows`` per ``key``, with moments of the first column, or with ``log`` of its logarithm.

    ``rows`` is read twice: it is a stored table or a cheap plan over one.
    """

    def __init__(self, rows: DataFrame, key: list[str], columns: list[str], log: bool = False):
        self.key, self.columns, self.log = list(key), list(columns), log
        self.names = [f"x{i}" for i in range(len(columns))]
        self.buckets = [f"b{i}" for i in range(len(columns))]
        values = [nan_to_null(f"double(`{c}`)").alias(x) for c, x in zip(columns, self.names, strict=True)]
        placed = rows.select(*key, *values)
        self.rows = placed.withColumns({b: bucket_of(x, BUCKETS_PER_OCTAVE) for b, x in zip(self.buckets, self.names, strict=True)})

    @cached_property
    def cells(self) -> DataFrame:
        """One row per group and bucket of every column, stored; a bucket is NULL where the value is missing."""
        measured = log10_ieee("x0") if self.log else F.col("x0")
        measures = [
            F.count(F.lit(1)).alias("n"),
            F.min("x0").alias("low"),
            F.max("x0").alias("high"),
            F.expr("count(v) AS n_v"),
            F.expr("avg(v) AS mean_v"),
            F.expr("var_pop(v) * count(v) AS square_v"),
        ]
        return stage(self.rows.withColumn("v", measured).groupBy(*self.key, *self.buckets).agg(*measures), "histogram-cells")

    def moments(self) -> DataFrame:
        """(key, rows, n, mean, square, sd, low, high): all rows of a group, those with a value (or its logarithm), and their moments.

        ``square`` is the sum of squared differences from the mean; the standard deviation is that of a sample, NULL for a single
        value; ``low`` and ``high`` are bounds of the value itself.
        """
        whole = Window.partitionBy(*self.key)
        mean = F.sum(F.expr("n_v * mean_v")).over(whole) / F.sum("n_v").over(whole)
        merged = self.cells.withColumn("mean", mean).groupBy(*self.key).agg(
            F.sum("n").alias("rows"),
            F.sum("n_v").alias("n"),
            F.max("mean").alias("mean"),
            F.expr("sum(CASE WHEN n_v > 0 THEN square_v + n_v * pow(mean_v - mean, 2) END) AS square"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        return merged.withColumn("sd", F.expr("CASE WHEN n > 1 THEN sqrt(square / (n - 1)) END"))

    def cut_points(self, k: float = 3) -> DataFrame:
        """(key, upper_cut): mean plus ``k`` standard deviations; NULL where either is undefined."""
        return self.moments().select(*self.key, nan_to_null(f"mean + {k} * sd").alias("upper_cut"))

    def medians(self, largest_bucket: int = LARGEST_BUCKET, groups: DataFrame | None = None) -> DataFrame:
        """Median of each column per key. ``groups`` (keys) restricts the answer, and the second pass, to some groups."""
        cells = self.cells if groups is None else na_join(self.cells, groups.select(*self.key), self.key, "left_semi")
        states = cells.withColumns({"state": F.lit("kept"), "upper_cut": F.lit(None).cast("double")})
        return self._medians(states, False, largest_bucket)

    def medians_below_cut(self, cuts: DataFrame, largest_bucket: int = LARGEST_BUCKET) -> DataFrame:
        """Median of each column per key, over the rows whose first column has a value that doesn't lie above its group's cut point."""
        state = (
            F.when(F.col("low").isNull(), "gone").when(self._above("low"), "gone").when(self._above("high"), "open").otherwise("kept")
        )
        states = na_join(self.cells, cuts, self.key).withColumn("state", state).filter("state <> 'gone'")
        return self._medians(states, True, largest_bucket)

    def _above(self, x: str) -> Column:
        value = log10_ieee(x) if self.log else F.col(x)
        return F.coalesce(value > F.col("upper_cut"), F.lit(False))

    def _medians(self, states: DataFrame, cut: bool, largest_bucket: int) -> DataFrame:
        """Medians given what becomes of each cell: all its rows are kept, or it is open and each row is judged by the cut point.

        How many open rows stay is not known before they are read, so the middle ranks lie in a span of buckets.
        """
        key = self.key
        each = F.explode(
            F.array(*[F.struct(F.lit(i).alias("at"), F.col(b).alias("bucket")) for i, b in enumerate(self.buckets)])
        )
        cell = [*key, *self.buckets, "state", "upper_cut"]
        long = states.select(*cell, "n", each.alias("cell")).select(*cell, "n", "cell.*").filter("bucket IS NOT NULL")
        whole = Window.partitionBy(*key, "at")
        by_bucket = whole.orderBy("bucket")
        sure = F.when(F.col("state") == "kept", F.col("n")).otherwise(0)
        ranked = (
            long.withColumn("sure_before", F.coalesce(F.sum(sure).over(by_bucket.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("most_reached", F.sum("n").over(by_bucket.rangeBetween(Window.unboundedPreceding, 0)))
            .withColumn("all_sure", F.sum(sure).over(whole))
            .withColumn("all_most", F.sum("n").over(whole))
            .withColumn("middle", F.expr("sure_before < floor(all_most / 2) + 1 AND most_reached >= ceil(all_sure / 2)"))
            .filter("middle OR state = 'open'")
        )
        ranked = stage(ranked.select(*cell, "at", "bucket", "sure_before", "all_sure", "middle"), "histogram-chosen")
        chosen = ranked.select(*cell).distinct()
        spans = ranked.filter("middle").groupBy(*key, "at").agg(
            F.min("bucket").alias("first"), F.max("bucket").alias("last"),
            F.min("sure_before").alias("sure_before"), F.max("all_sure").alias("all_sure"),
        )
        # the second pass: rows of the chosen cells, less those that the cut point takes
        read = na_join(self.rows, chosen, [*key, *self.buckets], "inner")
        if cut:
            read = read.filter((F.col("state") == "kept") | ~self._above("x0"))
        cells = F.explode(
            F.array(*[
                F.struct(F.lit(i).alias("at"), F.col(b).alias("bucket"), F.col(x).alias("x"))
                for i, (b, x) in enumerate(zip(self.buckets, self.names, strict=True))
            ])
        )
        melted = read.select(*key, "state", cells.alias("cell")).select(*key, "state", "cell.*").filter("bucket IS NOT NULL")
        near = na_join(melted, spans, [*key, "at"], "inner").filter("state = 'open' OR bucket BETWEEN first AND last")
        # equal values, of which a popular report may have very many, become one row
        counted = near.groupBy(*key, "at", "state", "bucket", "x").agg(F.count(F.lit(1)).cast(WEIGHT).alias("weight"))
        seen: dict[str, int] = {}
        counted = stage(counted, "histogram-rows", checks=[Check("no_value", "x IS NULL")], counts=seen)
        rows = na_join(counted, spans, [*key, "at"], "inner")
        heart = rows.filter("bucket BETWEEN first AND last")
        known = rows.groupBy(*key, "at").agg(
            F.expr("coalesce(sum(CASE WHEN state = 'open' THEN weight END), 0) AS opened"),
            F.expr("coalesce(sum(CASE WHEN state = 'open' AND bucket < first THEN weight END), 0) AS opened_before"),
            F.expr("min(CASE WHEN bucket BETWEEN first AND last THEN x END) AS low"),
            F.expr("max(CASE WHEN bucket BETWEEN first AND last THEN x END) AS high"),
            F.expr("count_if(bucket BETWEEN first AND last) AS n"),
            F.max("sure_before").alias("sure_before"),
            F.max("all_sure").alias("all_sure"),
        )
        total = (F.col("all_sure") + F.col("opened")).cast(TOTAL)
        targets = F.array(*[F.struct(F.lit(k).alias("name"), fn(total).cast(TARGET).alias("target")) for k, fn in MIDDLES.items()])
        before = (F.col("sure_before") + F.col("opened_before")).cast(TOTAL)
        place = [*key, "at"]
        spot = known.select(*place, F.explode(targets).alias("aim"), before.alias("before"), "low", "high", "n")
        spot = spot.select(*place, "aim.name", "aim.target", "before", "low", "high", "n")
        if seen["rows"] <= largest_bucket:  # so no bucket can hold more, and the few rows are ordered at once
            largest_bucket = None
        else:
            spot = stage(spot, "histogram-spot")
        found = resolve(heart.select(*place, "x", "weight"), spot, place, place, list(MIDDLES), largest_bucket)
        names = F.element_at(F.array(*[F.lit(c) for c in self.columns]), F.col("at") + 1)
        return widen_medians(found.withColumn("variable", names), key, self.columns)
