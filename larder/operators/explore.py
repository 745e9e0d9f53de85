"""Distribution summaries of consumed quantities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.missing import nan_to_null, round_half_even
from larder.operators.joins import na_join, na_lookup
from larder.operators.quantiles import group_median
from larder.sources.staging import stage


def top_items(cons: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent (item, name) pairs with their row counts; ties go to the lower code and name.

    Rows are counted per item first, so the names join a table of items instead of the consumption rows.
    """
    counts = cons.groupBy("item_code").agg(F.count(F.lit(1)).alias("n"))
    named = na_lookup(counts, items.select("item_code", "itemname"), "item_code")
    pairs = named.groupBy("item_code", "itemname").agg(F.sum("n").alias("n"))
    return pairs.orderBy(F.desc("n"), F.asc_nulls_last("item_code"), F.asc_nulls_last("itemname")).limit(k)


def item_distribution(
    cons: DataFrame, items: DataFrame, k: int = 10, quantity: str = "quantity_g", digits: int = 1
) -> DataFrame:
    """Mean, standard deviation, median and row count of the ``k`` most frequent items.

    Counts and moments of all items come from one aggregate; only the rows of the ``k`` items go on, to their medians.
    """
    pair = ["item_code", "itemname"]
    rows = cons.select("item_code", nan_to_null(f"double({quantity})").alias("x"))
    moments = rows.groupBy("item_code").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.expr("var_pop(x) * count(x)").alias("square"),
    )
    named = na_lookup(moments, items.select(*pair), "item_code")
    # an item listed under one name several times has each of its rows as often
    pairs = named.groupBy(*pair, "rows", "n", "mean", "square").agg(F.count(F.lit(1)).alias("times"))
    pairs = pairs.withColumn("rows", F.col("rows") * F.col("times"))
    order = [F.desc("rows"), F.asc_nulls_last("item_code"), F.asc_nulls_last("itemname")]
    top = stage(pairs.orderBy(*order).limit(k), "top-items")
    own = stage(na_join(rows, top.select("item_code").distinct(), "item_code", "left_semi"), "top-rows")
    medians = group_median(own, ["item_code"], ["x"]).withColumnRenamed("x", "median")
    spread = F.expr("CASE WHEN n * times > 1 THEN sqrt(square * times / (n * times - 1)) END")
    return na_join(top.withColumn("sd", spread), medians, "item_code").select(
        *pair,
        *[
            round_half_even(f"nanvl({c}, CAST(NULL AS DOUBLE))", digits).alias(f"{c}_intake")
            for c in ("mean", "sd", "median")
        ],
        F.col("rows").alias("n"),
    )


def presentation_table(distribution: DataFrame, unit: str = "g") -> DataFrame:
    """The item distribution under display names, most frequent first."""
    return distribution.orderBy(F.desc("n"), "item_code", "itemname").select(
        F.col("itemname").alias("Food Item"),
        F.col("mean_intake").alias(f"Mean intake ({unit})"),
        F.col("sd_intake").alias("S.D."),
        F.col("median_intake").alias(f"Median intake ({unit})"),
        F.col("n").alias("n households"),
    )


def intake_histogram(
    cons: DataFrame, items: DataFrame | None = None, bins: int = 30, quantity: str = "quantity_g"
) -> DataFrame:
    """Counts in equal bins of the quantity, one histogram per item, empty bins included.

    The first bin is centred on the smallest value and the last on the largest; bins are closed on the right. An item whose
    values are all equal has one bin 0.1 wide; a single bin reaches from the smallest value to the largest. Missing and infinite
    values are left out. ``items`` restricts the items; the list is stored before the two passes over the rows.
    """
    rows = cons.select("item_code", F.col(quantity).cast("double").alias("x")).filter("abs(x) < double('Infinity')")
    if items is not None:
        rows = na_join(rows, stage(items.select("item_code").distinct(), "histogram-items"), "item_code", "left_semi")
    spans = rows.groupBy("item_code").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    sized = spans.selectExpr(
        "item_code",
        "low",
        f"CASE WHEN high = low THEN 0.1D ELSE (high - low) / {max(bins - 1, 1)} END AS width",
        f"CASE WHEN high = low THEN 1 ELSE {bins} END AS n_bins",
        "high = low AS equal",
    )
    first_edge = f"""CASE WHEN equal THEN floor((low - 0.05D) / 0.1D) * 0.1D + 0.05D
        WHEN {bins} = 1 THEN low ELSE low - width / 2 END"""
    grid = stage(sized.selectExpr("item_code", f"{first_edge} AS start", "width", "n_bins"), "histogram-grid")
    # The small shift keeps values that sit on a bin edge, up to rounding, in the lower bin.
    bin_no = F.expr("CAST(greatest(0, least(ceil((x - start) / width - 1e-8D) - 1, n_bins - 1)) AS INT)")
    counts = (
        na_join(rows, grid, "item_code", "inner")
        .groupBy("item_code", bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every_bin = grid.select(
        "item_code", "start", "width", F.explode(F.sequence(F.lit(0), F.col("n_bins") - 1)).alias("bin")
    )
    left = F.col("start") + F.col("bin") * F.col("width")
    return na_join(every_bin, counts, ["item_code", "bin"]).select(
        "item_code",
        "bin",
        left.alias("bin_from"),
        (left + F.col("width")).alias("bin_to"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
