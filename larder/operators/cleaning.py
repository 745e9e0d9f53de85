"""Outlier removal and imputation of consumed quantities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.missing import log10_ieee, nan_to_null, safe_div, times
from larder.operators.histogram import MomentHistogram
from larder.operators.joins import na_join
from larder.operators.quantiles import group_median
from larder.sources.staging import stage


def rescale(df: DataFrame, by: str, columns: list[str], to_unit: bool) -> DataFrame:
    """Divide the columns by ``by`` (``to_unit``) or multiply them back; undefined results are NULL."""
    op = safe_div if to_unit else times
    return df.withColumns({c: op(c, by) for c in columns})


def log_cutpoints(df: DataFrame, key: str, x: str, k: float = 3) -> DataFrame:
    """Per group the mean plus ``k`` standard deviations of log10; NULL where either is undefined."""
    log = log10_ieee(x)
    stats = df.groupBy(key).agg(F.avg(log).alias("mean_log"), F.stddev_samp(log).alias("sd_log"))
    return stats.select(key, nan_to_null(f"mean_log + {k} * sd_log").alias("upper_cut"))


def outlier_log_sd(df: DataFrame, key: str, x: str, k: float = 3, cuts: DataFrame | None = None) -> DataFrame:
    """Blank values whose log10 lies above mean plus ``k`` deviations of their group; without such a cut point they stay.

    ``cuts`` (key, upper_cut) are the cut points if they are known.
    """
    if cuts is None:
        cuts = stage(log_cutpoints(df, key, x, k), "cutpoints")
    kept: Column = F.when(log10_ieee(x) > F.col("upper_cut"), F.lit(None)).otherwise(F.col(x))
    return na_join(df, cuts, key).withColumn(x, kept).drop("upper_cut")


def blank_where_missing(df: DataFrame, column: str, where: str) -> DataFrame:
    """NULL in ``column`` wherever ``where`` is missing."""
    return df.withColumn(column, F.when(F.col(where).isNotNull(), F.col(column)))


def impute_group_median(df: DataFrame, key: str, columns: list[str], **options) -> DataFrame:
    """Fill missing values with the median of their group; a group without any value stays missing."""
    return fill_missing(df, key, columns, stage(group_median(df, [key], columns, **options), "medians"))


def fill_missing(df: DataFrame, key: str, columns: list[str], fill: DataFrame) -> DataFrame:
    """Fill missing values from the row of ``fill`` (key, columns) of their group."""
    filled = na_join(df, fill.withColumnsRenamed({c: f"__fill_{c}" for c in columns}), key)
    return filled.withColumns({c: F.coalesce(nan_to_null(c), f"__fill_{c}") for c in columns}).drop(
        *[f"__fill_{c}" for c in columns]
    )


def replace_outliers(df: DataFrame, key: str, columns: list[str], k: float = 3, **median_options) -> DataFrame:
    """Values of the first column above its group's cut point, and the other columns of such rows, become their group's median.

    So does whatever is missing in the first column, and what is missing in the others. Same rows as ``outlier_log_sd``,
    ``blank_where_missing`` and ``impute_group_median`` in turn, but cut points and medians come from one histogram: ``df`` is read
    once for it, once for the few buckets that hold a cut point or a middle rank, and once for the result.
    """
    x = columns[0]
    histogram = MomentHistogram(df, [key], columns, log=True)
    cuts = stage(histogram.cut_points(k), "cutpoints")
    medians = stage(histogram.medians_below_cut(cuts, **median_options), "medians")
    kept = outlier_log_sd(df, key, x, cuts=cuts)
    for column in columns[1:]:
        kept = blank_where_missing(kept, column, where=x)
    return fill_missing(kept, key, columns, medians)
