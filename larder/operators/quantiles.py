"""Exact order statistics of huge, skewed groups without sorting a large group in one task.

Rows are counted per (group, bucket), where the bucket is a fixed monotone function of the value, so the count combines on the
map side and its result is small. A running total over the buckets tells in which bucket each wanted rank lies. Only rows of
those buckets are read again and stored; a bucket that still holds too many differing values is split further, and the last step
orders the few values left. Quantiles take these steps for all groups, medians for groups too large to be ordered by a task. Nothing is sampled: the answers are exact for any
distribution. Weights are decimals, so no sum depends on the order of its rows. The input is read twice and no copy of it is
written, so it should be a stored table or a cheap plan over one.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.missing import is_missing, nan_to_null
from larder.operators.joins import na_join
from larder.sources.staging import stage

BUCKETS_PER_OCTAVE = 64
SPLITS = 1024
LARGEST_BUCKET = 1_000_000
#: Weights and their sums; a sum has ten digits more, and room for a share of three places.
WEIGHT, TOTAL, TARGET = "decimal(24,12)", "decimal(34,12)", "decimal(37,15)"
HALF = Decimal("0.5")
#: The two middle ranks of a count.
MIDDLES: dict[str, Callable[[Column], Column]] = {
    "lower": lambda total: total * F.lit(HALF),
    "upper": lambda total: total * F.lit(HALF) + F.lit(HALF),
}
BEYOND_EVERY_BUCKET = 1 << 20


def bucket_of(x: str, per_octave: int = BUCKETS_PER_OCTAVE) -> Column:
    """Monotone integer of a double: its sign and the binary logarithm of its size in ``per_octave`` steps."""
    size = (
        f"CASE WHEN abs({x}) = double('Infinity') THEN {BEYOND_EVERY_BUCKET}"
        f" ELSE floor(log2(abs({x})) * {per_octave}) + {1100 * per_octave} END"
    )
    return F.expr(f"CAST(CASE WHEN {x} = 0 THEN 0 WHEN {x} > 0 THEN {size} ELSE -({size}) END AS INT)")


def _split(x: str, low: str, high: str) -> Column:
    """Position of ``x`` between ``low`` and ``high`` in equal steps."""
    return F.expr(
        f"CASE WHEN {high} > {low} THEN CAST(floor(({x} - {low}) / ({high} - {low}) * {SPLITS - 1}) AS INT) ELSE 0 END"
    )


def _locate(counts: DataFrame, group: list[str], order: str, before: Column, wanted: Callable[[Column], Column]):
    """Per group the bucket in which each wanted cumulative weight is reached, and the weight before it.

    ``wanted`` turns the total weight into an array of (name, target) structs.
    """
    running = Window.partitionBy(*group).orderBy(order)
    whole = Window.partitionBy(*group)
    return (
        counts.withColumn("reached", (before + F.sum("weight").over(running)).cast(TOTAL))
        .withColumn("previous", F.coalesce(F.lag("reached").over(running), before))
        .withColumn("total", F.max("reached").over(whole))
        .withColumn("aim", F.explode(wanted(F.col("total"))))
        .filter((F.col("previous") < F.col("aim.target")) & (F.col("reached") >= F.col("aim.target")))
    )


def order_statistics(
    df: DataFrame,
    x: str,
    targets: dict[str, Callable[[Column], Column]],
    by: list[str] = (),
    weight: str | None = None,
    largest_bucket: int = LARGEST_BUCKET,
) -> DataFrame:
    """Per group and target the smallest value whose cumulative weight reaches ``target(total weight)``.

    Rows without a value are left out; a value without a weight is an error. ``target`` must keep to decimals. No task orders
    more than ``largest_bucket`` rows of one group, unless they are equal. Returns one row per group with a column per target.
    """
    everyone = "__everyone"
    group = list(by) or [everyone]
    w = F.lit(1)
    if weight is not None:
        w = F.expr(f"coalesce(double({weight}), double(raise_error('missing weight in {weight}')))")
    base = (
        df.withColumn(everyone, F.lit(0))
        .filter(~is_missing(f"double({x})"))
        .select(*group, F.col(x).cast("double").alias("x"), w.cast(WEIGHT).alias("weight"))
    )
    return _bucketed(base, group, targets, largest_bucket).drop(everyone)


def measures() -> list[Column]:
    return [
        F.sum("weight").cast(TOTAL).alias("weight"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        F.count(F.lit(1)).alias("n"),
    ]


def _bucketed(base: DataFrame, group: list[str], targets: dict, largest_bucket: int) -> DataFrame:
    """Each group by counting buckets, then ordering the buckets that matter."""
    base = base.withColumn("bucket", bucket_of("x"))

    def wanted(total: Column) -> Column:
        pairs = [F.struct(F.lit(k).alias("name"), fn(total).cast(TARGET).alias("target")) for k, fn in targets.items()]
        return F.array(*pairs)

    first = base.groupBy(*group, "bucket").agg(*measures())
    spot = stage(
        _locate(first, group, "bucket", F.lit(0).cast(TOTAL), wanted).select(
            *group, "bucket", "aim.name", "aim.target", F.col("previous").alias("before"), "low", "high", "n"
        ),
        "quantile-buckets",
    )
    place = [*group, "bucket"]
    inside = stage(na_join(base, spot.select(*place).distinct(), place, "left_semi"), "quantile-candidates")
    return resolve(inside, spot, group, place, list(targets), largest_bucket)


def resolve(
    base: DataFrame, spot: DataFrame, group: list[str], place: list[str], names: list[str], largest_bucket: int | None = LARGEST_BUCKET
) -> DataFrame:
    """The wanted values, one column per name, from the stored rows (``place``, x, weight) of the buckets that hold them.

    ``spot`` has a row per ``place``, name and target: the weight ``before`` the bucket, and its low, high and n. Without
    ``largest_bucket`` the buckets are known to be small, and none is looked at for splitting.
    """
    keys = [*place, "name", "target"]

    def candidates(spot: DataFrame) -> DataFrame:
        return na_join(base, spot, place, "inner").filter(F.col("x").between(F.col("low"), F.col("high")))

    while largest_bucket is not None and _needs_split(spot, largest_bucket):
        parts = (
            candidates(spot)
            .withColumn("part", _split("x", "low", "high"))
            .groupBy(*keys, "before", "part")
            .agg(*measures())
        )
        aim = F.array(F.struct(F.col("name"), F.col("target")))
        spot = stage(
            _locate(parts, [*group, "name"], "part", F.col("before"), lambda _: aim).select(
                *keys, F.col("previous").alias("before"), "low", "high", "n"
            ),
            "quantile-parts",
        )

    values = candidates(spot).groupBy(*keys, "before", "x").agg(F.sum("weight").cast(TOTAL).alias("weight"))
    order = Window.partitionBy(*group, "name").orderBy("x")
    reached = values.withColumn("reached", (F.col("before") + F.sum("weight").over(order)).cast(TOTAL))
    hits = reached.filter(F.col("reached") >= F.col("target"))
    return hits.groupBy(*group).agg(*[F.min(F.when(F.col("name") == k, F.col("x"))).alias(k) for k in names])


def _needs_split(spot: DataFrame, largest_bucket: int) -> bool:
    """Whether any located bucket still holds too many rows of differing values (one boolean reaches the driver)."""
    return not spot.filter((F.col("n") > largest_bucket) & (F.col("low") < F.col("high"))).isEmpty()


def weighted_quantile(
    df: DataFrame, x: str, weight: str, probs=(0.2, 0.4, 0.6, 0.8), by: str | None = None, **options
) -> DataFrame:
    """Weighted quantiles: the smallest value whose share of the total weight is at least ``p``.

    Columns are named q20, q40, ... With ``by`` there is a row per non-NULL group, all from one set of passes.
    """
    targets = {f"q{round(p * 100):02d}": (lambda total, p=Decimal(str(p)): total * F.lit(p)) for p in probs}
    if by is not None:
        df = df.filter(F.col(by).isNotNull())
    return order_statistics(df, x, targets, [by] if by else [], weight, **options)


def group_median(
    df: DataFrame, key: list[str], columns: list[str], largest_bucket: int = LARGEST_BUCKET
) -> DataFrame:
    """Exact median of each column per group (mean of the two middle values), all columns in the same passes.

    Groups of up to ``largest_bucket`` rows are ordered, each by one task, which takes one exchange of their values. Larger groups go by
    counting buckets. A group without any value has no row; the mean of -Infinity and Infinity is NULL.
    """
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    large = stage(sizes.filter(F.col("__n") > largest_bucket).select(*key), "large-groups")
    if large.isEmpty():
        return _ordered_medians(df, key, columns)
    few, many = (na_join(df, large, key, how) for how in ("left_anti", "left_semi"))
    return _ordered_medians(few, key, columns).unionByName(_counted_medians(many, key, columns, largest_bucket))


def _ordered_medians(df: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """The medians of groups that a task can order."""
    xs = [f"__x{i}" for i in range(len(columns))]
    rows = df.select(*key, *[nan_to_null(f"double({c})").alias(x) for c, x in zip(columns, xs, strict=True)])
    rows = rows.filter(" OR ".join(f"{x} IS NOT NULL" for x in xs))
    whole = Window.partitionBy(*key)
    for x in xs:
        rows = rows.withColumn(f"{x}_rank", F.row_number().over(whole.orderBy(F.col(x).asc_nulls_last())))
        rows = rows.withColumn(f"{x}_n", F.count(x).over(whole))
    middles = [
        F.expr(f"max(CASE WHEN {x}_rank = {rank} THEN {x} END)").alias(f"{x}_{name}")
        for x in xs
        for name, rank in (("lower", f"({x}_n + 1) div 2"), ("upper", f"{x}_n div 2 + 1"))
    ]
    found = rows.groupBy(*key).agg(*middles)
    return found.select(*key, *[_middle(f"{x}_lower", f"{x}_upper").alias(c) for c, x in zip(columns, xs, strict=True)])


def _counted_medians(df: DataFrame, key: list[str], columns: list[str], largest_bucket: int) -> DataFrame:
    """The medians of groups of any size, by counting buckets."""
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), nan_to_null(f"double({c})").alias("x")) for c in columns])
    melted = (
        df.select(*key, F.explode(cells).alias("cell"))
        .select(*key, "cell.*", F.lit(1).cast(WEIGHT).alias("weight"))
        .filter(F.col("x").isNotNull())
    )
    return widen_medians(_bucketed(melted, [*key, "variable"], MIDDLES, largest_bucket), key, columns)


def _middle(lower: str, upper: str) -> Column:
    return F.expr(f"CASE WHEN {lower} = {upper} THEN {lower} ELSE nanvl(({lower} + {upper}) / 2, NULL) END")


def widen_medians(found: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """A column per variable from rows (key, variable, lower, upper)."""
    return (
        found.withColumn("median", _middle("lower", "upper"))
        .groupBy(*key)
        .agg(*[F.max(F.when(F.col("variable") == c, F.col("median"))).alias(c) for c in columns])
    )
