"""Mixing sources to target weights by capped water-filling.

Each source has a weight. The mix has a total size, which is poured over the sources in proportion to their weights; a source
that reaches its cap (``max_epochs`` times its own size) is clamped, and what it can't take is poured over the others, until
none is above its cap. That limit has a closed form: with sources ordered by cap / weight, the clamped ones are a prefix.

A source with target ``t`` and size ``s`` is taken ``floor(t / s)`` whole times. The rest is a fractional repetition: documents
are ordered by a seeded hash in ``BUCKETS`` buckets, the first buckets are repeated once more, and of the bucket on the border
every document gives the same leading share of its words. So a source's taken words miss its target by less than one word per
document of one bucket, and by no word that a cap forbids. Nothing is ordered globally but one row per source.

Everything is built-in DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import BLANK_CLASS, stage, with_rows, words

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20240229
BUCKETS = 1024


def size_of(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_CLASS.replace("[", "[^") + "+")), F.lit(0)).cast("long")


def bucket_of(doc_id: Column, seed: int) -> Column:
    """A bucket by the first digits of an MD5 digest, which any engine can compute; a null id has one like any other."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 3), 16, 10).cast("int"), F.lit(BUCKETS))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS, share: float = 1.0
) -> DataFrame:
    """Targets of a table (source, size) with one row per source.

    Sources by code point, null last, take the weights in turn. The mix holds ``share`` of all sizes, or what the caps allow.
    One row per source is ordered in one task; sources are the rows of a mixing recipe, not of the corpus.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    sources = sizes.withColumn("weight", weight).withColumn("cap", F.col("size") * F.lit(float(max_epochs)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = sources.withColumn("level", left / open_weight)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    flat = level.withColumn("level", F.first(fits, ignorenulls=True).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return flat.select("source", F.col("size").alias("source_size"), target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: float = MAX_EPOCHS,
    share: float = 1.0,
    seed: int = SEED,
    keep_rows: bool = False,
) -> DataFrame:
    """How many words of every document the mix takes.

    ``docs`` has doc_id, source and text; other columns don't matter. Returns one row per row of ``docs``: doc_id, size,
    source_size, target (of its source), taken, repeats (whole repetitions), part (words of the fractional one); with
    ``keep_rows`` the whole input row in ``row`` as well. Null sources are a source of their own; a null or empty text has size
    0 and is never taken; a source without words has target 0. Repeated rows are taken alike. An empty table gives an empty
    result. The outcome depends on the rows and the seed alone, so reruns agree. With ``keep_rows`` no copy of the texts is stored:
    ``docs``, a stored table or a cheap plan over one, is read twice and its words are counted twice.
    """
    rows = with_rows(docs)
    place = bucket_of(F.col("row")["doc_id"], seed)
    sized = rows.select(
        *(["row"] if keep_rows else []),
        F.col("row")["doc_id"].alias("doc_id"),
        F.col("row")["source"].alias("source"),
        size_of(F.col("row")["text"]).alias("size"),
        place.alias("bucket"),
    )
    if not keep_rows:
        sized = stage(sized, "mix-sizes")
    buckets = stage(sized.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "mix-buckets")
    targets = source_targets(buckets.groupBy("source").agg(F.sum("size").alias("size")), weights, max_epochs, share)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("repeats", whole)
    left = F.col("target") - F.col("repeats") * F.col("source_size")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        buckets.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .withColumnRenamed("source", "of")
        .join(targets, F.col("of").eqNullSafe(F.col("source")))
        .select(
            "of", F.col("bucket").alias("at"), "source_size", "target", "repeats",
            F.when(F.col("size") > 0, F.least(F.greatest((left - F.col("before")) / F.col("size"), F.lit(0.0)), F.lit(1.0)))
            .otherwise(0.0).alias("extra"),
        )
    )
    plan = stage(plan, "mix-plan")
    taken = sized.join(plan, (F.col("bucket") == F.col("at")) & F.col("source").eqNullSafe(F.col("of")))
    part = F.floor(F.col("extra") * F.col("size") + 0.5).cast("long")
    part = F.least(part, F.floor(F.col("size") * F.lit(float(max_epochs))).cast("long") - F.col("repeats") * F.col("size"))
    return taken.withColumn("part", part).select(
        *(["row"] if keep_rows else []),
        "doc_id", "size", "source_size", "target",
        (F.col("repeats") * F.col("size") + F.col("part")).alias("taken"), "repeats", "part",
    )


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row once per whole repetition, and once with the leading words of its fractional one.

    The columns are those of ``docs``. A part that is the whole document keeps its text unchanged; a shorter one has its words
    joined by single spaces. Documents of which nothing is taken are absent.
    """
    mixed = mix(docs, keep_rows=True, **options)
    text = F.col("row")["text"]
    cut = F.array_join(F.slice(words(text), 1, F.greatest(F.col("part").cast("int"), F.lit(0))), " ")
    whole = F.array_repeat(F.lit(-1), F.col("repeats").cast("int"))
    copies = F.when(F.col("part") > 0, F.concat(whole, F.array(F.lit(0)))).otherwise(whole)
    taken = mixed.filter("size > 0").withColumn("copy", F.explode(copies))
    new = F.when((F.col("copy") == 0) & (F.col("part") < F.col("size")), cut).otherwise(text)
    return taken.select(F.col("row").withField("text", new).alias("row")).select("row.*")
