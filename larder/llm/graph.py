"""Connected components of a graph of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b): the smallest id that can be reached.

    Every round hooks each node's neighbours on the smallest of them, first the larger neighbours, then the smaller ones, until
    all that is left is stars. Rounds grow with the logarithm of a component's size. Nothing is collected per node: the minimum
    is a partial aggregate, so a node with very many neighbours is no hot group. Each round is stored.
    """
    links = stage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("low").alias("a"), "b").filter("a <> b").distinct()
        large = stage(large, "large-star")
        low = large.groupBy("b").agg(F.min("a").alias("low"))
        small = large.join(low, "b").select(F.col("low").alias("x"), F.col("a").alias("y"), "b")
        small = small.select(F.explode(F.array(F.struct("x", F.col("y").alias("z")), F.struct("x", F.col("b").alias("z")))).alias("s"))
        links = stage(small.select(F.col("s.x").alias("a"), F.col("s.z").alias("b")).filter("a <> b").distinct(), "small-star")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    ids = links.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component"))
    return ids.unionByName(links.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())
