"""Nearest neighbours by inner product: vantage-point trees per shard.

Largest inner product is smallest distance once vectors get one more component that brings all to the length of the longest, and
queries are scaled to that length: ``|q - x|^2 = 2 M^2 - 2 q x``. In that space the triangle inequality holds.

Vectors are dealt to the nearest of a bounded sample of pivots, and a pivot's vectors over as many shards of bounded size as it
needs, so a vector that very many rows share fills several shards. Each shard has one tree: a node splits its vectors at the
median distance from a vantage point. Every row is indexed.

A query searches a shard of its own pivot first, which bounds the distance of its last neighbour. With that bound it goes
only to shards, and in them only to subtrees, that the triangle inequality does not rule out. A lower bound is multiplied by
``factor`` before the comparison: 1 gives exact search, more skips subtrees that would hold neighbours only if they lay at the
bound. Queries meet a shard's tree in blocks of bounded size.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import stage, with_rows

NEIGHBOURS = 20
FACTOR = 1.1
#: Rows per shard, queries per block, vectors per leaf; pivots at most, a sample of the rows with the smallest hash of their id.
SHARD, BLOCK, LEAF, PIVOTS = 4096, 2048, 64, 256
#: Rounding of distances, relative to the length of the vectors.
ROUNDING = 1e-7


@dataclass
class Tree:
    """Vectors in the order of the leaves. Node: (vantage vector, median distance, inner child, outer child) or (first, last)."""

    ids: np.ndarray
    vectors: np.ndarray  # original
    points: np.ndarray  # with the added component
    nodes: list[tuple]

    @staticmethod
    def build(ids: np.ndarray, vectors: np.ndarray, length: float) -> Tree:
        rest = np.sqrt(np.maximum(length**2 - (vectors**2).sum(axis=1), 0))
        points = np.concatenate([vectors, rest[:, None]], axis=1)
        order: list[np.ndarray] = []
        nodes: list[tuple] = []
        placed = 0

        def grow(rows: np.ndarray) -> int:
            nonlocal placed
            at = len(nodes)
            nodes.append(())
            if len(rows) > LEAF:
                vantage = points[rows[0]]
                distance = np.sqrt(((points[rows] - vantage) ** 2).sum(axis=1))
                median = np.median(distance)
                inner = distance <= median
                if not inner.all():
                    nodes[at] = (vantage, median, grow(rows[inner]), grow(rows[~inner]))
                    return at
            order.append(np.sort(rows))
            nodes[at] = (placed, placed + len(rows))
            placed += len(rows)
            return at

        by_id = np.argsort(ids, kind="stable")
        ids, vectors, points = ids[by_id], vectors[by_id], points[by_id]
        grow(np.arange(len(ids)))
        rows = np.concatenate(order)
        return Tree(ids[rows], vectors[rows], points[rows], nodes)

    def dump(self) -> bytes:
        return pickle.dumps((self.ids, self.vectors, self.points, self.nodes))

    @staticmethod
    def load(data: bytes) -> Tree:
        return Tree(*pickle.loads(data))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, each summed in one and the same order, so that equal vectors have equal products."""
    return np.einsum("qd,xd->qx", q, x, optimize=False)


class Search:
    """The best ``k`` of one tree for a block of queries, given bounds on the distance of their last neighbour."""

    def __init__(self, tree: Tree, k: int, factor: float, length: float):
        self.tree, self.k, self.factor, self.length = tree, k, factor, length

    def run(self, ids: np.ndarray, vectors: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.query_ids, self.queries, self.bounds = ids, vectors, bounds.copy()
        self.norms = np.sqrt((vectors**2).sum(axis=1))
        scaled = vectors * (self.length / self.norms)[:, None]
        self.points = np.concatenate([scaled, np.zeros((len(ids), 1))], axis=1)
        self.scores = np.full((len(ids), self.k), -np.inf)
        self.found = np.full((len(ids), self.k), np.iinfo(np.int64).max)
        self.visit(0, np.arange(len(ids)))
        return self.scores, self.found

    def visit(self, node: int, rows: np.ndarray) -> None:
        if not len(rows):
            return
        entry = self.tree.nodes[node]
        if len(entry) == 2:
            self.leaf(*entry, rows)
            return
        vantage, median, inner, outer = entry
        distance = np.sqrt(((self.points[rows] - vantage) ** 2).sum(axis=1))
        gap = (distance - median) * self.factor
        near = gap <= 0
        slack = ROUNDING * self.length
        self.visit(inner, rows[near])
        self.visit(outer, rows[near & (-gap <= self.bounds[rows] + slack)])
        self.visit(outer, rows[~near])
        self.visit(inner, rows[~near & (gap <= self.bounds[rows] + slack)])

    def leaf(self, first: int, last: int, rows: np.ndarray) -> None:
        tree = self.tree
        scores = products(self.queries[rows], tree.vectors[first:last])
        scores[self.query_ids[rows][:, None] == tree.ids[None, first:last]] = -np.inf
        better = scores.max(axis=1) >= self.scores[rows, -1]
        rows, scores = rows[better], scores[better]
        if not len(rows):
            return
        ids = np.concatenate([self.found[rows], np.broadcast_to(tree.ids[first:last], scores.shape)], axis=1)
        scores = np.concatenate([self.scores[rows], scores], axis=1)
        ids = np.where(np.isneginf(scores), np.iinfo(np.int64).max, ids)
        by_id = np.argsort(ids, axis=1, kind="stable")
        ids, scores = np.take_along_axis(ids, by_id, 1), np.take_along_axis(scores, by_id, 1)
        best = np.argsort(-scores, axis=1, kind="stable")[:, : self.k]
        self.found[rows], self.scores[rows] = np.take_along_axis(ids, best, 1), np.take_along_axis(scores, best, 1)
        self.bounds[rows] = np.minimum(self.bounds[rows], distance_of(self.scores[rows, -1], self.norms[rows], self.length))


def distance_of(score: np.ndarray, norm: np.ndarray, length: float) -> np.ndarray:
    """Distance in the enlarged space that belongs to an inner product; infinite for a missing one."""
    return np.sqrt(np.maximum(2 * length**2 - 2 * score * (length / norm), 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def search(
    rows: DataFrame, is_query: str = "vec_id % 20 = 0", k: int = NEIGHBOURS, factor: float = FACTOR, shard: int = SHARD
) -> DataFrame:
    """One row per query and neighbour: query_id, rank (from 1), vec_id, score; ties in score to the smaller vec_id.

    ``rows`` has vec_id and embedding; other columns don't matter. ``is_query`` is SQL over vec_id. Rows with a null id, a null or
    zero vector, or one with null or non-finite components take no part; vectors are compared within their dimension only. A query has all
    candidates if there are fewer than ``k``, and no row without any. Repeated ids are rows of their own, but none is a
    neighbour of its own id. An empty table gives an empty result.
    """
    own = with_rows(rows).select(
        F.col("row")["vec_id"].cast("bigint").alias("vec_id"), F.col("row")["embedding"].cast("array<double>").alias("v")
    )
    own = own.filter("vec_id is not null").filter(usable(F.col("v"))).withColumn("size", F.size("v"))
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    sizes = own.groupBy("size").agg(F.count("*").alias("n"), F.max(square).alias("square")).collect()  # a row per dimension
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    results = [search_one(own.filter(F.col("size") == s.size), s.n, math.sqrt(s.square), is_query, k, factor, shard) for s in sizes]
    if not results:
        return own.sparkSession.createDataFrame([], schema)
    out = results[0]
    for other in results[1:]:
        out = out.unionByName(other)
    return out


def search_one(own: DataFrame, n: int, length: float, is_query: str, k: int, factor: float, shard: int) -> DataFrame:
    length = length * (1 + 1e-12)
    count = min(PIVOTS, -(-n // shard))
    sample = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(count).toArrow()
    vectors = matrix(sample.column("v"))
    rest = np.sqrt(np.maximum(length**2 - (vectors**2).sum(axis=1), 0))
    pivots = np.concatenate([vectors, rest[:, None]], axis=1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("v"))
                points = np.concatenate([x, np.sqrt(np.maximum(length**2 - (x**2).sum(axis=1), 0))[:, None]], axis=1)
                nearest = (points @ pivots.T).argmax(axis=1)  # all points have the same length
                yield batch.select(["vec_id", "v"]).append_column("pivot", pa.array(nearest.astype(np.int32)))

    dealt = stage(own.select("vec_id", "v").mapInArrow(deal, "vec_id bigint, v array<double>, pivot int"), "vectors")
    counts = dealt.groupBy("pivot").count().collect()  # a row per pivot
    parts = {c["pivot"]: -(-c["count"] // shard) for c in counts}
    first = dict(zip(parts, np.cumsum([0, *parts.values()]).tolist(), strict=False))
    place = F.create_map(*[F.lit(x) for p in parts for x in (p, first[p])])[F.col("pivot")]
    many = F.create_map(*[F.lit(x) for p in parts for x in (p, parts[p])])[F.col("pivot")]
    dealt = dealt.withColumn("shard", place + F.pmod(F.xxhash64("vec_id"), many).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        ids, x = table.column("vec_id").to_numpy(), matrix(table.column("v"))
        tree = Tree.build(ids, x, length)
        pivot = pivots[table.column("pivot")[0].as_py()]
        radius = float(np.sqrt(((tree.points - pivot) ** 2).sum(axis=1).max()))
        return pa.table({"shard": table.column("shard")[:1], "pivot": table.column("pivot")[:1], "radius": [radius], "tree": pa.array([tree.dump()], pa.binary())})

    trees = dealt.groupBy("shard").applyInArrow(build, "shard int, pivot int, radius double, tree binary")
    trees = stage(trees, "trees")
    shards = trees.select("shard", "pivot", "radius").toArrow()  # 16 bytes per shard of some thousand rows
    homes, radii = shards.column("pivot").to_numpy(), shards.column("radius").to_numpy()
    numbers = shards.column("shard").to_numpy()

    def look(trees_: pa.Table, queries: pa.Table) -> pa.Table:
        ids, x = queries.column("vec_id").to_numpy(), matrix(queries.column("v"))
        tree = Tree.load(trees_.column("tree")[0].as_py())
        scores, found = Search(tree, k, factor, length).run(ids, x, queries.column("bound").to_numpy())
        hit = scores > -np.inf
        return pa.table({"query_id": pa.array(np.repeat(ids, hit.sum(axis=1))), "vec_id": pa.array(found[hit]), "score": pa.array(scores[hit])})

    def ask(queries: DataFrame) -> DataFrame:
        """``queries``: shard, vec_id, v, bound. Blocks of a shard's queries each get a copy of its tree."""
        blocks = queries.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        copies = trees.join(blocks, "shard").select("shard", "tree", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        queries = queries.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
        pairs = copies.groupBy("shard", "block").cogroup(queries.select("shard", "block", "vec_id", "v", "bound").groupBy("shard", "block"))
        return pairs.applyInArrow(look, "query_id bigint, vec_id bigint, score double")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shards, but the one already searched, that may hold a neighbour within the bound."""
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"))
            norms = np.sqrt((x**2).sum(axis=1))
            points = np.concatenate([x * (length / norms)[:, None], np.zeros((len(x), 1))], axis=1)
            last = batch.column("last").fill_null(-math.inf).to_numpy(zero_copy_only=False)
            bounds = distance_of(last, norms, length)
            done = batch.column("shard").to_numpy()
            for a in range(0, len(x), 256):
                distance = np.sqrt(((points[a : a + 256, None, :] - pivots[None]) ** 2).sum(axis=2))
                low = (distance[:, homes] - radii[None]) * factor
                at, to = np.nonzero((low <= bounds[a : a + 256, None] + ROUNDING * length) & (numbers[None] != done[a : a + 256, None]))
                for i in range(0, len(at), 4096):
                    rows = at[i : i + 4096] + a
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array(numbers[to[i : i + 4096]], pa.int32()), "vec_id": batch.column("vec_id").take(pa.array(rows)),
                        "v": batch.column("v").take(pa.array(rows)), "bound": pa.array(bounds[rows]),
                    })

    queries = dealt.filter(is_query).select("shard", "vec_id", "v")
    nearby = stage(ask(queries.withColumn("bound", F.lit(float("inf")))), "first-neighbours")
    last = nearby.groupBy("query_id").agg(F.min("score").alias("last"), F.count("*").alias("n"))
    last = last.select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("last")).alias("last"))
    routed = queries.join(last, "vec_id", "left").select("shard", "vec_id", "v", "last")
    routed = stage(routed.mapInArrow(route, "shard int, vec_id bigint, v array<double>, bound double"), "routed")
    found = nearby.unionByName(ask(routed))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
