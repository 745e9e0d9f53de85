"""MinHash near-duplicate detection by an LSH forest.

A document's set is its distinct word shingles; two documents are linked if the Jaccard similarity of their sets reaches the
threshold. Documents with equal sets are one node from the start.

The forest is several orders of one signature: order ``t`` sorts documents by the signature read from its position
``ROOT * t`` on. Documents next to each other in an order share the longest prefix of signature values. A region is a run that
shares the first ``ROOT`` values. In a region of up to ``SMALL`` documents all are candidates of each other. In a larger one the depth
adapts: a document's candidates are its ``NEAR`` neighbours, those with the longest common prefix.

What the neighbours of a large region connect is one component, and nothing needs to be known inside it. Where a region still holds several
components, its documents are taken up again with exact keys. Two sets of similarity ``s`` have ``s / (1 + s)`` of their summed sizes in common, so
in one order of all shingles, rarest first, their first common shingle is among the first ``size - common + 1`` of both. A document emits
that many shingles for each class of partner sizes; the finer the classes, the fewer. Documents that share a key with few others are paired. Where many
share one, as edits of one text do that are just too far apart, their sets go to tasks in blocks, every two blocks to one, and only links come
back: no pair is made. Such documents share hundreds of keys, so what long lists of documents connect is a family, whose sets meet once instead of once
a key, unless its lists are so loosely chained that all of them together take fewer rows. Components are found again at the end.

Candidates are links only after an exact check on the full sets.

A pair of similarity 0.8 shares the first 4 values in none of the 24 orders with probability (1 - 0.8 ** 4) ** 24 = 3e-6. Candidates whose signatures
agree by ``DEVIATIONS`` standard deviations less than the threshold are not checked, which loses a link with probability 3e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stage, tidy, with_rows
from larder.llm.graph import components
from larder.llm.shingles import Powers, Windows, mix, text_blocks

SHINGLE = 5
THRESHOLD = 80  # per cent
ORDERS, ROOT, DEPTH = 24, 4, 10
SIZE = ORDERS * ROOT
SMALL, NEAR = 12, 3
#: Bytes of text that a task hashes at once.
BLOCK = 1_000_000
DEVIATIONS = 5.4
#: Sizes of a class differ by this factor at most; numbers that shingles are counted under, to order them.
CLASS_RATIO, COUNTERS = 1.03, 1 << 18
#: Documents of a key that are paired one by one; of more, sets and shingles that a block holds, and columns of a matrix.
TOGETHER, BLOCK_SETS, BLOCK_CELLS, COLUMNS = 32, 1024, 1_000_000, 2048
SEEDS = mix(np.arange(1, 2 * SIZE + 1, dtype=np.uint64))
FACTORS = (SEEDS[:SIZE] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
ROUND = np.uint32(0x2C1B3C6D)
TERMS = (SEEDS[SIZE:] >> np.uint64(32)).astype(np.uint32)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``SIZE`` minima per set, none of them empty."""
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.append(0, np.cumsum([len(s) for s in sets])[:-1])

    def lowest(a: np.uint32, b: np.uint32) -> np.ndarray:
        """Two rounds: with one multiplication alone the orders would depend on each other."""
        x = (values ^ b) * a
        x ^= x >> np.uint32(15)
        x *= ROUND
        return np.minimum.reduceat(x, starts)

    return np.stack([lowest(a, b) for a, b in zip(FACTORS, TERMS, strict=True)], axis=1)


def sketch(shingle: int):
    """Per document its number of shingles, a fingerprint of its set, and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for a, texts in text_blocks(batch.column("text"), BLOCK):
                sets = Windows([(t or b"").lower() for t in texts], powers).sets(shingle)
                full = [i for i, s in enumerate(sets) if len(s)]
                rows = dict(zip(full, signatures([sets[i] for i in full]), strict=True)) if full else {}
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(a, len(texts)),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "print": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    "signature": pa.array([rows[i].astype(">u4").tobytes() if i in rows else None for i in range(len(sets))], pa.binary()),
                })

    return run


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of one sorted part of the orders; a part boundary costs its pairs one of the orders."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    ids = np.concatenate([b.column("id").to_numpy() for b in held])
    keys = b"".join(k for b in held for k in b.column("key").to_pylist())
    region = np.frombuffer(keys, np.uint8).reshape(len(ids), -1)[:, : 1 + 4 * ROOT]
    cuts = np.flatnonzero((region[1:] != region[:-1]).any(axis=1)) + 1
    starts = np.append(0, cuts)
    sizes = np.diff(np.append(starts, len(ids)))
    number = np.repeat(np.arange(len(sizes)), sizes)
    reach = np.where(sizes <= SMALL, SMALL, NEAR)[number]
    pairs = []
    for k in range(1, SMALL):
        at = np.flatnonzero((number[k:] == number[:-k]) & (reach[:-k] >= k))
        pairs.append(np.stack([ids[at], ids[at + k]]))
    found = np.unique(np.sort(np.concatenate(pairs, axis=1), axis=0), axis=1)
    found = found[:, found[0] != found[1]]
    yield pa.RecordBatch.from_pydict({"a": pa.array(found[0]), "b": pa.array(found[1])})


def agreement(threshold: int):
    """Keeps the pairs whose signatures agree often enough, with the share that agrees."""
    least = threshold / 100 - DEVIATIONS * (threshold / 100 * (1 - threshold / 100) / SIZE) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, SIZE) for c in ("x", "y"))
                share = (x == y).mean(axis=1)
                batch = batch.select(["a", "b"]).append_column("share", pa.array(share))
                yield batch.filter(pa.array(share >= least))

    return run


def size_classes(most: int = 1 << 40) -> np.ndarray:
    """The smallest size of each class."""
    firsts = [1]
    while firsts[-1] < most:
        firsts.append(max(firsts[-1] + 1, int(firsts[-1] * CLASS_RATIO)))
    return np.array(firsts)


def counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(11)).astype(np.int64) % COUNTERS


def count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(counter, n) of the sets of a task."""
    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for s in batch.column("set"):
            at, n = np.unique(counter(np.frombuffer(s.as_buffer(), np.uint64)), return_counts=True)
            counts[at] += n
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"counter": pa.array(at), "n": pa.array(counts[at])})


def first_shingles(n: int, threshold: int, firsts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(class of the smaller set, class of the larger, shingles to emit) for a set of ``n``, as the smaller of a pair and as the larger."""
    own, low, high = np.searchsorted(firsts, [n, -(-n * threshold // 100), n * 100 // threshold], "right") - 1

    def emitted(partner: int) -> int:
        common = -(-threshold * (n + partner) // (100 + threshold))
        return max(n - common + 1, 0)

    for c in range(own, high + 1):
        yield own, c, emitted(max(int(firsts[c]), n))
    for c in range(low, own + 1):
        yield c, own, emitted(max(int(firsts[c]), -(-n * threshold // 100)))


def exact_keys(threshold: int, counts: np.ndarray):
    """(key, id, component, size): the rarest shingles of each set, as many as a link with a set of each class of sizes needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = size_classes()
        held, ids, components_, cells, size = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            sizes = [len(k) for k in held]
            out = {"key": pa.array(np.concatenate(held))}
            for name, values in (("id", ids), ("component", components_), ("size", cells)):
                out[name] = pa.array(np.repeat(values, sizes))
            for values in (held, ids, components_, cells):
                values.clear()
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            for i, own, s in zip(batch.column("id"), batch.column("component"), batch.column("set"), strict=True):
                values = np.frombuffer(s.as_buffer(), np.uint64)
                values = values[np.lexsort((values, counts[counter(values)]))]
                parts = []
                for small, large, n in first_shingles(len(values), threshold, firsts):
                    parts.append(mix(values[:n] ^ mix(np.array([small * 4096 + large + 1], np.uint64))[0]))
                held.append(np.unique(np.concatenate(parts)).view(np.int64))
                ids.append(i.as_py())
                components_.append(own.as_py())
                cells.append(len(values))
                size += len(held[-1])
                if size >= BLOCK:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def full_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for a, texts in text_blocks(batch.column("text"), BLOCK):
                sets = [s.tobytes() for s in Windows([(t or b"").lower() for t in texts], powers).sets(shingle)]
                yield pa.RecordBatch.from_pydict({"id": batch.column("id").slice(a, len(texts)), "set": pa.array(sets, pa.binary())})

    return run


def confirmed(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def links_in_block(threshold: int):
    """The links of two blocks of sets (own = i and own = j), or of one (i = j), between different components: common shingles are counted by
    products of matrices, some columns at a time. A shingle of one set only is in no intersection and gets no column."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("set")]
        own, ids, component = (table.column(c).to_numpy() for c in ("own", "id", "component"))
        size = np.array([len(s) for s in sets])
        first = np.flatnonzero(own == table.column("i")[0].as_py())
        second = np.flatnonzero(own == table.column("j")[0].as_py())
        _, column, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        place = np.cumsum(n > 1) - 1
        row, shared = np.repeat(np.arange(len(sets)), size), (n > 1)[column]
        row, column = row[shared], place[column[shared]]
        both = np.zeros((len(first), len(second)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for begin in range(0, int(place[-1]) + 1, COLUMNS):
            x, y = np.searchsorted(column, [begin, begin + COLUMNS])
            part = np.zeros((len(sets), COLUMNS), np.float32)
            part[row[x:y], column[x:y] - begin] = 1
            both += part[first] @ part[second].T
        linked = 100 * both >= threshold * (size[first][:, None] + size[second][None, :] - both)
        linked &= component[first][:, None] != component[second][None, :]
        a, b = np.nonzero(linked)
        a, b = ids[first[a]], ids[second[b]]
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    return run


def units_of(lists: DataFrame, sets: DataFrame, blocks: Column) -> DataFrame:
    """(of, unit, id, component, blocks): the documents of ``lists`` (key, id, component, n, cells, least) whose ``sets`` are to meet, by family if that takes
    no more rows than its keys do, else by key. ``blocks`` is the number of blocks that n documents with cells shingles are cut to."""
    chained = components(lists.filter("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct())
    family = stage(chained.withColumnRenamed("component", "unit"), "families")
    of_keys = lists.select("key", "n", "cells", "least").distinct().join(family.withColumnRenamed("id", "least"), "least")
    of_keys = of_keys.groupBy("unit").agg(F.sum(F.col("n") * blocks).alias("by_key"))
    whole = sets.select("id", "component", (F.length("set") / 8).alias("size")).join(family, "id")
    cut = whole.groupBy("unit").agg(F.count("*").alias("n"), F.sum("size").alias("cells")).withColumn("blocks", blocks).join(of_keys, "unit")
    cut = stage(cut.select("unit", "blocks", (F.col("n") * F.col("blocks") <= F.col("by_key")).alias("at_once")), "family-blocks")
    together = whole.join(cut.filter("at_once"), "unit").select(F.lit("family").alias("of"), "unit", "id", "component", "blocks")
    loose = family.join(cut.filter("not at_once"), "unit").select(F.col("id").alias("least"))
    apart = lists.join(loose, "least", "left_semi").select(F.lit("key").alias("of"), F.col("key").alias("unit"), "id", "component", blocks.alias("blocks"))
    return together.unionByName(apart)


def link(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept (it is its own).

    ``docs`` has doc_id and text; other columns don't matter. A document without words has no shingles and no link; one with fewer
    words than a shingle has its whole sequence as its one. Rows of one doc_id are one document. A null doc_id is linked with
    nothing: its component_id is null and it is kept. An empty table gives an empty result. ``threshold`` is over 50 per cent.
    """
    if not 50 < threshold <= 100:
        raise ValueError("sets of one shingle can be linked with others only up to a threshold of 50 per cent, which is not looked for")
    rows = with_rows(docs).select(
        F.col("row")["doc_id"].cast("bigint").alias("doc_id"), F.col("row")["text"].cast("binary").alias("text")
    )
    schema = "doc_id bigint, n_shingles bigint, print binary, signature binary"
    sketches = stage(rows.mapInArrow(tidy(sketch(shingle)), schema), "sketches")
    known = sketches.filter("doc_id is not null and n_shingles > 0")
    copies = known.groupBy("print").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    copies = stage(copies.select("print", "first"), "copies")
    named = known.join(copies, "print", "left").withColumn("id", F.coalesce("first", "doc_id"))
    # a set of one shingle has no near copy but its equals
    nodes = stage(named.filter("id = doc_id and n_shingles > 1").select("id", "signature").distinct(), "nodes")

    order = F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1)))
    doubled = F.concat("signature", "signature")
    key = F.concat(F.unhex(F.lpad(F.hex("t"), 2, "0")), F.substring(doubled, F.col("t") * 4 * ROOT + 1, F.lit(4 * DEPTH)))
    forest = nodes.withColumn("t", order).select("id", key.alias("key"))
    in_order = forest.repartitionByRange("key").sortWithinPartitions("key")
    near = in_order.mapInArrow(tidy(neighbours), "a bigint, b bigint").distinct()

    sides = [nodes.select(F.col("id").alias(i), F.col("signature").alias(s)) for i, s in (("a", "x"), ("b", "y"))]

    def likely(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "x", "y")
        return joined.mapInArrow(tidy(agreement(threshold)), "a bigint, b bigint, share double")

    candidates = stage(likely(near), "candidates")
    root = F.xxhash64("t", F.substring(doubled, F.col("t") * 4 * ROOT + 1, F.lit(4 * ROOT)))
    regions = nodes.withColumn("t", order).select("id", root.alias("region"))
    large = regions.groupBy("region").count().filter(F.col("count") > SMALL).select("region")
    members = stage(regions.join(large, "region"), "members")

    # the full sets of all documents that can be in a pair, from one pass over the texts
    wanted = candidates.select(F.explode(F.array("a", "b")).alias("id")).unionByName(members.select("id")).distinct()
    texts = rows.withColumnRenamed("doc_id", "id").join(stage(wanted, "wanted"), "id", "left_semi")
    sets = stage(texts.mapInArrow(tidy(full_sets(shingle)), "id bigint, set binary"), "sets")
    full = [sets.select(F.col("id").alias(i), F.col("set").alias(s)) for i, s in (("a", "x"), ("b", "y"))]

    def check(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(full[0], "a").join(full[1], "b").select("a", "b", "x", "y")
        return stage(joined.mapInArrow(tidy(confirmed(threshold)), "a bigint, b bigint").distinct(), "links")

    def apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
        """The pairs that are not in one component yet."""
        for end in ("a", "b"):
            pairs = pairs.join(joined.select(F.col("id").alias(end), F.col("component").alias(f"{end}_in")), end, "left")
        return pairs.filter(F.coalesce("a_in", "a") != F.coalesce("b_in", "b")).select("a", "b")

    # each document's likeliest pairs first; of the others only those can matter that these don't connect
    best = [candidates.groupBy(e).agg(F.max_by(o, F.struct("share", o)).alias(o)).select("a", "b") for e, o in (("a", "b"), ("b", "a"))]
    links = check(best[0].unionByName(best[1]).distinct())
    joined = stage(components(links), "components")
    links = links.unionByName(check(apart(candidates, joined)))
    joined = stage(components(links), "components")

    # large regions that hold several components: exact keys for their documents
    placed = members.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    several = placed.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("region")
    open_ = stage(placed.join(several, "region").select("id", "component").distinct(), "open-nodes")
    met = stage(sets.join(open_, "id"), "open-sets")
    counts = np.zeros(COUNTERS, np.int64)
    for row in met.select("set").mapInArrow(tidy(count_shingles), "counter bigint, n bigint").groupBy("counter").agg(F.sum("n").alias("n")).collect():
        counts[row["counter"]] = row["n"]  # at most ``COUNTERS`` rows
    keys = stage(met.mapInArrow(tidy(exact_keys(threshold, counts)), "key bigint, id bigint, component bigint, size bigint"), "exact-keys")
    agg = [F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"), F.sum("size").alias("cells"), F.min("id").alias("least")]
    mixed = keys.groupBy("key").agg(*agg).filter("low < high").select("key", "n", "cells", "least")
    keys = stage(keys.join(mixed, "key"), "mixed-keys")

    few = keys.filter(F.col("n") <= TOGETHER)
    a, b = (few.select("key", F.col("id").alias(i), F.col("component").alias(f"{i}_in")) for i in "ab")
    exact = likely(a.join(b, "key").filter("a < b and a_in <> b_in").select("a", "b").distinct())
    more = check(exact.select("a", "b"))

    # longer lists: blocks of documents, every two of which meet in a task of their own with their sets, and only links come out
    blocks = F.greatest(F.ceil(F.col("cells") / BLOCK_CELLS), F.ceil(F.col("n") / BLOCK_SETS)).cast("int")
    units = stage(units_of(keys.filter(F.col("n") > TOGETHER), met, blocks), "units")
    many = units.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    many = many.select("of", "unit", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "component")
    met = met.select("id", "set").join(many, "id").groupBy("of", "unit", "i", "j")
    inside = met.applyInArrow(links_in_block(threshold), "a bigint, b bigint")
    more = stage(more.unionByName(inside).distinct(), "exact-links")
    if more.limit(1).count():
        joined = stage(components(links.unionByName(more)), "components")

    labels = joined.withColumnRenamed("id", "first").withColumnRenamed("component", "label")
    out = sketches.select("doc_id", "n_shingles", "print").join(copies, "print", "left")
    out = out.withColumn("first", F.coalesce("first", "doc_id")).join(labels, "first", "left")
    # rows of one doc_id with different sets are one node of the graph, and its label is that of the id
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "first"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its component, with their columns as they were."""
    gone = stage(link(docs, **options).filter("not kept").select(F.col("doc_id").alias("gone")).distinct(), "near-copies")
    rows = with_rows(docs)
    return rows.join(gone, rows["row"]["doc_id"] == gone["gone"], "left_anti").select("row.*")
