"""Scoring documents by language models: prediction by partial matching over bytes, beside a unigram word model.

A text is the sequence of its lower-cased words, each closed by a space, and an end mark. The byte model predicts each byte from
the up to ``ORDER`` bytes before it: of the whole text, or of its word alone (``across``). The former is the model of a text, in which the
order of words counts; the latter one of words, whose sum over a text it gives.

The model is a trie of byte contexts with the counts of the bytes that followed in all training documents. A byte not seen in a
context is reached by escape to the context shorter by one byte (method C: the escape counts as often as there are different
bytes), from which the bytes seen in the longer context are excluded. After the empty context, the bytes left are equally likely.
As the bytes seen after a context were also seen after its every suffix, one number per context holds what exclusion leaves.

Every counted gram (a context and the byte that follows) is kept, so the model grows with the corpus; it is a table and never gathered in
one place. The code length of a byte depends on its gram alone. Each block of documents lists its distinct grams and deals them by the end of
their contexts, two bytes or, where those are frequent, as many more as it takes. A task so has its contexts from that length on whole; of shorter
contexts there are at most 65,792 entries in any corpus, and 256 for each frequent one, and every task gets those. Code lengths go back to
the blocks in the order of their grams. Word counts are shuffled, too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import give_back, stage, tidy, with_rows
from larder.llm.shingles import blocks

ORDER = 5
#: Bytes of text per block.
BLOCK = 16_000_000
#: Bytes whose grams are made at once.
BYTES_AT_ONCE = 500_000
#: Words whose texts are put together at once.
WORDS_AT_ONCE = 100_000
#: Grams of parts that are held before they are merged.
HELD = 500_000
END = b"\n"
#: Contexts up to this length are few and go to every task; grams are dealt by one byte more, or by several where a context is frequent.
SHORT = 1
#: Grams of blocks per task that works out code lengths.
GRAMS_AT_ONCE = 250_000
#: A context is frequent if it has more than ``GRAMS_AT_ONCE`` of the blocks' grams and more than this part of them.
FREQUENT = 1000


class Numbers(dict):
    """Numbers keys in the order of their first look-up."""

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        return number


def pack_array(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def unpack_array(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them."""
    return pack_array(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_array(data, "<u8"), dtype=np.uint64)


BLOCK_SCHEMA = "block bigint, word binary, number int, n_train bigint, doc_ids binary, trains binary, lengths binary, numbers binary, vocabulary binary, grams binary, gram_counts binary"
BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("word", pa.binary()), ("number", pa.int32()), ("n_train", pa.int64()),
    ("doc_ids", pa.binary()), ("trains", pa.binary()), ("lengths", pa.binary()), ("numbers", pa.binary()),
    ("vocabulary", pa.binary()), ("grams", pa.binary()), ("gram_counts", pa.binary()),
])


def split_blocks(order: int, across: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return blocks_of(batches, order, across)

    return run


def blocks_of(batches: Iterator[pa.RecordBatch], order: int, across: bool) -> Iterator[pa.RecordBatch]:
    """Per block of documents a row for each different word with its count in training documents, and one with the documents.

    The latter also holds the block's words, and the distinct grams of its texts, or of its words, with the counts in training documents.
    """
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        texts = batch.column("text").to_pylist()
        valid = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
        trains = batch.column("trains").to_numpy(zero_copy_only=False).astype(np.int8)
        for a, b in blocks(texts, BLOCK):
            numbers = Numbers()
            rows = []
            for i in range(a, b):
                ws = (texts[i] or b"").lower().split()
                texts[i] = None
                ws.append(END)
                rows.append(np.fromiter(map(numbers.__getitem__, ws), np.int32, len(ws)))
            lengths = np.array([len(r) for r in rows], np.int32)
            tokens = np.concatenate(rows)
            del rows
            counts = np.bincount(tokens, np.repeat(trains[a:b], lengths), len(numbers)).astype(np.int64)
            vocabulary = list(numbers)
            numbers.clear()
            words, n = pa.array(vocabulary, pa.binary()), len(vocabulary)
            for i in range(0, n, WORDS_AT_ONCE):
                part = words.slice(i, WORDS_AT_ONCE)
                m = len(part)
                number = np.arange(i, i + m, dtype=np.int32)
                head = [pa.array(np.full(m, block)), part, pa.array(number), pa.array(counts[i : i + m])]
                yield pa.RecordBatch.from_arrays([*head, *[pa.nulls(m, pa.binary())] * 7], schema=BLOCK_ARROW)
            del words, part, head
            give_back()
            flags = trains[a:b] + 2 * valid[a:b].astype(np.int8)
            packed = [pack_array(x) for x in (ids[a:b], flags, lengths, tokens)]
            packed.append(zstandard.ZstdCompressor(level=1).compress(b" ".join(vocabulary)))
            if across:
                keys, totals = gathered(((x, trains[a + i : a + j]) for i, j, x in texts_of(vocabulary, lengths, tokens)), order)
            else:
                keys, totals = distinct_grams(vocabulary, counts, order)
            packed += [pack_keys(keys), pack_array(totals)]
            del vocabulary, keys, totals, tokens
            head = [pa.array([block], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64())]
            yield pa.RecordBatch.from_arrays([*head, *[pa.array([x], pa.binary()) for x in packed]], schema=BLOCK_ARROW)
            block += 1


def texts_of(vocabulary: list[bytes], lengths: np.ndarray, tokens: np.ndarray) -> Iterator[tuple[int, int, list[bytes]]]:
    """The texts of a block, in parts (first, last, texts): their words with a space after each but the end mark."""
    ends = np.cumsum(lengths, dtype=np.int64)
    begins = ends - lengths
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, begins[a] + WORDS_AT_ONCE, "right")))
        ws = list(map(vocabulary.__getitem__, tokens[begins[a] : ends[b - 1]].tolist()))
        yield a, b, [b" ".join(ws[i:j]) for i, j in zip((begins[a:b] - begins[a]).tolist(), (ends[a:b] - begins[a]).tolist())]
        a = b


def grams(units: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For every byte to predict its ``order`` bytes of context and itself, as one number; and where each unit, a word or a text, begins.

    A unit is preceded by spaces and closed by one; after the end mark nothing is predicted.
    """
    pad = b" " * order
    raw = np.frombuffer(pad + pad.join(units) + b" ", np.uint8)
    key = np.zeros(len(raw) - order, np.uint64)
    for i in range(order + 1):
        key <<= np.uint64(8)
        key |= raw[i : i + len(key)]
    lengths = np.array([len(u) for u in units], np.int64)
    last = np.array([not u.endswith(END) for u in units], np.int64)  # the closing space
    start = np.append(0, np.cumsum(lengths + order)[:-1])
    sizes = lengths + last
    begin = np.append(0, np.cumsum(sizes)[:-1])
    at = np.repeat(start - begin, sizes) + np.arange(sizes.sum())
    return key[at], begin


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the sums of their counts."""
    by = np.argsort(keys, kind="stable")
    keys, counts = keys[by], counts[by]
    runs = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[runs], np.add.reduceat(counts, runs) if len(keys) else counts


def distinct_grams(units: list[bytes], counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of units, and how often they occur if each unit occurs as often as counted (0 included)."""
    return gathered(((units[a:b], counts[a:b]) for a, b in blocks(units, BYTES_AT_ONCE)), order)


def gathered(parts: Iterable[tuple[list[bytes], np.ndarray]], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams, sorted, of parts of units with their counts."""
    held, size = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
    for units, counts in parts:
        if counts.max(initial=0) > 1:
            key, begin = grams(units, order)
            held.append(summed(key, np.repeat(counts, np.diff(np.append(begin, len(key))))))
            size += len(held[-1][0])
        else:
            for weight in (0, 1):
                alike = [u for u, n in zip(units, counts.tolist()) if n == weight]
                if alike:
                    held.append(tally(grams(alike, order)[0], weight))
                    size += len(held[-1][0])
        if size > max(HELD, len(held[0][0])):
            held, size = [merged(held)], 0
    return merged(held)


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return summed(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))


def tally(keys: np.ndarray, weight: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``summed`` if all keys count alike."""
    keys, counts = np.unique(keys, return_counts=True)
    return keys, counts * weight


@dataclass
class Level:
    """The contexts of one length, sorted, and their entries."""

    grams: np.ndarray  # context and byte
    counts: np.ndarray
    contexts: np.ndarray
    total: np.ndarray  # counts of a context and its escape
    kinds: np.ndarray  # different bytes, and so the count of the escape
    left: np.ndarray = field(default=None)  # what exclusion of this context's bytes leaves of its suffix, with the escape
    left_kinds: np.ndarray = field(default=None)


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys`` in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


class PartialMatching:
    """The trie. ``tables`` has for each context length, from 0 on, the entries (context and byte as a number) and their counts."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]]):
        self.levels: list[Level] = []
        for order, (keys, counts) in enumerate(tables):
            by = np.argsort(keys, kind="stable")
            keys, counts = keys[by], counts[by].astype(np.float64)
            contexts, start = np.unique(keys >> np.uint64(8), return_index=True)
            kinds = np.diff(np.append(start, len(keys))).astype(np.float64)
            total = np.add.reduceat(counts, start) + kinds if len(keys) else np.zeros(0)
            level = Level(keys, counts, contexts, total, kinds)
            if order:
                below = self.levels[-1]
                suffix, _ = find(below.contexts, contexts & self.mask(order - 1))
                shared, there = find(below.grams, keys & self.mask(order))
                seen = np.add.reduceat(below.counts[shared] * there, start) if len(keys) else np.zeros(0)
                level.left_kinds = below.kinds[suffix] - kinds
                level.left = below.total[suffix] - below.kinds[suffix] - seen + level.left_kinds
            self.levels.append(level)

    @staticmethod
    def mask(size: int) -> np.uint64:
        return np.uint64((1 << 8 * size) - 1)

    def log10(self, words: list[bytes]) -> np.ndarray:
        """Log10 probability of each word with its closing space, or of the end mark."""
        key, begin = grams(words, len(self.levels) - 1)
        return np.add.reduceat(self.codes(key), begin)

    def codes(self, key: np.ndarray) -> np.ndarray:
        """Log10 probability of the last byte of each gram after the others."""
        order = len(self.levels) - 1
        out = np.zeros(len(key))
        open_, longer = np.arange(len(key)), np.full(len(key), -1)  # bytes to predict, and the longer context if it is known
        for k in range(order, -1, -1):
            level = self.levels[k]
            own = key[open_] & self.mask(k + 1)
            context, known = find(level.contexts, own >> np.uint64(8))
            entry, seen = find(level.grams, own)
            escaped = longer >= 0
            if not known.any():
                continue
            above = self.levels[k + 1] if k < order else level
            total, kinds = level.total[context], level.kinds[context]
            if escaped.any():
                total = np.where(escaped, above.left[longer], total)
                kinds = np.where(escaped, above.left_kinds[longer], kinds)
            counts = np.where(seen, level.counts[entry] if len(level.counts) else 0, kinds)
            step = known & (counts > 0)
            out[open_[step]] += np.log10(counts[step] / total[step])
            longer = np.where(known, context, -1)[~seen]
            open_ = open_[~seen]
            if not len(open_):
                break
        root = self.levels[0]
        if len(open_):
            out[open_] -= np.log10(256 - len(root.grams))
        return out


def entries(keys: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The trie entries of a context length: the last ``size + 1`` bytes of the grams."""
    there = counts > 0
    return summed(keys[there] & PartialMatching.mask(size + 1), counts[there])


def train(words: DataFrame, order: int = ORDER) -> PartialMatching:
    """The byte model of a table (word, n_train) that fits in one place, in one piece; repeated words add up. ``score`` needs none."""
    rows = words.select("word", "n_train").toArrow()
    keys, counts = distinct_grams(rows.column("word").to_pylist(), rows.column("n_train").to_numpy().astype(np.int64), order)
    return PartialMatching([entries(keys, counts, k) for k in range(order + 1)])


class Deal:
    """Which task a gram goes to: by the last two bytes of its context or, where those are in ``frequent`` (context length: sorted contexts), by more."""

    def __init__(self, tasks: int, frequent: dict[int, np.ndarray]):
        self.tasks, self.frequent = tasks, frequent

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        contexts = keys >> np.uint64(8)
        own = contexts & PartialMatching.mask(SHORT + 1)
        for size, listed in self.frequent.items():
            _, there = find(listed, contexts & PartialMatching.mask(size))
            own = np.where(there, contexts & PartialMatching.mask(size + 1), own)
        return (own * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % self.tasks


def context_counts(size: int, within: np.ndarray | None):
    """Of the contexts of ``size`` bytes, all or those in ``within``: their entries in training, and the grams of each context longer by a byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = PartialMatching.mask
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = unpack_keys(row["grams"]), unpack_array(row["gram_counts"], "<i8")
                if within is not None:
                    there = find(within, keys >> np.uint64(8) & mask(size))[1]
                    keys, counts = keys[there], counts[there]
                seen = entries(keys, counts, size)
                longer = tally(keys >> np.uint64(8) & mask(size + 1), 1)
                for name, (key, n) in (("entry", seen), ("context", longer)):
                    columns = {"kind": pa.array([name] * len(key), pa.string()), "key": pa.array(key.view(np.int64)), "n": pa.array(n, pa.int64())}
                    yield pa.RecordBatch.from_pydict(columns)

    return run


def arrays(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = rows.select("key", "n").orderBy("key").toArrow()
    return table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()


def share_out(used: DataFrame, order: int) -> tuple[Deal, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """How to deal the grams of blocks, and what every task needs: the entries of contexts of ``SHORT`` bytes, and of frequent longer ones."""
    given, frequent, within, most = {}, {}, None, 0
    for size in range(SHORT, max(order, SHORT + 1)):
        counted = used.mapInArrow(context_counts(size, within), "kind string, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))
        counted = stage(counted, "contexts")
        given[size] = arrays(counted.filter("kind = 'entry'"))
        longer = counted.filter("kind = 'context'")
        if within is None:
            total = longer.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            most = max(GRAMS_AT_ONCE, total // FREQUENT)
        within, _ = arrays(longer.filter(F.col("n") > most))
        if not len(within) or size + 1 >= order:
            break
        frequent[size + 1] = within
    return Deal(max(16, total // GRAMS_AT_ONCE), frequent), given


def deal_grams(deal: Deal):
    """The grams of each block, a row per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = unpack_keys(row["grams"]), unpack_array(row["gram_counts"], "<i8")
                to = deal(keys)
                by = np.argsort(to, kind="stable")
                tasks, begin = np.unique(to[by], return_index=True)
                parts = [(pack_keys(keys[at]), pack_array(counts[at])) for at in np.split(by, begin[1:])] if len(by) else []
                yield pa.RecordBatch.from_pydict({
                    "task": pa.array(tasks), "block": pa.array(np.full(len(tasks), row["block"], np.int64)),
                    "grams": pa.array([g for g, _ in parts], pa.binary()), "gram_counts": pa.array([n for _, n in parts], pa.binary()),
                })

    return run


def gram_codes(deal: Deal, given: dict[int, tuple[np.ndarray, np.ndarray]], order: int):
    """The code lengths of one task's grams, block by block; it has all grams of its contexts, ``given`` has what else is needed."""

    def level(keys: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size <= SHORT:
            return entries(*given[SHORT], size)
        if size not in deal.frequent:
            return entries(keys, counts, size)
        rest = ~find(deal.frequent[size], keys >> np.uint64(8) & PartialMatching.mask(size))[1]
        own = entries(keys[rest], counts[rest], size)
        return tuple(np.concatenate(x) for x in zip(own, given[size]))

    def run(held: pa.Table) -> pa.Table:
        rows = held.to_pylist()
        parts = [unpack_keys(row["grams"]) for row in rows]
        counts = np.concatenate([unpack_array(row["gram_counts"], "<i8") for row in rows])
        keys, place = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.bincount(place, counts, len(keys)).astype(np.int64)
        codes = PartialMatching([level(keys, counts, k) for k in range(order + 1)]).codes(keys)[place]
        ends = np.cumsum([len(p) for p in parts])
        give_back()
        return pa.table({
            "task": held.column("task"), "block": held.column("block"),
            "codes": pa.array([pack_array(x) for x in np.split(codes, ends[:-1])], pa.binary()),
        })

    return run


def placer(table: np.ndarray):
    """Places of keys in a table that holds them all: by a slot each where no other key took it, else by search."""
    bits = max(1, (2 * len(table)).bit_length())

    def slot(keys: np.ndarray) -> np.ndarray:
        return keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)

    slots = np.zeros(1 << bits, np.int32)
    slots[slot(table)] = np.arange(len(table), dtype=np.int32)

    def places(keys: np.ndarray) -> np.ndarray:
        at = slots[slot(keys)]
        missed = np.flatnonzero(table[at] != keys)
        at[missed] = np.searchsorted(table, keys[missed])
        return at

    return places


def unit_codes(parts: Iterable[list[bytes]], keys: np.ndarray, codes: np.ndarray, order: int) -> np.ndarray:
    """The code length of each unit, given in parts; ``keys`` are sorted and hold all their grams."""
    places, out = placer(keys), []
    for units in parts:
        key, begin = grams(units, order)
        out.append(np.add.reduceat(codes[places(key)], begin))
    return np.concatenate(out)


def score_block(n: int, v: int, order: int, deal: Deal, across: bool):
    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        words = side.filter(side.column("number").is_valid())
        known = side.filter(side.column("task").is_valid()).sort_by("task")
        count = np.zeros(words.num_rows)
        count[words.column("number").to_numpy()] = words.column("count").to_numpy()
        base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))
        blobs = known.column("codes").to_pylist()
        del side, words, known
        give_back()
        out = []
        for row in docs.to_pylist():
            keys = unpack_keys(row["grams"])
            codes = np.zeros(len(keys))
            codes[np.argsort(deal(keys), kind="stable")] = np.concatenate([unpack_array(x, "<f8") for x in blobs])
            vocabulary = zstandard.ZstdDecompressor().decompress(row["vocabulary"]).split(b" ")
            ids, flags = unpack_array(row["doc_ids"], "<i8"), unpack_array(row["trains"], "i1")
            lengths, tokens = unpack_array(row["lengths"], "<i4").astype(np.int64), unpack_array(row["numbers"], "<i4")
            begin = np.append(0, np.cumsum(lengths)[:-1])
            sums = [np.add.reduceat(x[tokens], begin) for x in ((count > 0).astype(np.int64), base)]
            texts = (x for _, _, x in texts_of(vocabulary, lengths, tokens))
            parts = texts if across else (vocabulary[a:b] for a, b in blocks(vocabulary, BYTES_AT_ONCE))
            code = unit_codes(parts, keys, codes, order)
            totals = code if across else np.add.reduceat(code[tokens], begin)
            out.append(pa.table({
                "doc_id": pa.array(ids, mask=flags < 2), "held_out": pa.array(flags % 2 == 0), "n_tokens": pa.array(lengths),
                "n_known": pa.array(sums[0]), "train_tokens": pa.array(np.full(len(ids), n, np.int64)),
                "base_score": pa.array(sums[1]), "score": pa.array(totals),
            }))
            del keys, codes, vocabulary, lengths, tokens, code
            give_back()
        return pa.concat_tables(out)

    return run


def score(docs: DataFrame, held_out: str = "crc32(cast(doc_id as string)) % 5 = 1", order: int = ORDER, across: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    ``docs`` has doc_id and text; other columns don't matter. ``held_out`` is SQL over doc_id; documents for which it doesn't
    hold, those with a null doc_id among them, are learned from. ``across`` lets contexts reach over words, through the whole text. A null, empty or blank text is the end mark alone. Repeated
    rows count, and are scored, each. Without any training document every byte is equally likely. An empty table gives an empty
    result. Each task counts its blocks' words; a word's count over all blocks is one window over rows of that word, one
    per block.
    """
    own = with_rows(docs).select(F.col("row")["doc_id"].cast("bigint").alias("doc_id"), F.col("row")["text"].cast("binary").alias("text"))
    own = own.withColumn("trains", ~F.coalesce(F.expr(held_out), F.lit(False)))
    made = stage(own.mapInArrow(tidy(split_blocks(order, across)), BLOCK_SCHEMA), "blocks")
    words = made.filter("word is not null").select("block", "word", "number", "n_train")
    by_word = Window.partitionBy("word")
    counted = words.withColumn("count", F.sum("n_train").over(by_word))
    counted = counted.withColumn("turn", F.row_number().over(by_word.orderBy("block")))
    counted = stage(counted.select("block", "number", "count", (F.col("turn") == 1).alias("first"), "n_train"), "word-counts")
    n, v = counted.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count_if(F.col("first") & (F.col("count") > 0))).first()
    blobs = made.filter("word is null")
    used = blobs.select("block", "grams", "gram_counts")
    deal, given = share_out(used, order)
    dealt = used.mapInArrow(tidy(deal_grams(deal)), "task bigint, block bigint, grams binary, gram_counts binary")
    codes = dealt.groupBy("task").applyInArrow(gram_codes(deal, given, order), "task bigint, block bigint, codes binary")
    side = counted.select("block", "number", "count").unionByName(codes, allowMissingColumns=True)
    blobs = blobs.select("block", "doc_ids", "trains", "lengths", "numbers", "vocabulary", "grams")
    pairs = blobs.groupBy("block").cogroup(side.groupBy("block"))
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return pairs.applyInArrow(score_block(n, v, order, deal, across), schema)
