"""Exact removal of repeated passages: windows of 20 words that start earlier elsewhere, found by super-k-mer partitioning.

The minimiser of a window is the leftmost of its ``MER``-word sequences with the smallest hash. Consecutive windows with the same
minimiser overlap in all but a few words, so they travel together, as one packed string of words (a super-k-mer), to the bucket
of the minimiser. Equal windows have equal minimisers and meet in one bucket, where sorting brings equal windows together.

- Strings that repeat within a block of documents are settled there: all but the earliest are repeats, and only that one
  travels. So a passage that a third of all documents hold reaches its bucket once per block.
- In the bucket, a string whose minimiser is alone there can't hold a repeated window, as windows of one string differ in
  where the minimiser lies. The others are cut into windows again, sorted by hash, and equal hashes are compared word by word.
- The number of buckets follows the size of the input, so buckets keep their size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stage, with_rows
from larder.llm.shingles import Powers, Windows, blocks

WINDOW = 20
MER = 4
#: Bytes of packed strings per bucket; strings hold each word some 3.1 times.
BUCKET_BYTES, OVERLAP = 24_000_000, 3.1
LEAST_BUCKETS = 16
#: Of zstandard: strings are many and alike, texts travel one by one.
STRING_LEVEL, TEXT_LEVEL = 6, 3
#: A null doc_id comes after all others.
NULL_ID = np.iinfo(np.int64).max
PLACE_BITS = np.uint64(28)


def minimisers(w: Windows, window: int, mer: int) -> np.ndarray:
    """For each word of the batch the place of the minimiser of the window that starts there; windows may cross texts here."""
    n = len(w.starts)
    at = np.arange(n - mer + 1)
    key = (w.hashes(at, at + mer - 1) >> PLACE_BITS << PLACE_BITS) | at.astype(np.uint64)
    span, done = window - mer + 1, 1
    while done < span:
        step = min(done, span - done)
        key = np.minimum(key[:-step], key[step:])
        done += step
    return (key & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)


def pack_strings(doc: np.ndarray, start: np.ndarray, tag: np.ndarray, strings: list[bytes]) -> bytes:
    head = np.array([len(doc)], "<i8").tobytes() + np.diff(doc, prepend=0).astype("<i8").tobytes()
    body = start.astype("<i4").tobytes() + tag.astype("<u4").tobytes() + b"\n".join(strings)
    return b"S" + zstandard.ZstdCompressor(level=STRING_LEVEL).compress(head + body)


def unpack_strings(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    data = zstandard.ZstdDecompressor().decompress(payload[1:])
    n = int(np.frombuffer(data, "<i8", 1)[0])
    doc = np.cumsum(np.frombuffer(data, "<i8", n, 8))
    start = np.frombuffer(data, "<i4", n, 8 + 8 * n)
    tag = np.frombuffer(data, "<u4", n, 8 + 12 * n)
    return doc, start, tag, data[8 + 16 * n :].split(b"\n")


def pack_marks(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> bytes:
    return b"M" + zstandard.ZstdCompressor(level=3).compress(np.stack([doc, start, count]).astype("<i8").tobytes())


def super_kmers(window: int, mer: int, buckets: int):
    """Per block of documents and bucket one row of packed strings, and one row of what the block settled itself."""

    def block(ids: np.ndarray, texts: list[bytes], powers: Powers, salt: int) -> Iterator[tuple[int, bytes]]:
        w = Windows(texts, powers)
        count = np.maximum(w.words - window + 1, 0)
        if not count.sum():
            return
        text = np.repeat(np.arange(len(texts)), count)
        place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)  # of the window in its text
        first = w.first[text] + place
        lead = minimisers(w, window, mer)[first]
        cuts = np.flatnonzero((lead[1:] != lead[:-1]) | (text[1:] != text[:-1])) + 1
        runs = np.append(0, cuts)
        length = np.diff(np.append(runs, len(text)))
        a, doc, start = first[runs], ids[text[runs]], place[runs]
        z = a + length + window - 2
        whole = w.hashes(a, z)
        lead = lead[runs]
        mark = w.hashes(lead, lead + mer - 1)
        order = np.lexsort((start, doc, whole))
        a, z, doc, start, length, whole, mark = (x[order] for x in (a, z, doc, start, length, whole, mark))
        begin, end = w.starts[a], w.ends[z]
        again = np.append(False, whole[1:] == whole[:-1])
        for i in np.flatnonzero(again).tolist():  # equal hashes: compare the strings themselves
            if w.joined[begin[i] : end[i]] != w.joined[begin[i - 1] : end[i - 1]]:
                again[i] = False
        again &= ~np.append(False, (doc[1:] == doc[:-1]) & (start[1:] == start[:-1]))  # rows of one doc_id: the same place
        if again.any():
            yield buckets + salt % buckets, pack_marks(doc[again], start[again], length[again])
        keep = np.flatnonzero(~again)
        bucket = (mark[keep] % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((start[keep], doc[keep], bucket))
        keep, bucket = keep[order], bucket[order]
        begin, end = begin[keep].tolist(), end[keep].tolist()
        tags = (mark[keep] >> np.uint64(32)).astype(np.uint32)
        edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)).tolist()
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            strings = [w.joined[i:j] for i, j in zip(begin[x:y], end[x:y], strict=True)]
            yield int(bucket[x]), pack_strings(doc[keep[x:y]], start[keep[x:y]], tags[x:y], strings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id").fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False)
            for x, y in blocks(texts):
                salt = int(np.abs(ids[x:y]).sum()) & 0x7FFFFFFF
                for bucket, payload in block(ids[x:y], texts[x:y], powers, salt):
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "payload": pa.array([payload], pa.binary())})

    return run


def spans(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.Table:
    return pa.table({"doc_id": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int64()), "count": pa.array(count, pa.int64())})


def repeats(window: int):
    """The repeated windows of one bucket, as runs (doc_id, start, count of windows)."""

    def run(table: pa.Table) -> pa.Table:
        marks, packed = [], []
        for payload in table.column("payload").to_pylist():
            if payload[:1] == b"M":
                marks.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(payload[1:]), "<i8").reshape(3, -1))
            else:
                packed.append(unpack_strings(payload))
        found = [spans(*m) for m in marks]
        if packed:
            doc, start, tag = (np.concatenate([p[i] for p in packed]) for i in range(3))
            _, inverse, count = np.unique(tag, return_inverse=True, return_counts=True)
            keep = np.flatnonzero(count[inverse] > 1)
            strings = [s for p in packed for s in p[3]]
            found.append(sort_windows(doc[keep], start[keep].astype(np.int64), [strings[i] for i in keep.tolist()]))
        return pa.concat_tables(found) if found else spans(*np.zeros((3, 0), np.int64))

    def sort_windows(doc: np.ndarray, start: np.ndarray, strings: list[bytes]) -> pa.Table:
        w = Windows(strings, Powers())
        count = w.words - window + 1
        string = np.repeat(np.arange(len(strings)), count)
        place = np.arange(len(string)) - np.repeat(np.cumsum(count) - count, count)
        first = w.first[string] + place
        doc, start = doc[string], start[string] + place
        hashes = w.hashes(first, first + window - 1)
        order = np.lexsort((start, doc, hashes))
        doc, start, hashes = doc[order], start[order], hashes[order]
        begin, end = w.starts[first[order]], w.ends[first[order] + window - 1]
        again = np.append(False, hashes[1:] == hashes[:-1]) if len(hashes) else np.zeros(0, bool)
        for i in np.flatnonzero(again).tolist():
            if w.joined[begin[i] : end[i]] != w.joined[begin[i - 1] : end[i - 1]]:
                again[i] = False
        if len(again):  # the same place, of a doc_id that several rows have: no repeat unless an earlier one has the window
            same = np.append(False, (doc[1:] == doc[:-1]) & (start[1:] == start[:-1]) & again[1:])
            for i in np.flatnonzero(same).tolist():
                again[i] = again[i - 1]
        doc, start = doc[again], start[again]
        order = np.lexsort((start, doc))
        doc, start = doc[order], start[order]
        if not len(doc):
            return spans(doc, start, start)
        runs = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)))
        return spans(doc[runs], start[runs], np.diff(np.append(runs, len(doc))))

    return run


def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=TEXT_LEVEL).compress
    for batch in batches:
        texts = [pack(t.as_py() or b"") for t in batch.column("text")]
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.binary())})


def kept_words(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            n, removed, digests, kept = [], [], [], []
            for text, marks in zip(batch.column("text"), batch.column("marks"), strict=True):
                ws = unpack(text.as_py()).split()
                n.append(len(ws))
                if marks.is_valid:
                    starts = marks.values.field("start").to_numpy()
                    counts = marks.values.field("count").to_numpy()
                    cover = np.zeros(len(ws) + 1, np.int64)
                    np.add.at(cover, np.minimum(starts, len(ws)), 1)
                    np.add.at(cover, np.minimum(starts + counts + window - 1, len(ws)), -1)
                    ws = [ws[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
                removed.append(n[-1] - len(ws))
                rest = b" ".join(ws)
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode() if with_text else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()), "kept_text": pa.array(kept, pa.string()),
            })

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, mer: int = MER, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept_text (null unless ``with_text``).

    ``docs`` has doc_id and text; other columns don't matter. A word goes if a window that covers it also starts earlier: in a
    document of smaller doc_id, or earlier in its own. A null text has no words; texts shorter than a window keep all. Rows of
    one doc_id are taken for one document, the same place of which is not earlier than itself: exact copies of a row keep what
    the row keeps. A null doc_id comes after all others. An empty table gives an empty result.
    """
    rows = with_rows(docs).select(
        F.col("row")["doc_id"].cast("bigint").alias("doc_id"), F.col("row")["text"].cast("binary").alias("text")
    )
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, int(total * OVERLAP / BUCKET_BYTES))
    packed = rows.mapInArrow(super_kmers(window, mer, buckets), "bucket int, payload binary")
    marks = packed.groupBy("bucket").applyInArrow(repeats(window), "doc_id bigint, start bigint, count bigint")
    by_doc = marks.groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("start", "count")).alias("marks"))
    by_doc = stage(by_doc, "repeated-windows")
    own = F.coalesce("doc_id", F.lit(int(NULL_ID)))
    texts = rows.mapInArrow(compress, "doc_id bigint, text binary")
    joined = texts.join(by_doc, own == F.col("of"), "left").select("doc_id", "text", "marks")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
    return joined.mapInArrow(kept_words(window, with_text), schema)
