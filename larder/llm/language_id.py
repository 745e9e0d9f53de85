"""Language identification of spans in mixed-language text.

The script of a word narrows the languages it can be in: those that training documents write in that script. Each word has a score
in each of them, the log-likelihood of its character trigrams (smoothed, as a mean per trigram times a length that saturates). A
Viterbi pass over the words of a text finds the languages that maximise the sum of word scores less a penalty for each switch,
which cuts the text into spans of one language.

Training counts trigrams per language over all training documents. Trigrams are hashed to ``BUCKETS`` numbers, so the model
is a table of that many rows and a column per language, whatever the corpus. A task scores each different word once; the passes
over many texts advance together, one word at a time, in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stage, with_rows
from larder.llm.lm_scoring import Numbers
from larder.llm.shingles import blocks, mix

BUCKETS = 1 << 16
SMOOTHING = 0.5
#: A language is a candidate in a script if it has this share of its letters there.
SCRIPT_SHARE = 0.001
SWITCH = 12.0
#: Trigrams of a word that count in full; a longer word is no stronger evidence.
FULL_LENGTH = 6
BLOCK = 8_000_000
REMEMBERED = 300_000

#: First and last code points of Unicode blocks, by script. Script 0 is everything else.
SCRIPT_RANGES = (
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F),
    ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF),
    ("gurmukhi", 0xA00, 0xA7F), ("gujarati", 0xA80, 0xAFF), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F),
    ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F), ("sinhala", 0xD80, 0xDFF), ("thai", 0xE00, 0xE7F),
    ("lao", 0xE80, 0xEFF), ("tibetan", 0xF00, 0xFFF), ("georgian", 0x10A0, 0x10FF), ("ethiopic", 0x1200, 0x137F),
    ("khmer", 0x1780, 0x17FF), ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
SCRIPTS = ("other", *dict.fromkeys(name for name, _, _ in SCRIPT_RANGES))


def letter_scripts() -> np.ndarray:
    """For each code point of the basic plane its script plus 1 if it is a letter, else 0."""
    table = np.zeros(0x10000, np.uint8)
    for code in range(0x10000):
        if chr(code).isalpha():
            table[code] = 1
    for name, first, last in SCRIPT_RANGES:
        part = table[first : last + 1]
        part[part > 0] = 1 + SCRIPTS.index(name)
    return table


@dataclass
class Words:
    """Trigram numbers and scripts of a list of words. Word ``i`` has the trigrams from ``begin[i]`` on, ``sizes[i]`` of them."""

    trigrams: np.ndarray
    begin: np.ndarray
    sizes: np.ndarray
    letters: np.ndarray
    scripts: np.ndarray  # of the word: that of most of its letters, by first place among equals

    @staticmethod
    def of(words: list[bytes], table: np.ndarray) -> Words:
        # U+0000 marks the edges of words; one inside a word is a sign like any other
        text = "\x00\x00" + "\x00\x00".join([w.decode().replace("\x00", "\x01") for w in words]) + "\x00\x00"
        codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4").astype(np.int64)
        kind = table[np.minimum(codes, 0xFFFF)]
        for i in np.flatnonzero(codes > 0xFFFF).tolist():
            kind[i] = chr(codes[i]).isalpha()
        keep = np.where((kind > 0) | (codes == 0), codes, 0x20)  # all other signs look alike
        edge = np.flatnonzero(codes == 0)[0::2]  # the first of the two marks before each word, and the last pair
        sizes = np.diff(edge) - 1  # a word of n signs has n + 1 trigrams: edge, sign, ..., edge
        begin = np.append(0, np.cumsum(sizes)[:-1])
        at = np.repeat(edge[:-1] + 1 - begin, sizes) + np.arange(sizes.sum())
        key = (keep[at] << 42) | (keep[np.minimum(at + 1, len(keep) - 1)] << 21) | keep[np.minimum(at + 2, len(keep) - 1)]
        trigrams = (mix(key.astype(np.uint64)) % np.uint64(BUCKETS)).astype(np.int32)
        owner = np.repeat(np.arange(len(words)), sizes)
        own_kind = kind[at]
        found = own_kind > 0
        per = np.bincount(owner[found] * (len(SCRIPTS) + 1) + own_kind[found], minlength=len(words) * (len(SCRIPTS) + 1))
        per = per.reshape(len(words), -1)
        return Words(trigrams, begin, sizes, per.sum(axis=1), np.argmax(per[:, 1:], axis=1))


def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, number, n): trigram counts (kind 0) and letters per script (kind 1) of a batch."""
    table = letter_scripts()
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            numbers = Numbers()
            counts = np.zeros(0, np.int64)
            for i in np.flatnonzero(langs == lang).tolist():
                ws = (texts[i] or b"").split()
                own = np.bincount(np.fromiter(map(numbers.__getitem__, ws), np.int64, len(ws)), minlength=len(counts))
                own[: len(counts)] += counts
                counts = own
            if not len(counts):
                continue
            w = Words.of(list(numbers), table)
            trigrams = np.bincount(w.trigrams, np.repeat(counts * (w.letters > 0), w.sizes), BUCKETS).astype(np.int64)
            scripts = np.bincount(w.scripts, counts * w.letters, len(SCRIPTS)).astype(np.int64)
            for kind, values in enumerate((trigrams, scripts)):
                at = np.flatnonzero(values)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(at), pa.string()), "kind": pa.array([kind] * len(at), pa.int32()),
                    "number": pa.array(at, pa.int32()), "n": pa.array(values[at]),
                })


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # bucket by language: log-likelihood
    allowed: np.ndarray  # script by language
    learned: bool = True

    def scores(self, words: list[bytes], table: np.ndarray) -> np.ndarray:
        """One row per word, 0 in all languages for a word without letters; barred languages are far below the others."""
        w = Words.of(words, table)
        sums = np.add.reduceat(self.weights[w.trigrams], w.begin, axis=0)
        mean = sums / w.sizes[:, None]
        out = mean * np.minimum(w.sizes, FULL_LENGTH)[:, None]
        out -= out.max(axis=1, keepdims=True)
        out = np.where(self.allowed[w.scripts], out, -100.0)
        out -= out.max(axis=1, keepdims=True)
        out[w.letters == 0] = 0
        return out.astype(np.float32)


def train(docs: DataFrame) -> Model:
    """The model of a table (text as binary, lang without nulls): at most ``BUCKETS`` rows per language come to the driver."""
    counts = docs.select("text", "lang").mapInArrow(count_trigrams, "lang string, kind int, number int, n bigint")
    counts = stage(counts.groupBy("lang", "kind", "number").agg(F.sum("n").alias("n")), "trigrams").toPandas()
    langs = sorted(counts["lang"].unique(), key=lambda x: x.encode())
    if not langs:
        return Model(["und"], np.zeros((BUCKETS, 1), np.float32), np.ones((len(SCRIPTS), 1), bool), learned=False)
    trigrams, scripts = np.zeros((BUCKETS, len(langs))), np.zeros((len(SCRIPTS), len(langs)))
    for row, size in ((0, trigrams), (1, scripts)):
        part = counts[counts["kind"] == row]
        size[part["number"], part["lang"].map({x: i for i, x in enumerate(langs)})] = part["n"]
    weights = np.log((trigrams + SMOOTHING) / (trigrams.sum(axis=0) + SMOOTHING * BUCKETS))
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True  # a script that no language is written in narrows nothing
    return Model(langs, weights.astype(np.float32), allowed)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The language of each word. ``scores`` has the texts' words one after another, ``lengths`` words per text.

    Texts are advanced together: step ``t`` handles word ``t`` of all texts that have one, longest texts first.
    """
    begin = np.append(0, np.cumsum(lengths)[:-1])
    order = np.argsort(-lengths, kind="stable")
    begin, sizes = begin[order], lengths[order]
    alive = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    best = np.zeros((len(sizes), scores.shape[1]), np.float32)
    came = np.empty(scores.shape, np.uint16)  # the language before each word, per language of the word
    own = np.arange(scores.shape[1], dtype=np.uint16)
    for t, n in enumerate(alive.tolist()):
        at = begin[:n] + t
        state = best[:n]
        top = state.argmax(axis=1)
        switched = state[np.arange(n), top][:, None] - np.float32(penalty)
        stays = state >= switched
        came[at] = np.where(stays, own, top[:, None].astype(np.uint16))
        state = np.maximum(state, switched) + scores[at]
        best[:n] = state - state.max(axis=1, keepdims=True)
    path = np.zeros(len(scores), np.int64)
    last = best.argmax(axis=1)
    for t in range(len(alive) - 1, -1, -1):
        n = int(alive[t])
        at = begin[:n] + t
        path[at] = last[:n]
        last[:n] = came[at, last[:n]]
    return path


def label(model: Model, penalty: float):
    """Per document its main language, the share of its letters in words of that language, and its spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_scripts()
        numbers, scores, letters = Numbers(), np.zeros((0, len(model.langs)), np.float32), np.zeros(0, np.int64)
        for batch in batches:
            texts, ids, held = batch.column("text").to_pylist(), batch.column("doc_id"), batch.column("held_out")
            for a, b in blocks(texts, BLOCK):
                if len(numbers) > REMEMBERED:
                    numbers, scores, letters = Numbers(), scores[:0], letters[:0]
                rows = []
                for i in range(a, b):
                    ws = (texts[i] or b"").split()
                    rows.append(np.fromiter(map(numbers.__getitem__, ws), np.int64, len(ws)))
                if len(numbers) > len(scores):
                    new = list(numbers)[len(scores) :]
                    scores = np.concatenate([scores, model.scores(new, table)])
                    letters = np.concatenate([letters, Words.of(new, table).letters])
                lengths = np.array([len(r) for r in rows], np.int64)
                words = np.concatenate(rows) if rows else np.zeros(0, np.int64)
                path = viterbi(scores[words], lengths, penalty)
                weight = letters[words] if len(words) else np.zeros(0, np.int64)
                text = np.repeat(np.arange(b - a), lengths)
                width = len(model.langs)
                share = np.bincount(text * width + path, weight, (b - a) * width).reshape(-1, width)
                total = share.sum(axis=1)
                main = share.argmax(axis=1)
                known = (total > 0) & model.learned
                first = np.append(True, (path[1:] != path[:-1]) | (text[1:] != text[:-1]))[: len(path)]
                cuts = np.flatnonzero(first)
                place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                stop = np.append(cuts[1:], len(words))[: len(cuts)] - 1
                spans = pa.StructArray.from_arrays(
                    [pa.array(place[cuts], pa.int32()), pa.array(place[stop] + 1, pa.int32()), pa.array(model.langs, pa.string()).take(pa.array(path[cuts]))],
                    names=["start", "end", "lang"],
                )
                offsets = np.append(0, np.cumsum(np.bincount(text[cuts], minlength=b - a)))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids[a:b], "held_out": held[a:b],
                    "lang_pred": pa.array([model.langs[m] if k else "und" for m, k in zip(main, known, strict=True)], pa.string()),
                    "score": pa.array(np.where(known, share[np.arange(b - a), main] / np.maximum(total, 1), 0.0)),
                    "spans": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
                })

    return run


def identify(docs: DataFrame, held_out: str = "crc32(cast(doc_id as string)) % 5 = 0", penalty: float = SWITCH) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, spans (start, end, lang; in words, end exclusive).

    ``docs`` has doc_id, text and lang; other columns don't matter. ``held_out`` is SQL over doc_id; text and lang of the other
    documents with a lang, those with a null doc_id among them, are learned from. ``lang_pred`` is the language of most letters, the first by
    name among equals, and ``score`` their share; ``und`` with score 0 if the text is null or has no letter, or nothing could be
    learned. Repeated rows are labelled alike. An empty table gives an empty result.
    """
    rows = with_rows(docs).select(
        F.col("row")["doc_id"].cast("bigint").alias("doc_id"), F.col("row")["text"].cast("binary").alias("text"), F.col("row")["lang"].alias("lang")
    )
    rows = rows.withColumn("held_out", F.coalesce(F.expr(held_out), F.lit(False)))
    model = train(rows.filter("not held_out and lang is not null and text is not null"))
    schema = "doc_id bigint, held_out boolean, lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>"
    return rows.select("doc_id", "held_out", "text").mapInArrow(label(model, penalty), schema)
