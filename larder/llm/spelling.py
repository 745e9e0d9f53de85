"""Spelling variants: words that differ by one code point, found by an index of variable-length grams.

1. Words are counted over all texts; ``sloppy`` writes some runs with one code point missing, by a rule on their document.
2. The gram dictionary is counted over all distinct words. A gram of ``SHORTEST`` symbols or more that begins at more than ``limit`` places
   is too frequent to tell words apart and is extended by a symbol, up to ``longest`` symbols; the dictionary is pruned to these frequent
   prefixes. At each place of a word begins the shortest gram that is not one of them, or that ends the word. The gram depends on nothing
   but its own symbols, so an edit affects exactly the grams that cover it.
3. ``most[word]``, the largest number of its grams that cover one place, bounds what one edit affects. Two near words share all other
   grams, at the same distance from the start or from the end, so the lists of ``most + 1`` grams of a word are enough to merge: the
   rarest, in one global order of grams. With ``longest < min_length`` a word always has that many grams. (In a global order the first shared gram
   of two words is among the first ``most + 1`` of both.)
4. Lists of up to ``LIST`` words are merged by a join, and each pair is verified by its edit distance. Words of a longer list are joined by what
   is left of them without one code point: at most 90 * (length + 1) + 1 words have one such rest, so that no group grows with the corpus.

What travels: the counted words, their few tokens, and pairs. The dictionary goes to all tasks; it has at most ``4 * DICTIONARY`` numbers, as the limit
grows with the number of places.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stage, with_rows
from larder.llm.shingles import mix

#: What a run of letters is, and what its lower case is.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
NO_RUN = re.compile("[^A-Za-zÀ-ÿ]")
LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}

EVERY = 31
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
SHORTEST, LONGEST = 3, 6
#: A gram is frequent if it begins at more than this share of all places of words, or at ``RARE`` places in a small table.
DICTIONARY, RARE = 200_000, 16
#: Words of a list that are compared pair by pair.
LIST = 128
#: Code points that are cut into runs at once, distinct runs that a task counts before it passes them on, and letters whose grams are looked up at once.
PART, HELD, PLACES = 1_000_000, 250_000, 1_000_000


def parts(text: str, size: int = PART) -> Iterator[str]:
    """A text in parts of about ``size`` code points, cut where no run is cut."""
    begin = 0
    while len(text) - begin > size:
        end = NO_RUN.search(text, begin + size)
        if end is None:
            break
        yield text[begin : end.start()]
        begin = end.start()
    yield text[begin:] if begin else text


def sloppy(run: str, seed: int, every: int = EVERY) -> str:
    """A lower-cased run as it is counted; ``seed`` is the checksum of what precedes it in the hash."""
    h = zlib.crc32(run.encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_runs(every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                key = doc_id.as_py()
                seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                for part in parts(text.as_py() or ""):
                    for found, n in Counter(RUN.findall(part)).items():
                        word = sloppy(found.lower() if found.isascii() else found.translate(LOWER), seed, every)
                        counts[word] = counts.get(word, 0) + n
                    if len(counts) > HELD:
                        yield flush()
        if counts:
            yield flush()

    return run


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = EVERY) -> DataFrame:
    """(word, n) of all words of ``min_length`` code points that occur ``min_count`` times in the whole table."""
    rows = with_rows(docs).select(F.col("row")["doc_id"].cast("bigint").alias("doc_id"), F.col("row")["text"].cast("string").alias("text"))
    counts = rows.mapInArrow(count_runs(every), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter((F.char_length("word") >= min_length) & (F.col("n") >= min_count))


def symbols() -> np.ndarray:
    """The number of each letter, in seven bits; the line break that ends a word is one too."""
    table = np.zeros(256, np.int64)
    letters = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100), ord("\n")]
    table[letters] = np.arange(1, len(letters) + 1)
    return table


class Grams:
    """The places of some words, one word after another, each followed by its end. ``codes[q]`` is the gram of q symbols there, 0 if it goes past the end."""

    def __init__(self, words: list[str], table: np.ndarray, longest: int):
        text = np.frombuffer("".join(w + "\n" for w in words).encode("latin-1"), np.uint8)
        self.end = text == 10
        self.ends = np.flatnonzero(self.end)
        self.begins = np.append(0, self.ends[:-1] + 1)
        self.sizes = self.ends - self.begins
        padded = np.append(table[text], np.zeros(longest, np.int64))
        ended = np.append(self.end, np.zeros(longest, bool))
        code, valid = padded[: len(text)].copy(), ~self.end
        self.codes, self.last = {1: code}, {1: np.zeros(len(text), bool)}
        for q in range(2, longest + 1):
            valid = valid & ~self.last[q - 1]
            symbol = padded[q - 1 : q - 1 + len(text)]
            code = np.where(valid, code | (symbol << (7 * (q - 1))), 0)
            self.codes[q], self.last[q] = code, valid & ended[q - 1 : q - 1 + len(text)]


def word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    held, size = [], 0
    for batch in batches:
        for word in batch.column("word").to_pylist():
            held.append(word)
            size += len(word) + 1
            if size >= PLACES:
                yield held
                held, size = [], 0
    if held:
        yield held


def count_grams(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbols()
        for words in word_blocks(batches):
            grams = Grams(words, table, longest)
            found = np.concatenate([grams.codes[q] for q in range(SHORTEST, longest + 1)])
            codes, n = np.unique(found[found > 0], return_counts=True)
            yield pa.RecordBatch.from_pydict({"gram": pa.array(codes), "n": pa.array(n.astype(np.int64))})

    return run


def frequent_grams(words: DataFrame, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted grams that begin at more places than the limit, and their counts: at most ``DICTIONARY`` of each length."""
    places = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    limit = max(RARE, -(-places // DICTIONARY))
    counted = words.select("word").mapInArrow(count_grams(longest), "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    kept = counted.filter(F.col("n") > limit).toPandas().sort_values("gram")
    return kept["gram"].to_numpy(np.int64), kept["n"].to_numpy(np.int64)


def index(dictionary: tuple[np.ndarray, np.ndarray], longest: int):
    """(token, side, word, n) for the rarest grams of each word, ``most + 1`` of them: a token is a gram and its distance from the start
    (side 0) or from the end (side 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = dictionary
        table = symbols()
        for words, ns in counted_blocks(batches):
            grams = Grams(words, table, longest)
            places = len(grams.end)
            code, size, often = np.zeros(places, np.int64), np.zeros(places, np.int64), np.zeros(places, np.int64)
            opened = ~grams.end
            for q in range(1, longest + 1):
                if q < SHORTEST:
                    done = opened & grams.last[q]
                    n = np.zeros(places, np.int64)
                else:
                    at = np.searchsorted(known, grams.codes[q])
                    hit = at < len(known)
                    hit[hit] = known[at[hit]] == grams.codes[q][hit]
                    n = np.zeros(places, np.int64)
                    n[hit] = counts[at[hit]]
                    done = opened & (~hit | grams.last[q] | (q == longest))
                code[done], size[done], often[done] = grams.codes[q][done], q, n[done]
                opened = opened & ~done
            at = np.flatnonzero(~grams.end)
            change = np.bincount(at, minlength=places + 1) - np.bincount(at + size[at], minlength=places + 1)
            cover = np.where(grams.end, 0, np.cumsum(change)[:places])
            most = np.maximum.reduceat(cover, grams.begins)
            owner = np.repeat(np.arange(len(words)), grams.sizes)
            order = np.lexsort((at, code[at], often[at], owner))
            rank = np.arange(len(at)) - np.repeat(np.cumsum(grams.sizes) - grams.sizes, grams.sizes)
            first = rank <= most[owner]
            at, owner = at[order][first], owner[first]
            from_start, from_end = at - grams.begins[owner], grams.ends[owner] - at
            words_taken = pa.array(words, pa.string()).take(pa.array(owner))
            ns_taken = pa.array(ns[owner])
            for side, distance in enumerate((from_start, from_end)):
                token = mix(mix(code[at].astype(np.uint64)) + (2 * distance + side).astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "token": pa.array(token), "side": pa.array(np.full(len(at), side, np.int32)), "word": words_taken, "n": ns_taken,
                })

    return run


def counted_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray]]:
    for batch in batches:
        words, ns = batch.column("word").to_pylist(), batch.column("n").to_numpy(zero_copy_only=False)
        if words:
            yield words, ns


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH, longest: int = LONGEST, list_size: int = LIST) -> DataFrame:
    """(a, a_n, b, b_n): every two of the distinct ``words`` (word, n) that differ by one code point, once, ``a`` before ``b``."""
    if not SHORTEST <= longest < min_length:
        raise ValueError(f"grams of {SHORTEST} to {longest} symbols can't tell words of {min_length} letters apart after an edit")
    dictionary = frequent_grams(words, longest)
    tokens = stage(words.mapInArrow(index(dictionary, longest), "token bigint, side int, word string, n bigint"), "spelling-tokens")
    lists = tokens.groupBy("token").agg(F.count("*").alias("size")).filter("size > 1")
    lists = stage(tokens.join(lists, "token"), "spelling-lists")

    short = lists.filter(F.col("size") <= list_size).drop("size")
    a, b = (short.select("token", "side", F.struct("word", "n").alias(x)) for x in "ab")
    # near words of one length meet at their distances from the start, so the lists by distance from the end are for unequal lengths
    gap = F.abs(F.char_length("a.word") - F.char_length("b.word"))
    meets = (a["token"] == b["token"]) & (F.col("a.word") < F.col("b.word")) & (gap <= 1) & ((a["side"] == 0) | (gap == 1))
    merged = a.join(b, meets & (F.levenshtein("a.word", "b.word", 1) == 1)).select("a", "b")

    long = lists.filter(F.col("size") > list_size).select("word", "n").distinct()
    without = F.expr("transform(sequence(1, char_length(word)), i -> concat(left(word, i - 1), substring(word, i + 1)))")
    rests = long.select(F.struct("word", "n").alias("of"), F.explode(F.array_distinct(F.array_append(without, F.col("word")))).alias("rest"))
    c, d = (rests.select(F.col("of").alias(x), "rest") for x in "ab")
    by_rest = c.join(d, (c["rest"] == d["rest"]) & (F.col("a.word") < F.col("b.word")) & (F.levenshtein("a.word", "b.word", 1) == 1)).select("a", "b")
    return merged.unionByName(by_rest).distinct().select(
        F.col("a.word").alias("a"), F.col("a.n").alias("a_n"), F.col("b.word").alias("b"), F.col("b.n").alias("b_n")
    )


def roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """(word, root) for a table (word, form): forms followed to the last. Each step up multiplies the count by ``ratio`` or more, so a chain has at most
    log(most) steps, and pointers that double reach its end in as many rounds as that number has binary digits."""
    found = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(math.ceil(math.log(max(most, 2), ratio)).bit_length()):
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        found = stage(found.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "spelling-roots")
    return found


def variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, every: int = EVERY, longest: int = LONGEST, list_size: int = LIST
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Of ``docs`` only doc_id and text are read, whole. A null text has no words; a null doc_id counts as the empty string in the hash. Repeated rows count
    each time. ``form`` is the near word of largest n, the first in code-point order among equals, if its n is at least ``ratio`` times the word's; ``root`` is
    where forms lead in the end. A word without near words has n_near 0. An empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("with a ratio under 2 forms could lead in circles")
    words = stage(count_words(docs, min_length, min_count, every), "spelling-words")
    pairs = stage(near_pairs(words, min_length, longest, list_size), "spelling-pairs")
    ways = pairs.selectExpr("a as word", "b as other", "b_n as other_n").unionByName(pairs.selectExpr("b as word", "a as other", "a_n as other_n"))
    best = ways.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best"))
    formed = F.col("best")["less"] <= -ratio * F.col("n")
    named = stage(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(formed, F.col("best")["other"]).alias("form"), F.when(formed, -F.col("best")["less"]).alias("form_n"),
        ),
        "spelling-forms",
    )
    most = words.agg(F.max("n")).first()[0] or 1
    ends = roots(named.filter("form is not null"), most, ratio)
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
