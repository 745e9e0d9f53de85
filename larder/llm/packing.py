"""Packing documents into sequences of a fixed capacity: harmonic packing.

Lengths are partitioned into classes by reciprocal capacity: class ``k`` takes pieces of at most ``capacity // k`` tokens and
fills each of its sequences with exactly ``k`` pieces. A piece therefore needs nothing but its number within its class to know
its sequence, so workers fill the bins of a class independently of each other.

A document is cut first into whole sequences; what remains is cut at the largest class size that fits, until the rest lies
within a small slack under a class size. So padding is the slack, and most documents are cut two or three times.

Each task numbers the pieces of a class it makes; the counts per class and task, summed up, give every task its first
number. Only the last, incomplete sequence of each class is left. These pieces, fewer than ``capacity`` for each of the some 90
class sizes whatever the input's size, are packed first-fit decreasing in one small task.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import give_back, stage, tidy, with_rows

CAPACITY = 2048
END_ID = 1
#: A piece may be this much shorter than its class allows: tokens, or a share of the class size.
SLACK, SLACK_SHARE = 2, 1 / 64
#: Bytes of words, and of their parts, that a task remembers with their ids; each memory is emptied when full. ``ENTRY`` is what an entry takes
#: beside its key and its ids.
REMEMBERED, ENTRY = 110_000_000, 200
#: Bytes of ids from which the pieces made so far are passed on.
PASSED_ON = 8_000_000

#: Lower-case letters whose words need no normalising: ASCII and Latin-1.
PLAIN = frozenset("abcdefghijklmnopqrstuvwxyz\u00df") | frozenset(chr(c) for c in range(0xE0, 0x100) if c != 0xF7)
#: Byte-level vocabularies write a byte as the Latin-1 letter if that is printable, the others from code point 256 on.
_printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _printable)}
PUNCTUATION = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())


class Memory(dict):
    """What ``make`` gives for a key, made once. What is held is bounded in bytes: see ``trim``."""

    def __init__(self, make):
        self.make, self.size = make, 0

    def __missing__(self, key: bytes) -> bytes:
        value = self[key] = self.make(key)
        self.size += ENTRY + len(key) + len(value)
        return value

    def trim(self, most: int) -> None:
        if self.size > most:
            self.clear()
            self.size = 0


class Model:
    """Token ids of a part of a word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        give_back()  # reading the file took several times what the tokenizer holds

    def __call__(self, part: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        text = part.decode()
        lower = text.lower()
        if part.isalpha() or PLAIN.issuperset(lower):
            letters = lower if part.isascii() else lower.encode().decode("latin-1").translate(BYTE_LETTERS)
            ids = [token.id for token in self.model.tokenize(letters)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


class Words:
    """Token ids of a word from those of its parts. The tokenizer cuts between a letter or digit and punctuation; a word that may hold a
    special token stays whole."""

    def __init__(self, parts: Memory):
        self.parts = parts

    def __call__(self, word: bytes) -> bytes:
        if b"<|" in word:
            return self.parts[word]
        word = word.lower()
        stem = word.rstrip(PUNCTUATION)
        if stem != word and stem[-1:].isalnum():
            return self.parts[stem] + self.parts[word[len(stem) :]]
        return self.parts[word]


class WordTokenizer:
    """Token ids of texts by a byte-level word tokenizer that lowers case and drops white space.

    A text's ids are its words' ids one after another, so every word is tokenized once. Words that differ in ASCII case or in
    closing punctuation share their parts; a plain word goes straight to the tokenizer's model, any other through all its steps.
    Model, parts and words refer to each other in one direction only, so all of it goes as soon as the tokenizer does.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.parts = Memory(Model(path))
        self.known = Memory(Words(self.parts))

    def __call__(self, text: bytes | None) -> bytes:
        """The ids of a text; of a null text none."""
        self.known.trim(self.remembered)
        self.parts.trim(self.remembered)
        return b"".join(map(self.known.__getitem__, (text or b"").split()))


def cut(n: int, capacity: int = CAPACITY) -> Iterator[tuple[int, int]]:
    """Lengths of the pieces of a document of ``n`` tokens, each with the number of pieces in a sequence of its class."""
    for _ in range(n // capacity):
        yield capacity, 1
    n %= capacity
    while n:
        per = capacity // n
        room = capacity // per
        if room - n <= max(SLACK, int(room * SLACK_SHARE)):
            yield n, capacity // room
            return
        size = capacity // (per + 1)
        yield size, capacity // size
        n -= size


def piece_schema(with_ids: bool) -> str:
    ids = ", ids binary" if with_ids else ""
    return f"doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, per int, task int, number bigint{ids}"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, with_ids: bool, remembered: int) -> DataFrame:
    """The pieces of every document, numbered by class within the task that made them."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    names = [part.split()[0] for part in piece_schema(with_ids).split(", ")]
    kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()] + [pa.binary()] * with_ids
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize = WordTokenizer(tokenizer_path, remembered)
        task = TaskContext.get().partitionId()
        numbers: dict[int, int] = {}
        columns: list[list] = [[] for _ in names]
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                doc_id, ids = doc_id.as_py(), tokenize(text.as_py()) + end
                n, start = len(ids) // 4, 0
                for length, per in cut(n, capacity):
                    own = ids[4 * start : 4 * (start + length)]
                    number = numbers.get(per, 0)
                    numbers[per] = number + 1
                    row = (doc_id, start, length, zlib.crc32(own), n, per, task, number, own)
                    for column, value in zip(columns, row, strict=False):
                        column.append(value)
                    start += length
                held += len(ids)
                if held >= PASSED_ON:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], schema=schema)
                    columns, held = [[] for _ in names], 0
        if columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], schema=schema)

    return docs.mapInArrow(tidy(run), piece_schema(with_ids))


def first_fit(capacity: int):
    """Packs the few left pieces; ``sequence_id`` counts from 0."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "per", "number"], ascending=[False, True, True], kind="stable")
        used: list[int] = []
        sequence, offset = [], []
        for length in rows["length"]:
            at = next((i for i, u in enumerate(used) if u + length <= capacity), len(used))
            if at == len(used):
                used.append(0)
            sequence.append(at)
            offset.append(used[at])
            used[at] += length
        return rows.assign(sequence_id=sequence, offset=offset).drop(columns=["per", "number"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, 32-bit little-endian).

    ``docs`` has doc_id and text; other columns don't matter. A null, empty or blank text is a document of the end id alone.
    Repeated rows are documents of their own. An empty table gives an empty result. A piece is at most ``capacity`` long; every
    id of a document, its end id included, lies in one piece. Pieces are stored once, so sequences are whole even if a task that
    made them runs again elsewhere. A task remembers words in twice ``remembered`` bytes; less costs time only.
    """
    rows = with_rows(docs).select(
        F.col("row")["doc_id"].cast("bigint").alias("doc_id"), F.col("row")["text"].cast("binary").alias("text")
    )
    made = stage(pieces(rows, tokenizer_path, capacity, with_ids, remembered), "pieces")
    counts = made.groupBy("per", "task").agg(F.count("*").alias("n"))
    by_task = Window.partitionBy("per").orderBy("task")
    counts = stage(counts.withColumn("before", F.sum("n").over(by_task) - F.col("n")), "piece-counts")
    classes = counts.groupBy("per").agg(F.sum("n").alias("n")).orderBy("per").collect()  # a row per class size, some 90
    bins = [(c.per, c.n // c.per) for c in classes]
    bases = np.cumsum([0, *[n for _, n in bins]]).tolist()
    per_class = F.create_map(*[F.lit(x) for (per, n), base in zip(bins, bases, strict=False) for x in (per, F.struct(F.lit(n).cast("long").alias("full"), F.lit(base).cast("long").alias("base")))]) if bins else None
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    ids = ["ids"] if with_ids else []
    if per_class is None:
        return made.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).select(
            *columns, "sequence_id", "offset", *ids
        )
    offsets = counts.select("per", "task", "before", per_class[F.col("per")].alias("bins"))
    numbered = made.join(offsets, ["per", "task"]).withColumn("number", F.col("number") + F.col("before"))
    numbered = numbered.withColumn("bin", F.floor(F.col("number") / F.col("per")))
    full = numbered.filter("bin < bins.full").withColumn("sequence_id", F.col("bins.base") + F.col("bin"))
    alone = full.filter("per = 1").withColumn("offset", F.lit(0).cast("long"))
    in_order = Window.partitionBy("sequence_id").orderBy("number")
    shared = full.filter("per > 1").withColumn("offset", F.sum("length").over(in_order) - F.col("length"))
    left = numbered.filter("bin >= bins.full").select(*columns, *ids, "per", "number")
    schema = ", ".join(f"{c} bigint" for c in columns) + (", ids binary" if with_ids else "") + ", sequence_id bigint, offset bigint"
    rest = left.groupBy().applyInPandas(first_fit(capacity), schema)
    rest = rest.withColumn("sequence_id", F.col("sequence_id") + bases[-1])
    out = [*columns, "sequence_id", "offset", *ids]
    return alone.select(out).unionByName(shared.select(out)).unionByName(rest.select(out))
