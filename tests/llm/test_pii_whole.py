"""Disclosing terms anywhere in a document, and rows that share an id or have none."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from larder.llm import pii

SPACE = " the and of it was on a day when they all went out to see how things are by now so far"


def fillers(n):
    return [(100 + i, f"number {i}{SPACE}") for i in range(n)]


def test_terms_far_from_an_entity_in_two_texts(spark):
    """Two texts are enough, and the name goes in the next paragraph as well."""
    docs = [(i, f"zaph@example.org {opening}{SPACE}\n\nsincerely, Zaphod and again{SPACE} Zaphod") for i, opening in enumerate(["hello", "goodbye"])]
    frame = spark.createDataFrame(docs + fillers(60), "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitize(frame).collect()}
    assert all("Zaphod" not in clean[i] and "example" not in clean[i] and "went out" in clean[i] for i in (0, 1))
    assert all(clean[i] == t for i, t in fillers(60))


def test_rows_without_or_with_one_id(spark):
    """Every row loses its own identifiers and nothing else."""
    texts = ["write to one@example.org soon", "nothing to hide in this text", "from 10.1.2.3 and on, longer than the others are", "+49 30 1234567 is mine"]
    docs = [(i, t) for i in (None, 7) for t in texts]
    got = sorted(r.text for r in pii.sanitize(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == sorted(2 * ["write to [EMAIL] soon", texts[1], "from [IP] and on, longer than the others are", "[PHONE] is mine"])


def test_a_task_counts_a_term_once_whatever_its_batches():
    texts = ["zephyr quartz", "Zephyr", None, "quartz zephyr zephyr", "quartz"] * 3
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[i : i + 2], pa.string())}) for i in range(0, len(texts), 2)]
    everything = np.packbits(np.ones(2 * pii.BITS + 32768, np.uint8), bitorder="little").tobytes()
    out = [r for b in pii.frequencies(everything)(iter(batches)) for r in b.to_pylist()]
    assert sorted((r["term"], r["n"]) for r in out) == [("quartz", 9), ("zephyr", 9)]
