"""Contexts of the byte model reach over words, and frequent contexts are dealt by more bytes without a change of results."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest
from llm_cases import words

from larder.llm import lm_scoring, queries

TEXTS = ["the old mill", "the old mole ran", "a mole ran the mill", "Old  mill\tthe", "the mill old", "", None, "é ß the old"] * 6


def text_code(trained: list[bytes], text: bytes, order: int) -> float:
    """Log10 probability of a text by brute force: method C with exclusion over contexts through the whole text."""
    follow = defaultdict(Counter)
    pad = b" " * order
    for t in trained:
        t = pad + t
        for i in range(order, len(t)):
            for k in range(order + 1):
                follow[t[i - k : i]][t[i]] += 1
    total, text = 0.0, pad + text
    for i in range(order, len(text)):
        out: set[int] = set()
        for k in range(order, -1, -1):
            seen = {c: n for c, n in follow.get(text[i - k : i], {}).items() if c not in out}
            if not seen:
                continue
            mass = sum(seen.values()) + len(seen)
            if text[i] in seen:
                total += math.log10(seen[text[i]] / mass)
                break
            total += math.log10(len(seen) / mass)
            out |= set(seen)
        else:
            total -= math.log10(256 - len(out))
    return total


def joined(text: str | None) -> bytes:
    return b" ".join([*[w.lower() for w in words(text)], b"\n"])


@pytest.mark.parametrize("most", [lm_scoring.GRAMS_AT_ONCE, 3])
def test_texts_are_predicted_through_their_words(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(lm_scoring, "GRAMS_AT_ONCE", most)
    docs = list(enumerate(TEXTS))
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op8_lm_scoring(spark, str(tmp_path)).collect()}
    trained = [joined(t) for i, t in docs if zlib.crc32(str(i).encode()) % 5 != 1]
    assert len(got) == len(docs) > len(trained)
    for i, t in docs:
        assert got[i].score == pytest.approx(text_code(trained, joined(t), lm_scoring.ORDER))
    assert got[0].score != pytest.approx(got[4].score)  # the same words in another order
