"""The byte model keeps every counted gram, however rare."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest
from llm_cases import words
from test_text_operators import ppm

from larder.llm import lm_scoring


def test_rare_words_keep_their_contexts(spark):
    """One word among two million training bytes: its entries are less than a millionth of them."""
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = next(i for i in range(40, 99) if zlib.crc32(str(i).encode()) % 5 == 1)
    docs = [(i, "tarn mole " * 10_000) for i in ids[1:]] + [(ids[0], "zyzzyva"), (held, "zyzzyva zyzzyx")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_scoring.score(frame).collect()}
    counts = Counter(w for i, t in docs if i != held for w in [*words(t), b"\n"])
    assert sum(len(w) * n for w, n in counts.items()) > 2_000_000
    for i in (ids[0], held):
        text = dict(docs)[i]
        assert got[i] == pytest.approx(sum(ppm(counts, lm_scoring.ORDER, w) for w in [*words(text), b"\n"]))
