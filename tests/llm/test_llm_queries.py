"""Registered queries against their SQL, and the pipeline against a brute-force version."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_text_operators import PATTERNS, holds, shingles

import __spark_entry__
import corpus_pipeline
from larder.llm import mixing
from larder.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


def duck():
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    got = __spark_entry__.queries()[name](spark, SF).toPandas()
    want = duck().execute(ORACLE[name]).df()[list(got.columns)]
    for frame in (got, want):
        frame.sort_values(frame.columns[0], inplace=True, ignore_index=True)
    got, want = (frame.astype(object).where(frame.notna(), None) for frame in (got, want))
    assert got.equals(want)


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_pipeline(spark):
    """Quality by the SQL check, the other stages by plain Python."""
    from tokenizers import Tokenizer

    kept = {r[0] for r in duck().execute(f"select doc_id from ({ORACLE['op1_quality_rules']}) where kept").fetchall()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.doc_id in kept}
    sets = {i: shingles(r.text, 5) for i, r in docs.items()}
    low = {i: i for i in docs}
    for _ in range(3):
        for a in docs:
            for b in docs:
                if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
    docs = {i: r for i, r in docs.items() if low[i] == i}

    def clean(text):
        spans = sorted((m.start(), -m.end(), k) for k, p in PATTERNS.items() for m in re.finditer(p, text) if holds(k, m[0]))
        out, last = [], 0
        for a, b, kind in spans:
            if a >= last:
                out += [text[last:a], f"[{kind.upper()}]"]
            last = max(last, -b)
        return "".join([*out, text[last:]])

    texts = {i: clean(r.text) for i, r in docs.items()}
    frame = spark.createDataFrame([(i, t, docs[i].source) for i, t in texts.items()], "doc_id long, text string, source string")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for r in mixing.mix(frame).collect():
        copies = [texts[r.doc_id]] * r.repeats
        if r.part:
            copies.append(texts[r.doc_id] if r.part == r.size else b" ".join(texts[r.doc_id].encode().split()[: r.part]).decode())
        for text in copies:
            expected[r.doc_id, len(tokenizer.encode(text, add_special_tokens=False).ids) + 1] += 1
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert Counter(zip(*[got.loc[got["start"] == 0, c] for c in ("doc_id", "doc_tokens")], strict=True)) == expected
    assert got["length"].sum() == sum(n * c for (_, n), c in expected.items())
    places = defaultdict(list)
    for s, o, n in zip(got["sequence_id"], got["offset"], got["length"], strict=True):
        places[s].append((o, n))
    for pieces in places.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [0, *np.cumsum([n for _, n in pieces])[:-1]] and sum(n for _, n in pieces) <= 2048


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(F.col("doc_id") < 60)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "personal data", "mixing", "packing"]
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, SF).columns == docs.columns
