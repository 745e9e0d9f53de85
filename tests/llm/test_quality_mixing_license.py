"""Native operators against plain Python on small documents."""

from __future__ import annotations

import math
import re
from collections import Counter

import llm_cases
import pytest
from pyspark.sql import functions as F

from larder.llm import common, license_scan, mixing, quality_rules


def counts(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_base_filter(cases):
    rows = quality_rules.judge(cases).collect()
    expected = Counter((i, *counts(t)) for i, t, *_ in llm_cases.texts())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == expected
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_keeps_rows_as_they_were(cases):
    kept = quality_rules.keep_good(cases)
    assert kept.columns == cases.columns
    assert kept.exceptAll(cases).count() == 0
    assert {1, 2, 3, 9, 12} <= {r.doc_id for r in kept.collect()}


def test_quality_agrees_with_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "label")
    judged = quality_rules.judge(docs).join(labels, "doc_id").filter("not base_failed")
    wrong = judged.filter((F.col("label") == 1) != F.col("kept")).count()
    assert wrong <= 0.01 * judged.count()


def test_estimation_finds_accuracies(spark):
    """Votes drawn from known accuracies: the estimates come near them."""
    import random

    rng = random.Random(3)
    truth = [0.95, 0.9, 0.8, 0.7, 0.65]
    rows = []
    for _ in range(4000):
        good = 1 if rng.random() < 0.7 else -1
        rows.append(([0 if rng.random() < 0.2 else good if rng.random() < a else -good for a in truth],))
    fitted = quality_rules.fit(spark.createDataFrame(rows, "votes array<int>"), len(truth)).first()
    assert fitted.good_share == pytest.approx(0.7, abs=0.05)
    assert fitted.accuracy == pytest.approx(truth, abs=0.06)


def water(sizes, weights, epochs):
    """Pour in rounds, as the definition says."""
    targets, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    total, caps = sum(sizes.values()), {s: epochs * n for s, n in sizes.items()}
    while open_:
        left = total - sum(targets[s] for s in sizes if s not in open_)
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > caps[s]}
        for s in over or open_:
            targets[s] = min(share[s], caps[s])
        open_ -= over or open_
    return targets


def test_mixing_targets(spark):
    sizes = {"a": 1000, "b": 10, "c": 700, "d": 0, "e": 3, "f": 900, None: 40}
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    names = [*sorted(s for s in sizes if s is not None), None]
    expected = water(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 3)
    assert got == pytest.approx(expected)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mixing_takes_near_target_and_applies(cases, corpus):
    for docs in (cases, corpus):
        rows = mixing.mix(docs, keep_rows=True).select("*", "row.source").collect()
        assert len(rows) == docs.count()
        taken, targets = Counter(), {}
        for r in rows:
            assert 0 <= r.taken <= 3 * r.size
            taken[r.source] += r.taken
            targets[r.source] = r.target
        docs_of = Counter(r.source for r in rows)
        for s, target in targets.items():
            assert abs(taken[s] - target) <= max(2, 0.5 * docs_of[s])
        mixed = mixing.apply_mix(docs)
        assert mixed.columns == docs.columns
        assert mixed.agg(F.sum(mixing.size_of(F.col("text")))).first()[0] == sum(taken.values())
    again = mixing.mix(corpus).collect()
    assert sorted(again) == sorted(mixing.mix(corpus.repartition(5)).collect())


def test_mixing_stores_no_copy_of_the_texts(spark, tmp_path, monkeypatch):
    docs = [(i, "ab"[i % 2], " ".join(str(i * 7919 + k) for k in range(i % 50))) for i in range(400)]
    spark.createDataFrame([*docs, (None, None, None)], "doc_id long, source string, text string").write.parquet(str(tmp_path / "docs"))
    table, stored = spark.read.parquet(str(tmp_path / "docs")), []
    sizes = {r.doc_id: r for r in mixing.mix(table).collect()}
    monkeypatch.setattr(mixing, "stage", lambda df, label: stored.append(df.schema.simpleString()) or common.stage(df, label))
    words = Counter()
    for r in mixing.apply_mix(table).collect():
        words[r.doc_id] += len(r.text.split())
    assert words == Counter({i: r.taken for i, r in sizes.items() if r.taken})
    assert stored and not any("text" in columns for columns in stored)


def test_licenses_found_and_others_left(spark, cases):
    notices = [
        (101, "Text before.\nLicensed under the Apache License, Version 2.0.\nand after", "apache"), (102, "Released under the MIT License.", "mit"),
        (103, "This work is licensed under the GNU General Public License, version 3.", "gpl"), (104, "Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        (105, "All rights reserved.", "proprietary"), (106, "The license of the driver was general and all the rights of way were free.", "unknown"),
        (107, "He asked for permission to use the copy in the public library.", "unknown"),
    ]
    docs = cases.select("doc_id", "text").union(spark.createDataFrame([n[:2] for n in notices], "doc_id long, text string"))
    rows = license_scan.scan(docs).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: r for r in rows}
    for doc_id, _, family in notices:
        assert got[doc_id].license == family, doc_id
    assert all(r.license == "unknown" and r.confidence == 0 for i, r in got.items() if i is None or i < 100)
    assert all(0.5 <= r.confidence <= 1 and not math.isnan(r.confidence) for r in rows if r.n_notices)


def test_empty_tables(empty):
    assert quality_rules.judge(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert license_scan.scan(empty).count() == 0
