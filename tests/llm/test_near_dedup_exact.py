"""Large regions of texts that are alike without being linked, with planted links among them."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import near_dedup


def sets_of(texts, size=5):
    out = {}
    for i, text in texts:
        ws = text.lower().split()
        out[i] = {tuple(ws[k : k + size]) for k in range(max(len(ws) - size + 1, 1))} if ws else set()
    return out


def plain_components(texts, threshold=80):
    sets = sets_of(texts)
    low = {i: i for i in sets}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                low[y] = x
    return {i: find(i) for i in ids}


def template(seed: int, n: int, common: int, own: int, planted: int, changed: int):
    """Texts of ``common`` shared words and ``own`` words; the first ``planted`` have a partner in which ``changed`` of these are other words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    shared = [word() for _ in range(common)]
    texts = []
    for i in range(n):
        tail = [word() for _ in range(own)]
        texts.append(shared + tail)
        if i < planted:
            texts.append(shared + tail[:-changed] + [word() for _ in range(changed)])
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("n", "common", "own", "planted", "changed"), [(660, 170, 40, 120, 21), (300, 180, 24, 40, 20)])
def test_links_in_a_large_region_equal_brute_force(spark, n, common, own, planted, changed):
    texts = template(3, n, common, own, planted, changed)
    want = plain_components(texts)
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.component_id for r in near_dedup.link(frame).collect()}
    assert sum(want[i] != i for i in want) >= planted * 0.9
    assert got == want


def test_one_large_component_and_texts_close_to_it(spark):
    """A thousand edits of one text, all linked, and texts just below and above the threshold to some of them."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    base = [word() for _ in range(160)]
    texts = []
    for i in range(300):
        t = list(base)
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(160)] = word()
        texts.append(t)
    for i in range(80):
        t = list(rng.choice(texts[:300]))
        t[-rng.randint(12, 24) :] = [word() for _ in range(18)]
        texts.append(t)
    texts = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = plain_components(texts)
    got = {r.doc_id: r.component_id for r in near_dedup.link(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == want and len(set(want.values())) > 3


def test_exact_keys_meet_for_every_link():
    """Whatever the sizes, two sets at the threshold share a key; those of unlinked ones of equal size that differ enough don't."""
    rng = np.random.default_rng(4)
    firsts = near_dedup.size_classes(1 << 20)
    counts = np.zeros(near_dedup.COUNTERS, np.int64)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        m = int(rng.integers(n, max(n, n * 100 // 80) + 1))
        common = -(-80 * (n + m) // 180)
        if common > n:
            continue
        pool = rng.integers(1, 2**63, n + m - common, dtype=np.uint64)
        x, y = np.sort(pool[:n]), np.sort(np.concatenate([pool[:common], pool[n:]]))
        keys = []
        for s in (x, y):
            own = set()
            ranked = s[np.lexsort((s, counts[near_dedup.counter(s)]))]
            for small, large, k in near_dedup.first_shingles(len(s), 80, firsts):
                own |= {(small, large, int(v)) for v in ranked[:k]}
            keys.append(own)
        assert keys[0] & keys[1], (n, m, common)


def test_thresholds_that_are_not_served(spark):
    with pytest.raises(ValueError):
        near_dedup.link(spark.createDataFrame([(1, "a")], "doc_id long, text string"), threshold=50)


def test_short_edits_of_one_text_meet_in_blocks(spark, monkeypatch):
    """Edits that are alike by 0.72 share their commonest words' shingles with hundreds of others; some of them are linked."""
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", 100)
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    base, texts = [word() for _ in range(100)], []
    for i in range(400):
        t = list(base)
        for at in rng.sample(range(10, 90, 8), 2):
            t[at] = word()
        texts.append(t)
        if i % 10 == 0:
            t = list(t)
            t[rng.randrange(100)] = word()
            texts.append(t)
    texts = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = sets_of(texts, 4)
    want = plain_components(texts)
    got = {r.doc_id: r.component_id for r in near_dedup.link(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()}
    assert len(sets) == 440 and got == want and len(set(want.values())) > 20


def test_lists_of_the_same_documents_meet_once(spark):
    """Sixty lists of forty documents are one family; lists that a document chains are dealt by key, where that takes fewer rows."""
    rows = [(key, i, i, 40, 400, 0) for key in range(60) for i in range(40)]
    rows += [(100 + k, 1000 + 39 * k + i, 1, 40, 400, 1000 + 39 * k) for k in range(50) for i in range(40)]
    lists = spark.createDataFrame(rows, "key long, id long, component long, n long, cells long, least long")
    sets = lists.select("id", "component").distinct().selectExpr("id", "component", "cast(repeat('x', 80) as binary) as set")
    blocks = F.ceil(F.col("n") / 40).cast("int")
    got = near_dedup.units_of(lists, sets, blocks).groupBy("of", "unit").agg(F.count("*").alias("n"), F.max("blocks").alias("blocks")).collect()
    want = {("family", 0): (40, 1)} | {("key", 100 + k): (40, 1) for k in range(50)}
    assert {(r.of, r.unit): (r.n, r.blocks) for r in got} == want
