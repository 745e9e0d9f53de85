"""Vantage-point search against all inner products."""

from __future__ import annotations

import numpy as np
import pytest

from larder.llm import vp_search


def exact(ids, vectors, k):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        scores = np.array([float(np.dot(vectors[i], v)) for v in vectors])
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("kind", ["lengths differ", "many equal"])
def test_exact_with_factor_one(spark, kind):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(700, 8)) * (rng.uniform(0.2, 3, size=(700, 1)))
    if kind == "many equal":
        vectors[::3] = vectors[0]
    ids = rng.permutation(2000)[:700]
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<double>")
    got, want = found(vp_search.search(frame, factor=1.0, shard=100)), exact(ids, vectors, 20)
    assert got.keys() == want.keys()
    for q, neighbours in want.items():
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in neighbours])
        assert [i for i, _ in got[q]] == [i for i, _ in neighbours]


def test_recall_with_production_factor(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.toPandas()
    want = exact(rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float), 20)
    got = found(vp_search.search(frame, shard=256))
    hits = [len({i for i, _ in got[q]} & {i for i, _ in n}) / len(n) for q, n in want.items()]
    assert np.mean(hits) >= 0.95


def test_unusable_vectors_and_few_candidates(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [float("inf"), 0.0]),
        (None, [1.0, 1.0]), (20, [0.0, 2.0]), (40, [1.0, 2.0, 3.0]), (7, []),
    ]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, v string")
    got = found(vp_search.search(frame))
    assert got == {0: [(1, 0.5), (20, 0.0)], 20: [(1, 1.0), (0, 0.0)]}
    assert vp_search.search(frame.limit(0)).count() == 0
