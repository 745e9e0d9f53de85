"""The moment histogram against plain Python, with zeros, negative values, missing values, ties and one hot group."""

from __future__ import annotations

import math
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larder.operators import cleaning
from larder.operators.histogram import MomentHistogram
from larder.operators.quantiles import group_median
from larder.sources.staging import stage


def log10(x):
    return -math.inf if x == 0 else math.log10(x) if x > 0 else None


def made(seed: int, zeros: bool) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(4000):
        item = rng.choice(["hot", "hot", "hot", *"abcdefgh", None])
        x = rng.choice([rng.lognormvariate(3, 1), round(rng.lognormvariate(2, 0.5), 1), 1e5 * rng.random(), 20.0])
        if rng.random() < 0.05:
            x = rng.choice([None, math.nan, -x, 0.0 if zeros else 3.0])
        y = None if rng.random() < 0.05 or x is None or math.isnan(x) else x / 100 * rng.choice([1, 1, 1, 2])
        rows.append((i, item, x, y))
    return [*rows, (9001, "one", 5.0, None), (9002, "none", None, 1.0), (9003, "two", 1.0, 1.0), (9004, "two", 3.0, 2.0)]


@pytest.fixture(scope="module", params=[(1, False), (2, True)])
def case(request, spark):
    rows = made(*request.param)
    return rows, stage(spark.createDataFrame(rows, "id long, item string, x double, y double"), "histogram-case")


def known(x):
    return x is not None and not math.isnan(x)


def cuts_of(rows, k):
    logs = defaultdict(list)
    for _, item, x, _ in rows:
        if known(x) and log10(x) is not None:
            logs[item].append(log10(x))
    return {
        item: None if len(v) < 2 or -math.inf in v else statistics.mean(v) + k * statistics.stdev(v) for item, v in logs.items()
    }


def test_moments(case):
    rows, df = case
    got = {r.item: r for r in MomentHistogram(df, ["item"], ["x", "y"]).moments().collect()}
    for item in {r[1] for r in rows}:
        values = [x for _, i, x, _ in rows if i == item and known(x)]
        r = got[item]
        assert (r.rows, r.n) == (sum(i == item for _, i, _, _ in rows), len(values))
        if values:
            assert r["mean"] == pytest.approx(statistics.mean(values)) and (r.low, r.high) == (min(values), max(values))
        assert r.sd == (pytest.approx(statistics.stdev(values)) if len(values) > 1 else None)


@pytest.mark.parametrize("k", [0.5, 1, 3])
def test_cut_points(case, k):
    rows, df = case
    want = cuts_of(rows, k)
    for r in MomentHistogram(df, ["item"], ["x"], log=True).cut_points(k).collect():
        assert r.upper_cut == (pytest.approx(want[r.item]) if want.get(r.item) is not None else None)


@pytest.mark.parametrize(("k", "largest"), [(0.2, 1_000_000), (0.2, 20), (1, 20), (3, 1_000_000)])
def test_replaced_outliers(case, k, largest):
    """With a low cut point many cells are open, so the middle ranks are uncertain over several buckets until these are read."""
    rows, df = case
    cuts = cuts_of(rows, k)
    xs, ys, kept = defaultdict(list), defaultdict(list), {}
    for i, item, x, y in rows:
        cut = cuts.get(item)
        x = x if known(x) and not (cut is not None and log10(x) is not None and log10(x) > cut) else None
        y = y if x is not None and known(y) else None
        kept[i] = (item, x, y)
        if x is not None:
            xs[item].append(x)
        if y is not None:
            ys[item].append(y)
    fill = lambda v, by, item: v if v is not None else statistics.median(by[item]) if by[item] else None
    want = {i: (fill(x, xs, item), fill(y, ys, item)) for i, (item, x, y) in kept.items()}
    got = {r.id: (r.x, r.y) for r in cleaning.replace_outliers(df, "item", ["x", "y"], k, largest_bucket=largest).collect()}
    assert got == want


def test_one_histogram_equals_the_three_steps(case):
    _, df = case
    kept = cleaning.blank_where_missing(cleaning.outlier_log_sd(df, "item", "x"), "y", where="x")
    steps = cleaning.impute_group_median(kept, "item", ["x", "y"])
    assert sorted(map(str, cleaning.replace_outliers(df, "item", ["x", "y"]).collect())) == sorted(map(str, steps.collect()))


def test_medians_of_some_groups(case):
    rows, df = case
    some = df.filter("item IN ('hot', 'two')").select("item").distinct()
    got = {r.item: (r.x, r.y) for r in MomentHistogram(df, ["item"], ["x", "y"]).medians(groups=some).collect()}
    for item in ("hot", "two"):
        assert got[item] == tuple(statistics.median([r[c] for r in rows if r[1] == item and known(r[c])]) for c in (2, 3))
    assert got.keys() == {"hot", "two"}
    every = {r.item: (r.x, r.y) for r in group_median(df, ["item"], ["x", "y"]).collect()}
    assert every["hot"] == got["hot"] and every["none"] == (None, 1.0)


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, item string, x double, y double")
    assert cleaning.replace_outliers(df, "item", ["x", "y"]).isEmpty()
    assert MomentHistogram(df, ["item"], ["x"]).moments().isEmpty()


def test_only_few_rows_are_stored(spark, case, monkeypatch):
    """What the cleaning stores: cells, and the rows of cells that a cut point or a middle rank falls into."""
    _, df = case
    from larder.operators import histogram

    stored = {}

    def counted(table, label, **options):
        stored[label] = (out := stage(table, label, **options)).count()
        return out

    monkeypatch.setattr(histogram, "stage", counted)
    cleaning.replace_outliers(df.filter(F.col("x") > 0), "item", ["x", "y"]).count()
    assert stored["histogram-rows"] < df.count() / 8  # a quarter of all values are equal, and in the middle
