"""What medians and staged tables leave on disk, and what they shuffle."""

from __future__ import annotations

import re
import statistics
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larder.operators import cleaning, quantiles
from larder.sources.staging import stage


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_") and name.endswith(".data")}


@pytest.mark.parametrize("by", [None, "k"])
def test_a_staged_table_leaves_no_shuffle_files(spark, by):
    before = shuffle_files(spark)
    counts = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count()
    table = stage(counts, "counts", by, buckets=3 if by else None)
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    assert table.agg(F.sum("count")).first()[0] == 1000
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(key, None) in (None, "false")


def rows() -> list[tuple]:
    out = [("hot", float(i * 7919 % 1013), None if i % 3 else float(i)) for i in range(900)]
    out += [(f"item{i}", float(i * j % 17), float(j)) for i in range(40) for j in range(1 + i % 6)]
    return out + [(None, 1.0, None), (None, 4.0, None), ("none", None, float("nan"))]


@pytest.mark.parametrize("largest", [1, 5, 10**6])
def test_medians_of_small_and_large_groups(spark, largest):
    data = rows()
    found = quantiles.group_median(spark.createDataFrame(data, "k string, x double, y double"), ["k"], ["x", "y"], largest_bucket=largest)
    known = defaultdict(lambda: ([], []))
    for k, *values in data:
        for v, into in zip(values, known[k], strict=True):
            if v is not None and v == v:
                into.append(v)
    want = {k: tuple(statistics.median(v) if v else None for v in both) for k, both in known.items() if any(both)}
    assert {r.k: (r.x, r.y) for r in found.collect()} == want and "none" not in want


def test_medians_of_small_groups_take_one_exchange_of_their_rows(spark, monkeypatch):
    """No count per bucket is shuffled, of which there are more than rows where groups are small; and the rows are not melted."""
    df = stage(spark.createDataFrame(rows(), "k string, x double, y double"), "rows")
    stored, write = {}, quantiles.stage

    def noted(table, label, **options):
        stored[label] = table._jdf.queryExecution().executedPlan().toString()
        return write(table, label, **options)

    monkeypatch.setattr(quantiles, "stage", noted)
    text = quantiles.group_median(df, ["k"], ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert stored.keys() == {"large-groups"} and "partial_count(1)" in stored["large-groups"]
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1 and "Generate" not in text
    assert cleaning.impute_group_median(df, "k", ["x", "y"]).filter("k = 'hot' AND y IS NULL").isEmpty()
