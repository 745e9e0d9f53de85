"""Scopes, reuse by fingerprint, checks on the write, and tables that lie in buckets."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from larder.operators import quality
from larder.operators.joins import na_join
from larder.operators.quality import Check, CheckFailed
from larder.plans import chains
from larder.sources import staging
from larder.sources.staging import co_partitioned, scope, stage
from workloads.inputs import Tables

SF_DIR = "/root/testdata/sf0.001"


def files(path):
    return sorted(p for p in path.rglob("*") if p.is_file())


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    """A shared folder of the test's own; the session's can't be changed."""
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path / "shared"))
    return tmp_path


def lines(spark):
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet")


def test_a_scope_leaves_no_file_behind(spark, folder):
    with scope(spark) as outer:
        kept = stage(lines(spark).select("l_partkey"), "outer")
        with scope(spark) as inner:
            stage(lines(spark).select("l_partkey"), "inner", by="l_partkey")
            assert (inner.computed, outer.computed) == (["inner"], ["outer"])
        assert kept.count() > 0 and len(list((folder / "shared").rglob("outer-*"))) == 1
        assert not list((folder / "shared").rglob("inner-*"))
    assert files(folder) == []


def test_a_scope_is_closed_after_an_error(spark, folder):
    with pytest.raises(RuntimeError), scope(spark):
        stage(lines(spark).select("l_partkey"), "lost")
        raise RuntimeError
    assert files(folder) == [] and not staging._scopes


def test_an_unchanged_rerun_computes_nothing(spark, folder):
    def chain(path):
        with scope(spark, reuse=str(folder / "kept")) as s:
            table = spark.read.parquet(path)
            first = stage(table.filter("l_quantity > 3"), "first", by="l_orderkey", checks=[Check("large", "l_quantity > 49")])
            second = stage(first.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q")), "second")
            return {r.l_orderkey: r.q for r in second.collect()}, s

    path = str(folder / "input")
    lines(spark).write.parquet(path)
    want, s = chain(path)
    assert s.computed == ["first", "second"] and s.reused == []
    counts = s.counts["first"]
    before = files(folder)
    again, s = chain(path)
    assert again == want and s.computed == [] and s.reused == ["first", "second"] and s.counts["first"] == counts
    assert files(folder) == before
    lines(spark).filter("l_orderkey < 1000").write.mode("overwrite").parquet(path)
    changed, s = chain(path)
    assert s.computed == ["first", "second"] and len(changed) < len(want)


def test_plans_without_files_or_with_chance_are_not_reused(spark, folder):
    local = spark.createDataFrame([(1,)], "x int")
    assert staging.fingerprint(local) is None
    assert staging.fingerprint(spark.range(3).select("id")) is None
    assert staging.fingerprint(lines(spark).withColumn("r", F.rand())) is None
    assert staging.fingerprint(lines(spark).withColumn("r", F.current_date())) is None
    a, b = (staging.fingerprint(lines(spark).filter(F.col("l_quantity") > n)) for n in (3, 4))
    assert a and a != b and a == staging.fingerprint(lines(spark).filter(F.col("l_quantity") > 3))


def test_a_half_written_table_is_not_reused(spark, folder):
    df = lines(spark).select("l_partkey")
    kept = str(folder / "kept")
    df.limit(3).write.parquet(f"{kept}/half-{staging.fingerprint(df, None, None)}")
    with scope(spark, reuse=kept) as s:
        assert stage(df, "half").count() == df.count() and s.computed == ["half"]


def test_checks_count_in_the_job_that_writes(spark, folder):
    rows = spark.createDataFrame([(1, -2.0), (None, 3.0), (3, None), (1, 5.0)], "hhid int, quantity_g double")
    counts: dict[str, int] = {}
    with scope(spark) as s:
        checks = [*quality.not_negative(["quantity_g"], 1), *quality.key_known(["hhid"], None)]
        assert stage(rows, "checked", checks=checks, counts=counts).count() == 4
        assert counts == {"rows": 4, "negative_quantity_g": 1, "null_hhid": 1} == s.counts["checked"]
        with pytest.raises(CheckFailed) as failed:
            stage(rows, "failed", checks=quality.not_negative(["quantity_g"]))
        assert failed.value.counts["negative_quantity_g"] == 1 and not list(folder.rglob("failed-*"))


def test_repeated_keys_are_counted_as_a_lookup_is_written(spark, folder):
    lookup = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "item_code int, name string")
    counts: dict[str, int] = {}
    numbered = quality.numbered_copies(lookup, ["item_code"])
    table = stage(numbered, "lookup", checks=[quality.key_unique(None)], drop=[quality.COPY], counts=counts)
    assert table.columns == lookup.columns and table.count() == 5 and counts["repeated_key"] == 2
    with pytest.raises(CheckFailed):
        stage(numbered, "lookup", checks=[quality.key_unique()], drop=[quality.COPY])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def few_broadcasts(spark):
    """Only tables of a few rows are sent out, as at scale."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8000")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_households_meet_without_an_exchange(spark, few_broadcasts):
    t = Tables(spark, SF_DIR)
    homes = t.homes
    with co_partitioned(spark):
        afe = plan(chains.household_afe(homes.roster, homes.anthropometry, homes.child_ages, homes.pregnancies))
        assert "SortMergeJoin" in afe and "Exchange hashpartitioning" not in afe
        info = plan(chains.household_table(homes.cover, homes.roster, homes.education, t.afe, homes.expenditure))
        assert "SortMergeJoin" in info and not re.findall(r"Exchange hashpartitioning\((\w*hhid)", info)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = na_join(t.cons, t.hh.select("hhid", "afe"), "hhid", null_keys=False)
        joined = plan(rows.groupBy("hhid").agg(F.sum("quantity_g")))
        assert "SortMergeJoin" in joined and "Exchange" not in joined


def test_settings_are_restored(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    with co_partitioned(spark):
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key) == before


def test_rows_without_a_household_stop_the_load(spark):
    t = Tables(spark, SF_DIR)
    cover = t.cover.withColumn("hhid", F.when(F.col("ea") > 0, F.col("hhid")))
    with pytest.raises(CheckFailed, match="null_hhid"):
        chains.store_households(chains.Households(cover, t.roster, t.anthropometry, t.child_ages, t.pregnancies, t.education, t.expenditure))
