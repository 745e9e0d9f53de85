"""Every registered query against its SQL counterpart, and the shape of its plan."""

from __future__ import annotations

import re

import pytest
from compare import connect, differences

import __spark_entry__
from larder.operators import cleaning, intake
from larder.sources.staging import stage
from workloads.inputs import Tables
from workloads.registry import FUNCTIONS, ORACLE

SF_DIR = "/root/testdata/sf0.001"
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"]


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF_DIR)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    queries, sql = __spark_entry__.queries().keys(), __spark_entry__.oracle_sql().keys()
    assert ORACLE.keys() == FUNCTIONS.keys()
    assert FUNCTIONS.keys() <= sql <= queries


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns[0] == "hhid" and df.count() > 0


@pytest.mark.parametrize("name", list(FUNCTIONS))
def test_query_matches_sql(name, tables, con):
    df = FUNCTIONS[name](tables)
    text = plan(df)
    assert not [node for node in UNWANTED if node in text]
    assert differences(df, con, __spark_entry__.oracle_sql()[name]) == []


def test_intake_shuffles_the_rows_once_after_a_partial_sum(tables):
    cons = stage(tables.cons, "plain-rows")
    text = plan(intake.apparent_intake(cons, tables.fct, tables.hh))
    assert len(re.findall(r"Exchange hashpartitioning\(hhid", text)) == 1
    assert "partial_sum(energy_kcal" in text and "SinglePartition" not in text
    scan = next(line for line in text.splitlines() if "FileScan parquet [hhid" in line and "quantity_100g" in line)
    assert "quantity_g#" not in scan and "food_group" not in scan
    # and not at all where they lie in buckets of the household
    assert "Exchange hashpartitioning(hhid" not in plan(intake.apparent_intake(tables.cons, tables.fct, tables.hh))


def test_large_lookups_are_not_broadcast(spark, tables):
    cons, fct, hh = (stage(df, "plain") for df in (tables.cons, tables.fct, tables.hh))  # stored before the threshold changes
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(intake.apparent_intake(cons, fct, hh))
        assert "Broadcast" not in text
        # The sums and the join with the equivalents share one partitioning of the household id.
        assert len(re.findall(r"Exchange hashpartitioning\(hhid", text)) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cleaning_does_not_shuffle_the_rows(tables):
    rows = stage(tables.cons, "rows")
    text = plan(cleaning.outlier_log_sd(rows, "item_code", "quantity_g"))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_filters_and_columns_reach_the_scan(tables):
    adult = tables.hh_info.filter("age_head >= 18 AND res = 'Urban'").select("hhid", "afe")
    scan = next(line for line in plan(adult).splitlines() if "FileScan" in line)
    assert "adm1" not in scan and "survey_wgt" not in scan
    filters = tables.hh_info.filter("age_head >= 18")._jdf.queryExecution().explainString(
        tables.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(age_head,18)" in filters
    raw = plan(FUNCTIONS["join_left"](tables))
    assert "l_discount" not in raw and "l_linenumber" not in raw and "l_tax" in raw
