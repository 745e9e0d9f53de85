"""A household and an item that each hold a third of all rows, with and without broadcast joins."""

from __future__ import annotations

import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larder.operators import intake
from larder.plans import chains
from larder.sources.staging import stage


@pytest.fixture(scope="module")
def skewed(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    third = F.col("l_linenumber") % 3
    rows = lines.select(
        F.when(third == 0, "hot").otherwise((F.col("l_orderkey") % 90).cast("string")).alias("hhid"),
        F.when(third == 1, 0).otherwise(F.col("l_partkey")).alias("item_code"),
        (F.col("l_extendedprice") / 97).alias("quantity_g"),
    )
    rows = rows.withColumn("quantity_g", F.when(F.col("quantity_g") < 30, None).otherwise(F.col("quantity_g")))
    cons = stage(rows.withColumn("quantity_100g", F.col("quantity_g") / 100).withColumn("food_group", F.lit("any")), "skewed")
    hh = stage(rows.select("hhid").distinct().withColumn("afe", 1 + F.length("hhid") / 2), "skewed-hh")
    fct = stage(
        rows.select("item_code").distinct().withColumns({"item_name": F.lit("x"), "fe_mg": F.col("item_code") % 7 + 0.5}),
        "skewed-fct",
    )
    return cons, hh, fct


def test_hot_groups_give_the_same_results_on_every_path(spark, skewed):
    cons, hh, fct = skewed
    shares = {r.hhid: r.n for r in cons.groupBy("hhid").agg(F.count("*").alias("n")).collect()}
    assert shares["hot"] > 0.25 * sum(shares.values())

    def results(**options):
        clean = chains.clean_consumption(cons, hh, **options)
        base = intake.apparent_intake(stage(clean, "clean"), fct, hh)
        means = intake.food_group_mean_intake(hh, cons, fct)
        return {r.hhid: r.fe_mg for r in base.collect()}, clean.count(), means.first().fe_mg

    plain = results()
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            split = results(largest_bucket=50)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert split[0] == pytest.approx(plain[0]) and split[1:] == (plain[1], pytest.approx(plain[2]))


def test_imputed_values_are_the_medians_of_the_items(skewed):
    cons, hh, _ = skewed
    unit = defaultdict(list)
    afe = {r.hhid: r.afe for r in hh.collect()}
    for r in cons.collect():
        if r.quantity_g is not None:
            unit[r.item_code].append(r.quantity_g / afe[r.hhid])
    clean = chains.clean_consumption(cons, hh, k=1e9, largest_bucket=50).collect()
    assert len(clean) == cons.count()
    filled = defaultdict(set)
    known = {(r.hhid, r.item_code, round(r.quantity_g, 6)) for r in cons.collect() if r.quantity_g is not None}
    for r in clean:
        if r.quantity_g is not None and (r.hhid, r.item_code, round(r.quantity_g, 6)) not in known:
            filled[r.item_code].add(round(r.quantity_g / afe[r.hhid], 6))
    assert filled
    for item, values in filled.items():
        assert values == {round(statistics.median(unit[item]), 6)}
