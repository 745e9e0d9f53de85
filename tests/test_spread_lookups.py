"""Lookups with as many rows as the catalogue are dealt over the tasks; no task holds one whole."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from larder.operators import consumption
from larder.operators.joins import MOST_BROADCAST, na_entries, na_join, spread
from workloads import verbs


def test_looks_give_the_rows_of_successive_joins(spark):
    left = spark.createDataFrame(
        [(1, 1, 2), (1, None, 9), (2, 1, 1), (None, 1, None), (None, None, 1), (3, 1, 1)], "item long, unit int, other int"
    )
    right = spark.createDataFrame(
        [(1, 1, 10.0), (1, 1, 11.0), (1, 2, 12.0), (1, None, 13.0), (2, 1, None), (None, 1, 14.0), (None, None, 15.0), (None, 1, 14.0)],
        "item long, unit int, fac double",
    )
    got = na_entries(left, right, "item", ("unit", "unit", {"fac": "a"}), ("other", "unit", {"fac": "b"}))
    want = na_join(left, right.select("item", "unit", F.col("fac").alias("a")), ["item", "unit"])
    want = na_join(want, right.select("item", F.col("unit").alias("other"), F.col("fac").alias("b")), ["item", "other"])
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_large_lookups_are_not_broadcast(spark):
    few, many = (spark.range(n).select(F.col("id").alias("item_code"), F.lit("x").alias("itemname")) for n in (50, MOST_BROADCAST + 1))
    raw = spark.createDataFrame(
        [("h", 7, 1, 1, 2.0, None, None, None, None)],
        ", ".join(f"{c} {'string' if c == 'y5_hhid' else 'double' if c.endswith('_2') else 'int'}" for c in consumption.NEW_MODULE),
    )
    for items, joins in ((few, "BroadcastHashJoin"), (many, "ShuffledHashJoin")):
        edible = items.select("item_code", F.lit(0.5).alias("edible_portion"))
        conv = items.select("item_code", F.lit(1).alias("unit"), F.lit(1000.0).alias("conv_fac"))
        rows = consumption.quantity_resolution(consumption.prepare_consumption(raw, items, edible, conv), conv)
        rows = consumption.attach_food_group(rows, [items.select("item_code", F.lit("Misc").alias("food_group"))])
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert {k: plan.count(f"{k} [") for k in ("BroadcastHashJoin", "ShuffledHashJoin")} == {
            k: 5 * (k == joins) for k in ("BroadcastHashJoin", "ShuffledHashJoin")
        }
        assert [tuple(r) for r in rows.collect()] == [("h", 7, 10.0, "misc", 1000.0)]
    assert spread(few) is few


def test_many_households_are_not_broadcast_to_the_sink(spark, monkeypatch):
    cons = spark.range(20).select(
        F.col("id").cast("string").alias("hhid"), F.lit(7).cast("long").alias("item_code"), F.lit(0.1).alias("quantity_100g"),
        F.lit("misc").alias("food_group"), F.lit(10.0).alias("quantity_g"),
    )
    append, plans = verbs.tables.append_partitioned, []

    def noted(df, path, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        append(df, path, **options)

    monkeypatch.setattr(verbs.tables, "append_partitioned", noted)
    for n, join in ((50, "BroadcastHashJoin"), (MOST_BROADCAST + 1, "ShuffledHashJoin")):
        homes = spark.range(n).select(F.col("id").cast("string").alias("hhid"), F.lit("Rural").alias("res"))
        rows = verbs.sink_append_partitioned(SimpleNamespace(spark=spark, cons=cons, residences=homes)).collect()
        assert [tuple(r) for r in rows] == [("XXA", "Rural", 20, 200.0)]
        assert len(plans) == 3 and all(f"{join} [" in plan for plan in plans)
        plans.clear()
