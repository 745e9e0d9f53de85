"""Batches, raw tables, ordered tables, composition layers and the implied grid, on small hand-worked tables."""

from __future__ import annotations

import itertools
import re

import pytest
from pyspark.sql import functions as F

from larder.operators import adequacy
from larder.operators.grid import ImpliedGrid
from larder.operators.intake import ZoneOverride
from larder.operators.layers import CompositionLayers, Layer
from larder.sources import batches, raw, tables


# Batches


def two_tables(spark, n):
    return {"hh_information": spark.range(n).toDF("hhid"), "fct": spark.range(2 * n).toDF("item_code")}


def counts(spark, base):
    return {(r.batch, r.table): r.rows for r in batches.committed(spark, base).collect()}


def test_a_batch_is_seen_only_when_it_is_whole(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "db")
    assert counts(spark, base) == {}
    assert batches.append(base, "a", two_tables(spark, 3))

    class Stopped(RuntimeError):
        pass

    class Broken(dict):
        def items(self):
            for i, pair in enumerate(super().items()):
                if i == 1:
                    raise Stopped  # between two tables
                yield pair

    with pytest.raises(Stopped):
        batches.append(base, "b", Broken(two_tables(spark, 5)))
    assert counts(spark, base) == {("a", "hh_information"): 3, ("a", "fct"): 6}
    assert batches.read(spark, base, "hh_information").count() == 3
    assert batches.append(base, "b", two_tables(spark, 4))
    assert sorted(r.hhid for r in batches.read(spark, base, "hh_information").collect()) == sorted([*range(3), *range(4)])
    assert counts(spark, base)["b", "fct"] == 8


def test_a_finished_batch_is_not_appended_again(spark, tmp_path):
    base = str(tmp_path / "db")
    batches.append(base, "a", two_tables(spark, 3))
    assert not batches.append(base, "a", two_tables(spark, 7))
    assert batches.read(spark, base, "fct").count() == 6
    assert batches.append(base, "a", two_tables(spark, 7), replace=True)
    assert batches.read(spark, base, "fct").count() == 14 and batches.read(spark, base, "fct").columns == ["item_code", "batch"]


def test_bad_batches(spark, tmp_path):
    base = str(tmp_path / "db")
    for name in ("", "a/b", "12", "a b"):
        with pytest.raises(ValueError):
            batches.append(base, name, two_tables(spark, 1))
    with pytest.raises(ValueError):
        batches.append(base, "a", {})
    with pytest.raises(FileNotFoundError):
        batches.read(spark, base, "fct")


# Raw tables


def test_cells_that_do_not_parse_go_to_the_quarantine(spark, tmp_path):
    (tmp_path / "v.csv").write_text('extra,hh_v05,y5_hhid,indidy5\nx,61.5,h1,1\ny,NA,h1,2\nz,heavy,h2,1\n,"",h2,x2\n, 40 ,NA,3.0\n,NaN,h3,.\n')
    mapping = raw.raw_map("anthropometry")
    df = raw.read_text(spark, str(tmp_path / "v.csv"))
    stored = raw.store(df, mapping)
    assert [tuple(r) for r in stored.table.collect()] == [
        ("h1", 1, 61.5), ("h1", 2, None), ("h2", 1, None), ("h2", None, None), (None, 3, 40.0), ("h3", None, None),
    ]
    assert stored.bad_rows == 2
    assert {(r.row_key, r.column, r.raw_column, r.value) for r in stored.unparsed.collect()} == {
        ("h2/1", "weight", "hh_v05", "heavy"), ("h2/x2", "indid", "indidy5", "x2"),
    }
    with pytest.raises(ValueError, match="unparsed 2 of 6"):
        raw.store(df, mapping, limit=1)
    clean = raw.store(df.filter("indidy5 = '1' AND y5_hhid = 'h1'"), mapping, limit=0)
    assert clean.bad_rows == 0 and clean.unparsed.isEmpty() and clean.unparsed.columns == stored.unparsed.columns


def test_maps_know_their_columns(spark):
    with pytest.raises(ValueError, match="hh_v05"):
        raw.apply(spark.createDataFrame([("a", "1")], "y5_hhid string, indidy5 string"), raw.raw_map("anthropometry"))
    with pytest.raises(KeyError):
        raw.raw_map("anthropometry", "y4")
    assert raw.apply(spark.createDataFrame([], "y5_hhid string, indidy5 string, hh_v05 string"), raw.raw_map("anthropometry")).isEmpty()


# Order


def test_order_survives_equal_keys_and_small_files(spark, tmp_path):
    path = str(tmp_path / "ordered")
    rows = [(i % 3 if i % 5 else None, i % 7, float(i)) for i in range(2000)] + [(1, 1, 1.0)] * 900
    df = spark.createDataFrame(rows, "a int, b int, c double").repartition(9)
    tables.write_ordered(df, path, [F.asc_nulls_last("a"), F.desc("b")], rows_per_file=100)
    back = tables.read_ordered(spark, path).orderBy("row_order").collect()
    assert [r.row_order for r in back] == list(range(2900))
    assert [(r.a, r.b, r.c) for r in back] == sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, -r[1], r[2]))
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 100
    with pytest.raises(ValueError):
        tables.write_ordered(df.withColumn("__place", F.lit(1)), path, [F.asc("a")])


def test_an_empty_table_keeps_its_columns(spark, tmp_path):
    tables.write_ordered(spark.createDataFrame([], "a int"), str(tmp_path / "none"), [F.asc("a")])
    assert tables.read_ordered(spark, str(tmp_path / "none")).columns == ["a", "row_order"]


# Layers

ITEMS = "item_code int, item_name string, fe_mg double"


def test_the_most_specific_layer_wins(spark):
    zoned = spark.createDataFrame([(1, "z", "north", 100.0), (1, "z", None, 5.0)], "item_code int, item_name string, zone string, fe_mg double")
    own = spark.createDataFrame([(1, "o", 10.0), (2, "o", 20.0), (2, "o again", 21.0)], ITEMS)
    mine = spark.createDataFrame([(3, "n", 30.0, None), (3, "b", 31.0, "b")], ITEMS + ", survey_id string")
    any_ = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "a", 3.0), (4, "a", 4.0)], ITEMS)
    layers = CompositionLayers([Layer(any_), Layer(zoned, F.lit("a"), "zone"), Layer(mine, F.col("survey_id")), Layer(own, F.lit("a"))], ["fe_mg"])
    asked = [(s, z, i) for s in ("a", "b", None) for z in ("north", "south", None) for i in (1, 2, 3, 4, 5, None)]
    df = spark.createDataFrame(asked, "s string, z string, item_code int")
    got = {}
    for r in layers.resolve(df, F.col("s"), F.col("z")).collect():
        got.setdefault((r.s, r.z, r.item_code), []).append(r.amounts.fe_mg if r.amounts else None)
    for s, z, i in asked:
        if s == "a" and i == 1:
            want = [100.0] if z == "north" else [None]  # listed by zone, so no other layer counts
        elif s == "a" and i == 2:
            want = [20.0, 21.0]  # twice in its layer, twice in the result
        elif i == 3 and s != "a":
            want = [31.0] if s == "b" else [30.0]
        else:
            want = [{1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0}.get(i)]
        assert sorted(got[s, z, i], key=str) == want, (s, z, i)


def test_layered_intake_equals_resolving_every_row(spark):
    rows = [(s, f"h{h}", i, float(h + i) if (h + i) % 4 else None) for s, h, i in itertools.product(["a", "b", None], range(6), [1, 2, 3, 3, 9])]
    cons = spark.createDataFrame(rows, "survey_id string, hhid string, item_code int, quantity_100g double")
    homes = [(s, f"h{h}", [2.0, 0.0, None, 4.0, 1.0][h], ["north", "south", None, "west", "north"][h]) for s, h in itertools.product(["a", "b", None], range(5))]
    hh = spark.createDataFrame(homes, "survey_id string, hhid string, afe double, zone string")
    zoned = spark.createDataFrame([(1, "north", 7.0), (3, "south", 2.0), (3, "west", 5.0)], "item_code int, zone string, fe_mg double")
    fct = spark.createDataFrame([(1, "x", 1.5), (2, "x", 2.5), (3, "x", 0.5), (3, "x", 0.25)], ITEMS)
    layers = CompositionLayers([Layer(zoned, F.lit("a"), "zone"), Layer(fct)], ["fe_mg"])
    got = {(r.survey_id, r.hhid): r.fe_mg for r in layers.intake(cons, hh, ("survey_id", "hhid"), F.col("survey_id")).collect()}
    met = cons.join(hh.withColumnsRenamed({"survey_id": "s", "hhid": "h"}), F.col("survey_id").eqNullSafe(F.col("s")) & (F.col("hhid") == F.col("h")), "left")
    want = {}
    for r in layers.resolve(met, F.col("survey_id"), F.col("zone")).collect():
        total, afe = want.get((r.survey_id, r.hhid), (0.0, r.afe))
        amount = (r.amounts.fe_mg if r.amounts else None)
        want[r.survey_id, r.hhid] = (total + (amount * r.quantity_100g if amount is not None and r.quantity_100g is not None else 0.0), r.afe)
    assert got.keys() == want.keys()
    for key, (total, afe) in want.items():
        expected = None if afe is None or (afe == 0 and total == 0) else float("inf") if afe == 0 else total / afe
        assert got[key] == (pytest.approx(expected) if expected is not None else None), key


def test_null_surveys_stay_with_and_without_zones(spark):
    names = list(dict.fromkeys(adequacy.TARGET_NUTRIENTS))
    cons = spark.createDataFrame([("a", "h1", 1, 2.0), (None, "h2", 1, 3.0)], "survey_id string, hhid string, item_code int, quantity_100g double")
    hh = spark.createDataFrame([("a", "h1", 1.0), (None, "h2", 1.0)], "survey_id string, hhid string, afe double")
    fct = spark.createDataFrame([(1, "x", "a"), (1, "x", None)], "item_code int, item_name string, survey_id string")
    fct = fct.withColumns({n: F.when(F.col("survey_id") == "a", 1.0).otherwise(10.0) for n in names})
    zones = spark.createDataFrame([("h1", "north")], "hhid string, zone string")
    special = spark.createDataFrame([(1, "north")], "item_code int, zone string").withColumns({n: F.lit(100.0) for n in names})
    for zoned, first in ((None, 2.0), (("a", ZoneOverride(special, zones)), 200.0)):
        got = {(r.survey_id, r.hhid): r.fe_ai for r in adequacy.multi_survey_targets(cons, fct, hh, zoned).collect()}
        assert got == {("a", "h1"): first, (None, "h2"): 30.0}


def test_many_surveys_are_one_scan(spark, tmp_path):
    path = str(tmp_path / "cons")
    spark.createDataFrame([("a", "h", 1, 1.0)], "survey_id string, hhid string, item_code int, quantity_100g double").write.parquet(path)
    cons = spark.read.parquet(path)
    hh = spark.createDataFrame([("a", "h", 1.0, "n")], "survey_id string, hhid string, afe double, zone string")
    fct = spark.createDataFrame([(1, "x", 1.0)], ITEMS)
    zoned = fct.withColumn("zone", F.lit("n"))
    out = CompositionLayers([Layer(zoned, F.lit("a"), "zone"), Layer(fct)], ["fe_mg"]).intake(cons, hh, ("survey_id", "hhid"), F.col("survey_id"))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[survey_id", text)) == 1 and "Union" not in text and "partial_sum" in text


# The implied grid


@pytest.fixture(scope="module")
def small(spark):
    homes = [("a", 2.0, "n"), ("b", 4.0, "n"), ("c", 1.0, "s"), ("zero", 0.0, "s"), ("unknown", None, None), ("d'x", 8.0, None)]
    eaten = [("a", 1, "dairy", 4.0), ("a", 2, "it's other", 2.0), ("b", 1, "dairy", None), ("b", 1, "dairy", 8.0), ("zero", 2, "it's other", 1.0),
             ("unknown", 1, "eggs", 3.0), ("d'x", 2, "it's other", 16.0), ("a", 7, "dairy", 1.0)]
    hh = spark.createDataFrame(homes, "hhid string, afe double, zone string")
    cons = spark.createDataFrame(eaten, "hhid string, item_code int, food_group string, quantity_100g double").withColumn("quantity_g", F.col("quantity_100g") * 100)
    fct = spark.createDataFrame([(1, "one", 10.0), (2, "two", 1.0), (3, "never eaten", 5.0)], ITEMS)
    return homes, eaten, ImpliedGrid(hh, cons, fct)


def cells(homes, eaten, positive=True):
    """Every cell of the full grid with a value: (household, zone, item, listed group, quantity)."""
    pairs = sorted({(i, g) for _, i, g, _ in eaten if i in (1, 2)})
    for h, afe, zone in homes:
        if afe is None or (positive and not afe > 0):
            continue
        for item, group in pairs:
            recorded = {}
            for hh, i, g, q in eaten:
                if (hh, i) == (h, item):
                    recorded[g] = recorded.get(g, 0.0) + (q or 0.0)
            for q in recorded.values() or [0.0]:
                yield h, zone, item, group, q / afe if afe else float("inf") if q else 0.0


def test_grid_means_by_household_and_item_columns(small):
    homes, eaten, grid = small
    for by in (["zone"], []):
        want, households, n_cells = {}, {}, {}
        for h, zone, item, group, q in cells(homes, eaten):
            key = (zone, group) if by else group
            want[key] = want.get(key, 0.0) + q
            households.setdefault(key, set()).add(h)
        for r in grid.mean(["food_group"], by).collect():
            key = (r.zone, r.food_group) if by else r.food_group
            assert r.households == len(households.get(key, ()))
            assert r.quantity_100g == (pytest.approx(want[key] / len(households[key])) if key in want else None)
            n_cells[key] = r
        assert want.keys() <= n_cells.keys()


def test_grid_counts_and_cell_means(small):
    homes, eaten, grid = small
    want = {}
    for _, _, item, group, q in cells(homes, eaten):
        want.setdefault(group, []).append(q)
    for r in grid.mean(["food_group"], per="cell").collect():
        assert r.quantity_100g == pytest.approx(sum(want[r.food_group]) / len(want[r.food_group]))
    for r in grid.counts(["food_group"]).collect():
        assert r.households * r["items"] == len({(h, i) for h, _, i, g, _ in cells(homes, eaten) if g == r.food_group})
    everything = grid.mean().first()
    assert everything.households == 4 and everything.quantity_100g == pytest.approx(sum(map(sum, want.values())) / 4)


def test_grid_pivot_takes_any_label(small):
    homes, eaten, grid = small
    rows = {r.hhid: r for r in grid.pivot("food_group", ["dairy", "it's other", "no such"], "quantity_100g").collect()}
    assert len(rows) == len(homes)
    assert rows["d'x"]["it's other"] == 2.0 and rows["d'x"]["dairy"] == 0.0 and rows["c"]["no such"] == 0.0
    assert rows["unknown"]["no such"] is None or rows["unknown"]["no such"] == 0.0


def test_grid_sums_have_a_row_for_each_combination(small):
    homes, eaten, grid = small
    got = {(r.zone, r.food_group): r.quantity_100g for r in grid.sum(["food_group"], ["zone"]).collect()}
    assert got.keys() == set(itertools.product(["n", "s", None], ["dairy", "eggs", "it's other"]))
    assert got["n", "it's other"] == 1.0 and got["s", "dairy"] == 0.0


def test_the_grid_needs_one_household_exchange(small, spark):
    _, _, grid = small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = grid.rows()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning\(hhid", text)) == 1 and "Cartesian" not in text


# NULL keys


def test_lookups_match_null_keys_like_joins(spark):
    from larder.operators.joins import na_join, na_lookup

    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (None, "d"), (3, "e")], "k int, x string")
    for rows in ([(1, 10, "p"), (None, 20, "q"), (None, 30, None), (2, None, "r"), (2, 5, "s")], [(1, 10, "p")], []):
        right = spark.createDataFrame(rows, "k int, y int, z string")
        got, want = na_lookup(left, right, "k"), na_join(left, right, "k")
        assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    many = spark.createDataFrame([(None, i, "") for i in range(5)], "k int, y int, z string")
    with pytest.raises(Exception, match="over 3 rows without k"):
        na_lookup(left, many, "k", most=3).collect()
    with pytest.raises(ValueError):
        na_lookup(left, left, "k")


def test_two_aggregates_meet_with_two_exchanges(spark, tmp_path):
    from larder.operators.joins import na_join, na_lookup

    path = str(tmp_path / "t")
    spark.range(100).selectExpr("nullif(id % 7, 3) as k", "id as v").write.parquet(path)
    a = spark.read.parquet(path).groupBy("k").agg(F.sum("v").alias("a"))
    b = spark.read.parquet(path).groupBy("k").agg(F.max("v").alias("b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = {fn: fn(a, b, "k")._jdf.queryExecution().executedPlan().toString() for fn in (na_join, na_lookup)}
        assert na_lookup(a, b, "k").count() == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert texts[na_join].count("Exchange hashpartitioning") == 4
    # lines of the subquery, which reads the lookup's rows without a key, begin with a bar
    main = [line for line in texts[na_lookup].splitlines() if not line.startswith("      :")]
    assert sum("Exchange hashpartitioning(k" in line for line in main) == 2 == sum("Exchange" in line for line in main)
