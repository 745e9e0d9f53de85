"""Every household by every listed item, against plain loops."""

from __future__ import annotations

import itertools
from collections import Counter

import pytest

from larder.operators import grid, intake

HH = [("a", 2.0), ("b", 4.0), ("twice", 1.0), ("twice", 1.0), ("zero", 0.0), ("unknown", None), ("eats nothing", 1.0)]
# Item 2 is listed in two groups, item 4 comes twice in the composition table and item 5 is never eaten; one item has no code.
CONS = [
    ("a", 1, 4.0, "dairy", 400.0), ("a", 1, 2.0, "dairy", 200.0), ("a", 2, None, "eggs", None), ("b", 2, 8.0, "eggs", 800.0),
    ("b", 2, 4.0, "misc", 400.0), ("twice", 4, 3.0, "misc", 300.0), ("zero", 1, 1.0, "dairy", 100.0), ("unknown", 2, 3.0, "eggs", 300.0),
    ("b", None, 2.0, None, 200.0), ("stranger", 1, 5.0, "dairy", 500.0), ("a", 9, 5.0, "misc", 500.0),
]
FCT = [(1, "milk", 60.0, None), (2, "egg", 150.0, 1.75), (4, "salt", 0.0, 0.0), (4, "sea salt", 0.0, 1.0), (5, "never eaten", 10.0, 1.0), (None, "nameless", 3.0, 2.0)]


def tables(spark):
    hh = spark.createDataFrame(HH, "hhid string, afe double")
    cons = spark.createDataFrame(CONS, "hhid string, item_code long, quantity_100g double, food_group string, quantity_g double")
    fct = spark.createDataFrame(FCT, "item_code long, item_name string, energy_kcal double, fe_mg double")
    return hh, cons, fct


def divided(n, afe):
    if afe is None:
        return None
    if afe == 0:
        return float("inf") if n else None
    return n / afe


def times(c, q):
    return None if c is None or q is None or (q == float("inf") and c == 0) else c * q


def expected():
    eaten, listed = {}, {(i, g) for _, i, _, g, _ in CONS}
    for h, i, q, g, grams in CONS:
        before = eaten.setdefault((h, i), {}).get(g, (0.0, 0.0))
        eaten[h, i][g] = (before[0] + (q or 0.0), before[1] + (grams or 0.0))
    for (h, afe), (i, name, kcal, iron) in itertools.product(HH, FCT):
        for q, grams in eaten.get((h, i), {None: (0.0, 0.0)}).values():
            for group in [g for item, g in listed if item == i]:
                unit = divided(q, afe)
                yield h, afe, i, unit, divided(grams, afe), group, name, times(kcal, unit), times(iron, unit)


@pytest.mark.parametrize("tile", [(1, 1), (2, 3), (500, 5000)])
def test_the_full_list_has_every_household_by_every_listed_item(spark, monkeypatch, tile):
    monkeypatch.setattr(grid, "TILE_ITEMS", tile[0])
    monkeypatch.setattr(grid, "TILE_HOMES", tile[1])
    df = intake.full_item_list(*tables(spark))
    assert df.columns == ["hhid", "afe", "item_code", "quantity_100g", "quantity_g", "food_group", "item_name", "energy_kcal", "fe_mg"]
    assert Counter(map(tuple, df.collect())) == Counter(expected())
    assert {r.quantity_g for r in df.collect() if r.hhid == "eats nothing"} == {0.0}


def test_the_full_list_is_made_by_an_equal_join_of_tiles(spark):
    plan = intake.full_item_list(*tables(spark))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin [block" in plan
