"""Survey operators on small hand-worked households."""

from __future__ import annotations

import itertools
import math
from collections import defaultdict

import pytest
from larder.functions.reference import REQUIREMENTS
from larder.operators import adequacy, consumption, energy, explore, household, intake
from larder.operators.intake import ZoneOverride

ROSTER = "hhid string, indid int, sex int, age int, eat7d int, moid int"


def test_quantity_tiers(spark):
    conv = spark.createDataFrame([(1, 1, 1000.0), (1, 2, 1.0)], "item_code int, unit int, conv_fac double")
    schema = (
        "hhid string, item_code int, itemname string, unit int, quantity double, est_metric_unit int,"
        " est_metric_quantity double, weighed_unit int, weighed_quantity double, edible_portion double, conv_fac double"
    )
    rows = [
        ("reported", 1, "x", 1, 2.0, 2, 9.0, 2, 9.0, 0.5, 1000.0),
        ("weighed", 1, "x", 20, 2.0, 2, 9.0, 1, 3.0, 0.5, None),
        ("no factor", 1, "x", 3, 2.0, 2, 9.0, 2, 4.0, 0.5, None),
        ("estimated", 1, "x", 20, 2.0, 2, 9.0, 7, 3.0, 0.5, None),
        ("nothing", 1, "x", 20, 2.0, None, 9.0, None, None, 0.5, None),
        ("inedible", 1, "x", 1, 2.0, 2, 9.0, 2, 9.0, None, 1000.0),
    ]
    got = consumption.quantity_resolution(spark.createDataFrame(rows, schema), conv).collect()
    assert {r.hhid: r.quantity_g for r in got} == {
        "reported": 1000.0, "weighed": 1500.0, "no factor": 2.0, "estimated": 4.5, "nothing": None, "inedible": None,
    }
    assert {r.hhid: r.quantity_100g for r in got}["reported"] == 10.0


def test_incomplete_household_is_dropped_as_a_whole(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 1.0)], "hhid string, conv_fac double")
    assert [r.hhid for r in consumption.exclude_incomplete_groups(df).collect()] == ["b"]


def test_item_in_two_food_groups_fans_out(spark):
    cons = spark.createDataFrame([("a", 1, 2.0, 200.0), ("a", 9, 1.0, 100.0)], "hhid string, item_code int, quantity_100g double, quantity_g double")
    one = spark.createDataFrame([(1, "Dairy"), (2, "Eggs")], "item_code int, food_group string")
    two = spark.createDataFrame([(1, "Dairy"), (1, "Local label")], "item_code int, food_group string")
    got = consumption.attach_food_group(cons, [one, two])
    assert {(r.item_code, r.food_group) for r in got.collect()} == {(1, "dairy"), (1, "Local label"), (9, None)}
    assert got.columns == ["hhid", "item_code", "quantity_100g", "food_group", "quantity_g"]


def test_person_sets_and_equivalents(spark):
    roster = [
        ("h", 1, 2, 25, 1, None), ("h", 2, 1, 1, 1, 1), ("h", 3, 2, 0, 1, 1), ("h", 4, 2, 60, 1, None),
        ("h", 5, 1, 1, 1, 4), ("h", 6, 1, 1, 2, 1), ("h", 7, 1, 40, 1, None), ("h", 8, 1, 1, 1, 99), ("h", 9, 1, 18, 1, None),
    ]
    eating = energy.eaters(spark.createDataFrame(roster, ROSTER))
    ages = spark.createDataFrame([("h", 2, 6.0), ("h", 5, 2.5)], "hhid string, indid int, age_months double")
    infants = energy.under_two(eating, ages)
    assert {r.indid: r.age_months for r in infants.collect()} == {2: 6.0, 3: 0.0, 5: 2.5, 8: 12.0}
    mothers = energy.lactating(eating, infants)
    assert [tuple(r) for r in mothers.collect()] == [("h", 1, 2, 0, 2, 25)]
    pregnancies = spark.createDataFrame([("h", 1, 1), ("h", 4, 2), ("h", 77, 1)], "hhid string, indid int, pregnant int")
    expecting = energy.pregnant(eating, pregnancies)
    assert [r.indid for r in expecting.collect()] == [1]
    rest = energy.demographic_others(eating, infants, mothers, expecting)
    assert {r.indid for r in rest.collect()} == {4, 7, 9}
    assert {r.indid: r.afe for r in energy.afe_under_two(infants).collect()} == {
        2: 269 / 2291, 3: 0.0, 5: None, 8: 746 / 2291,
    }

    weights = [("h", 1, 99.0), ("h", 4, 99.0), ("h", 7, None), ("h", 9, 50.0), ("h", 6, 9.0), ("h", 2, 9.0)]
    tee = energy.tee_reference(spark.createDataFrame(weights, "hhid string, indid int, weight double"), eating)
    table = {(r.sex, r.age): r for r in tee.collect()}
    assert set(table) == {(2, 25), (2, 60), (1, 40), (1, 18)}
    young = (14.818 * 55 + 486.6) * 1.76
    assert table[2, 25].TEE == pytest.approx(young) and table[2, 25].PAL == 1.76
    assert table[1, 40].TEE == pytest.approx((11.472 * 65 + 873.1) * 1.76)
    assert table[2, 60].TEE == pytest.approx((9.082 * 55 + 658.5) * 1.76)
    boy = (1.298 + 0.265 * 65 - 0.0011 * 65**2) * 239.005736
    assert table[1, 18].TEE == pytest.approx(boy) and table[1, 18].PAL is None and table[1, 18].BMR is None

    lactation, pregnancy = (young + 2 * 505) / 2291, (young + 275) / 2291
    parts = [
        energy.afe_under_two(infants), energy.afe_lactating(mothers, tee), energy.afe_pregnant(expecting, tee),
        energy.afe_other(rest, tee),
    ]
    others = sum(table[k].TEE for k in [(2, 60), (1, 40), (1, 18)]) / 2291 + (269 + 746) / 2291
    assert energy.hh_afe(*parts).first().afe == pytest.approx(others + lactation + pregnancy)
    assert energy.hh_afe(*parts, dedupe="max").first().afe == pytest.approx(others + lactation)


def test_household_without_known_equivalents_sums_to_zero(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 1, 0.5)], "hhid string, indid int, afe double")
    assert {r.hhid: r.afe for r in energy.hh_afe(df).collect()} == {"a": 0.0, "b": 0.5}


def test_dates_residence_and_heads(spark):
    codes = spark.createDataFrame([(c,) for c in [*range(0, 17), None]], "int_month_year int")
    got = [(r.year, r.month) for r in household.interview_date(codes).collect()]
    assert got == [(None, None), (2020, 12), *[(2021, m) for m in range(1, 13)], (2022, 1), (None, None), (None, None), (None, None)]
    cover = spark.createDataFrame([(1,), (2,), (3,), (None,)], "rural int")
    assert [r.res for r in household.residence_recode(cover).collect()] == ["Rural", "Urban", None, None]
    roster = spark.createDataFrame(
        [("a", 1, 1, 40, 1), ("a", 2, 2, 39, 1), ("b", 1, 3, 50, 1), ("b", 2, 1, 9, 2)],
        "hhid string, indid int, sex int, age int, relationship int",
    )
    education = spark.createDataFrame([("a", 2, "primary")], "hhid string, indid int, educ string")
    assert {tuple(r) for r in household.household_head(roster, education).collect()} == {
        ("a", "Male", 40, None), ("a", "Female", 39, "primary"), ("b", None, 50, None),
    }


HH = [("a", 2.0), ("b", 4.0), ("zero", 0.0), ("unknown", None), ("eats nothing", 1.0)]
CONS = [
    ("a", 1, 4.0, "dairy", 400.0), ("a", 1, 2.0, "dairy", 200.0), ("a", 1, 4.0, "misc", 400.0), ("a", 2, None, "eggs", None),
    ("b", 2, 8.0, "eggs", 800.0), ("zero", 1, 1.0, "dairy", 100.0), ("unknown", 2, 3.0, "eggs", 300.0),
    ("stranger", 3, 5.0, "misc", 500.0), ("a", 9, 5.0, "misc", 500.0),
]
FCT = [(1, "milk", 60.0, None), (2, "egg", 150.0, 1.75), (3, "salt", 0.0, 0.0), (4, "never eaten", 10.0, 1.0)]


def survey_tables(spark):
    hh = spark.createDataFrame(HH, "hhid string, afe double")
    cons = spark.createDataFrame(CONS, "hhid string, item_code int, quantity_100g double, food_group string, quantity_g double")
    fct = spark.createDataFrame(FCT, "item_code int, item_name string, energy_kcal double, fe_mg double")
    return hh, cons, fct


def ieee_div(n, d):
    if n is None or d is None:
        return None
    if d == 0:
        return None if n == 0 else float("inf")
    return n / d


def full_grid():
    """Every household by every composition item, worked out by plain loops."""
    eaten = defaultdict(float)
    for hhid, item, q, group, _ in CONS:
        eaten[hhid, item, group] += q or 0.0
    listed = {(item, group) for _, item, _, group, _ in CONS}
    for (hhid, afe), (item, _, kcal, iron) in itertools.product(HH, FCT):
        recorded = [q for (h, i, _), q in eaten.items() if (h, i) == (hhid, item)]
        for q in recorded or [0.0]:
            for group in [g for i, g in listed if i == item]:
                amount = ieee_div(q, afe)
                energy_kcal = None if amount is None or (amount == float("inf") and kcal == 0) else amount * kcal
                yield hhid, afe, item, group, amount, energy_kcal, bool(recorded)


def test_item_rows_are_the_consumed_rows_of_the_full_grid(spark):
    hh, cons, fct = survey_tables(spark)
    got = [
        (r.hhid, r.item_code, r.food_group, r.quantity_100g, r.energy_kcal)
        for r in intake.consumed_items(hh, cons, fct).collect()
    ]
    grid = list(full_grid())
    assert sorted(got, key=str) == sorted(
        [(h, i, g, q, e) for h, _, i, g, q, e, recorded in grid if recorded], key=str
    )
    unrecorded = [(afe, q) for _, afe, _, _, q, _, recorded in grid if not recorded]
    assert unrecorded and all(q == (0.0 if afe else None) for afe, q in unrecorded)


def test_food_group_means_and_matrix_count_the_zeros(spark):
    hh, cons, fct = survey_tables(spark)
    totals = defaultdict(float)
    per_household = defaultdict(float)
    for h, afe, _, g, q, _, _ in full_grid():
        totals[g] += (q or 0.0) if afe is not None and afe > 0 else 0.0
        per_household[h, g] += q or 0.0
    assert all(math.isfinite(q) for q in totals.values())
    means = {r.food_group: r for r in intake.food_group_mean_intake(hh, cons, fct).collect()}
    assert set(means) == set(totals)
    for group, r in means.items():
        assert r.households == 3 and r.quantity_100g == pytest.approx(totals[group] / 3)
    matrix = intake.food_group_matrix(hh, cons, fct, ["dairy", "eggs"], "quantity_100g").collect()
    for r in matrix:
        known = r.afe is not None and r.afe > 0
        for group in ("dairy", "eggs"):
            if known:
                assert r[group] == pytest.approx(per_household[r.hhid, group])
    assert {r.hhid: r.dairy for r in matrix}["eats nothing"] == 0.0


def test_apparent_intake(spark):
    hh, cons, fct = survey_tables(spark)
    got = {r.hhid: (r.energy_kcal, r.fe_mg) for r in intake.apparent_intake(cons, fct, hh).collect()}
    assert got == {
        "a": (300.0, 0.0), "b": (300.0, 3.5), "zero": (float("inf"), None), "unknown": (None, None), "stranger": (None, None),
    }


def test_zone_override(spark):
    hh, cons, fct = survey_tables(spark)
    zoned = spark.createDataFrame(
        [(1, "north", 100.0, 1.0), (1, None, 7.0, 7.0)], "item_code int, zone string, energy_kcal double, fe_mg double"
    )
    zones = spark.createDataFrame([("a", "north"), ("zero", "south")], "hhid string, zone string")
    got = {r.hhid: (r.energy_kcal, r.fe_mg) for r in intake.apparent_intake(cons, fct, hh, ZoneOverride(zoned, zones)).collect()}
    assert got["a"] == (500.0, 5.0) and got["b"] == (300.0, 3.5) and got["zero"] == (None, None)


def test_nutrient_density(spark):
    _, cons, fct = survey_tables(spark)
    table = intake.nutrient_density(cons, fct)
    assert set(table.columns) == {"hhid", "energy_1000kcal", "fe_mg_1000kcal"}
    got = {r.hhid: (r.energy_1000kcal, r.fe_mg_1000kcal) for r in table.collect()}
    assert got["b"] == (1.2, pytest.approx(14.0 / 1.2)) and got["stranger"] == (0.0, None)


INTAKE = "hhid bigint, vita_rae_mcg double, folate_mcg double, vitb12_mcg double, fe_mg double, zn_mg double"


def test_adequacy(spark):
    df = spark.createDataFrame([(1, 245.0, 500.0, 2.0, 0.0, 5.1), (2, None, 1.0, 1.0, 1.0, 1.0)], INTAKE)
    got = {r.hhid: r for r in adequacy.adequacy_targets(df, "s").collect()}
    assert got["1"].mar_simple == pytest.approx((0.5 + 1 + 1 + 0 + 0.5) / 5) and got["1"].va_ref == 490.0
    assert got["2"].mar_simple is None and got["2"].survey_id == "s"
    mar = {r.hhid: r.overall_mar for r in adequacy.mar_export(df, "XXA", "s").collect()}
    assert mar == {1: pytest.approx(0.6), 2: None}


def test_requirements_without_a_composition_column(spark):
    fct = spark.createDataFrame([(1, "x", 1.0, 1.0)], "item_code int, item_name string, fe_mg double, other double")
    assert adequacy.requirement_nutrients(fct) == ["fe_mg"] and "ca_mg" in REQUIREMENTS


def test_top_items_break_ties_by_code_and_tables_round_half_even(spark):
    rows = [(2, 0.25), (2, 0.25), (1, 0.35), (1, 0.35), (3, 9.0), (4, 1.0), (4, 2.0), (4, None)]
    cons = spark.createDataFrame(rows, "item_code int, quantity_g double")
    items = spark.createDataFrame([(1, "one"), (2, "two"), (4, "four")], "item_code int, itemname string")
    table = explore.item_distribution(cons, items, k=3)
    got = {r.item_code: (r.itemname, r.mean_intake, r.sd_intake, r.median_intake, r.n) for r in table.collect()}
    assert got == {4: ("four", 1.5, 0.7, 1.5, 3), 1: ("one", 0.4, 0.0, 0.4, 2), 2: ("two", 0.2, 0.0, 0.2, 2)}
    shown = explore.presentation_table(table)
    assert [r["Food Item"] for r in shown.collect()] == ["four", "one", "two"]


def test_histogram_bins(spark):
    rows = [(1, float(i)) for i in range(30)] + [(2, 5.0), (2, 5.0), (3, None), (1, float("inf")), (1, None)]
    got = explore.intake_histogram(spark.createDataFrame(rows, "item_code int, quantity_g double")).collect()
    one = sorted((r for r in got if r.item_code == 1), key=lambda r: r.bin)
    assert [r.n for r in one] == [1] * 30
    assert one[0].bin_from == -0.5 and one[-1].bin_to == pytest.approx(29.5)
    two = [r for r in got if r.item_code == 2]
    assert len(two) == 1 and two[0].n == 2 and two[0].bin_to - two[0].bin_from == pytest.approx(0.1)
    assert two[0].bin_from <= 5.0 <= two[0].bin_to + 1e-9
    assert {r.item_code for r in got} == {1, 2}
    edge = spark.createDataFrame([(1, 0.0), (1, 0.5), (1, 29.0)], "item_code int, quantity_g double")
    filled = {r.bin: r.n for r in explore.intake_histogram(edge).collect() if r.n}
    assert filled == {0: 2, 29: 1}
