"""Missing-value, floating-point, join and source rules on small hand-worked tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from larder.functions import columns, missing
from larder.operators import cleaning, quality
from larder.operators.joins import na_join, override_union, union_by_name, without_keys
from larder.sources import staging, tables

INF, NAN = float("inf"), float("nan")


def test_null_keys_match_each_other(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, r string")
    assert {(r.l, r.r) for r in na_join(left, right, "k").collect()} == {("a", "x"), ("b", "y"), ("c", None)}
    assert {r.l for r in na_join(left, right, "k", "inner").collect()} == {"a", "b"}
    assert [r.l for r in na_join(left, right, "k", "left_anti").collect()] == ["c"]
    plain = na_join(left, right, "k", null_keys=False).collect()
    assert {(r.l, r.r) for r in plain} == {("a", "x"), ("b", None), ("c", None)}


def test_composite_keys_match_null_by_null(spark):
    left = spark.createDataFrame([(1, None, "a"), (1, 2, "b")], "i int, u int, l string")
    right = spark.createDataFrame([(1, None, 10.0), (1, 2, 20.0)], "item int, unit int, f double")
    rows = na_join(left, right, [("i", "item"), ("u", "unit")]).collect()
    assert {(r.l, r.f) for r in rows} == {("a", 10.0), ("b", 20.0)}


def test_repeated_lookup_keys_multiply_rows_and_are_reported(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, r string")
    assert na_join(left, right, "k").count() == 2
    assert [(r.k, r.n) for r in quality.repeated_keys(right, ["k"]).collect()] == [(1, 2)]
    assert [r.r for r in quality.null_keys(right, ["k"]).collect()] == ["z"]


def test_equal_column_names_are_refused(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="both sides"):
        na_join(a, a, "k")


def test_set_operations(spark):
    a = spark.createDataFrame([(1, "new"), (None, "new")], "k int, v string")
    b = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "k int, v string")
    assert {(r.k, r.v) for r in override_union(a, b, "k").collect()} == {(1, "new"), (None, "new"), (2, "old")}
    assert [r.k for r in without_keys(b, [a.filter("k = 1"), a.filter("k IS NULL")], ["k"]).collect()] == [2]
    wide = union_by_name(a, b.select("k"), b.select("v"))
    assert wide.columns == ["k", "v"] and wide.filter("v IS NULL").count() == 3


def test_conditionals_differ_on_null(spark):
    df = spark.createDataFrame([(1,), (20,), (None,)], "x int")
    got = df.select(
        missing.if_else("x > 10", "'big'", "'small'").alias("strict"),
        F.when(F.col("x") > 10, "big").otherwise("small").alias("loose"),
        columns.recode("x", {1: "one"}).alias("recoded"),
    ).collect()
    assert [tuple(r) for r in got] == [("small", "small", "one"), ("big", "big", None), (None, "small", None)]


def test_three_valued_logic_in_conditions(spark):
    df = spark.createDataFrame([(20, None), (3, None)], "age int, sex int")
    got = [r[0] for r in df.select(missing.if_else("age >= 15 AND sex = 1", "65.0D", "1.0D")).collect()]
    assert got == [None, 1.0]


def test_aggregates_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("b", 4.0)], "k string, x double")
    stats = {
        r.k: tuple(r)[1:]
        for r in df.groupBy("k")
        .agg(missing.sum_or_zero("x"), F.avg("x"), F.stddev_samp("x"), missing.count_where("x > 1"))
        .collect()
    }
    assert stats == {"a": (0.0, None, None, 0), "b": (4.0, 4.0, None, 1)}


def test_division_logarithm_and_products(spark):
    rows = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 0.0), (1.0, None), (INF, INF)]
    df = spark.createDataFrame(rows, "n double, d double")
    assert [r[0] for r in df.select(missing.safe_div("n", "d")).collect()] == [INF, -INF, None, 2.0, None, None, None]
    logs = spark.createDataFrame([(100.0,), (0.0,), (-5.0,), (None,)], "x double")
    assert [r[0] for r in logs.select(missing.log10_ieee("x")).collect()] == [2.0, -INF, None, None]
    odd = spark.createDataFrame([(INF, 0.0), (2.0, 3.0), (NAN, 1.0), (INF, 2.0)], "a double, b double")
    assert [r[0] for r in odd.select(missing.times("a", "b")).collect()] == [None, 6.0, None, INF]
    assert [r[0] for r in odd.select(missing.nan_to_null("a")).collect()] == [INF, 2.0, None, INF]
    assert [r[0] for r in odd.select(missing.is_missing("a")).collect()] == [False, False, True, False]


def test_rounding_and_numbers_from_text(spark):
    df = spark.createDataFrame([(0.25, "1.5"), (0.35, "n/a"), (-0.25, "NaN"), (None, None)], "x double, s string")
    assert [r[0] for r in df.select(missing.round_half_even("x")).collect()] == [0.2, 0.4, -0.2, None]
    assert [r[0] for r in df.select(missing.to_number("s")).collect()] == [1.5, None, None, None]


def test_column_lists(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "id int, a double, B_x double, c_X double")
    assert columns.others(df, ["id"]) == ["a", "B_x", "c_X"]
    assert columns.ending_with(df, "_X") == ["B_x", "c_X"]
    assert columns.column_range(df, "a", "B_x") == ["a", "B_x"]
    assert columns.first_columns(df, "c_X").columns == ["c_X", "id", "a", "B_x"]
    twice = columns.across(df, ["a", "B_x"], lambda c: F.col(c) * 2, "{col}_2")
    assert twice.columns[-2:] == ["a_2", "B_x_2"] and twice.first()["B_x_2"] == 6.0


def test_csv_na_rules(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('extra,name,x,n\n9,NA,1.5,3\n9,,NA,x\n9,"",NaN,4\n9,Bean,oops,NA\n')
    schema = tables.schema_of(n="int", x="double", name="string")
    got = {tuple(r) for r in tables.read_csv_na(spark, str(path), schema).collect()}
    assert got == {(3, 1.5, None), (None, None, None), (4, None, None), (None, None, "Bean")}
    out = str(tmp_path / "out")
    tables.write_csv_na(spark.createDataFrame([("a", None)], "s string, x double"), out)
    lines = {line for p in (tmp_path / "out").glob("*.csv") for line in p.read_text().splitlines()}
    assert lines == {"s,x", "a,NA"}


def test_partitioned_append_and_safe_rerun(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [("XXA", "one", 1.0), ("XXA", "two", 2.0)]
    df = spark.createDataFrame(rows, "iso3 string, survey string, x double")
    tables.append_partitioned(df, path)
    tables.append_partitioned(df.filter("survey = 'two'"), path, replace=True)
    assert spark.read.parquet(path).count() == 2
    tables.append_partitioned(df.filter("survey = 'two'"), path)
    back = spark.read.parquet(path)
    assert back.count() == 3
    assert "PartitionFilters: [isnotnull(survey" in back.filter("survey = 'one'")._jdf.queryExecution().toString()


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = staging.stage(spark.range(5).toDF("x"), "numbers")
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]
    assert staged.count() == 5


def test_rescaling_there_and_back_is_the_identity_where_defined(spark):
    rows = [(7.0, 3.5), (0.3, 0.7), (5.0, 0.0), (0.0, 0.0), (4.0, None)]
    df = spark.createDataFrame(rows, "q double, afe double")
    there = cleaning.rescale(df, "afe", ["q"], to_unit=True)
    assert [r.q for r in there.collect()][2:] == [INF, None, None]
    back = [r.q for r in cleaning.rescale(there, "afe", ["q"], to_unit=False).collect()]
    assert back[:2] == pytest.approx([7.0, 0.3]) and back[2:] == [None, None, None]


def test_outliers_go_above_only_and_need_a_cut_point(spark):
    rows = [("a", 10.0 + i / 100) for i in range(40)] + [("a", 1e6), ("a", 1e-6), ("single", 1e9)]
    rows += [("zero", v) for v in [0.0] + [1.0] * 30 + [1e9]] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, q double")
    kept = cleaning.outlier_log_sd(df, "k", "q")
    assert kept.count() == len(rows)
    a = [r.q for r in kept.filter("k = 'a'").collect()]
    assert 1e6 not in a and 1e-6 in a and a.count(None) == 2
    assert kept.filter("k = 'single'").first().q == 1e9
    assert kept.filter("k = 'zero' AND q = 1e9").count() == 1


def test_imputation_follows_the_blanking_order(spark):
    rows = [("a", 1.0, 5.0), ("a", 3.0, 7.0), ("a", None, 99.0), ("a", 2.0, None), ("none", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, g double, h double")
    blank = cleaning.blank_where_missing(df, "h", where="g")
    got = sorted(cleaning.impute_group_median(blank, "k", ["g", "h"]).collect(), key=str)
    assert [tuple(r) for r in got] == [
        ("a", 1.0, 5.0), ("a", 2.0, 6.0), ("a", 2.0, 6.0), ("a", 3.0, 7.0), ("none", None, None),
    ]


def test_negative_rows(spark):
    df = spark.createDataFrame([(1.0, 1.0), (-1.0, 1.0), (1.0, -1.0), (None, 1.0)], "a double, b double")
    assert quality.negative_rows(df, ["a", "b"]).count() == 2


def test_staged_tables_can_be_dropped(spark, tmp_path):
    staged = staging.stage(spark.range(3).toDF("x"), "gone")
    path = staged.inputFiles()[0].removeprefix("file://")
    assert staging.drop_staged(spark)
    with pytest.raises(FileNotFoundError):
        open(path)


def test_integers_written_as_numbers_are_read(spark, tmp_path):
    (tmp_path / "t.csv").write_text("item_code,quantity\n3.0,1\n1e5,2\n3.5,3\nNA,4\n7,NaN\n")
    got = tables.read_csv_na(spark, str(tmp_path), tables.schema_of(item_code="bigint", quantity="double")).collect()
    assert [tuple(r) for r in got] == [(3, 1.0), (100000, 2.0), (None, 3.0), (None, 4.0), (7, None)]


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("item_code,quantity\n1,20\n")
    (tmp_path / "b.csv").write_text("quantity,item_code\n20,1\n")
    with pytest.raises(Exception, match="header"):
        tables.read_csv_na(spark, str(tmp_path), tables.schema_of(item_code="bigint", quantity="double")).collect()


def test_nan_is_missing_wherever_it_comes_from(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, float("nan"))], "hhid string, item_code long, quantity_100g double")
    df.selectExpr("*", "'x' AS food_group", "quantity_100g AS quantity_g").write.parquet(str(tmp_path / "t"))
    row = tables.read_table(spark, str(tmp_path / "t"), tables.FOOD_CONSUMPTION_SCHEMA).first()
    assert row.quantity_g is None and row.quantity_100g is None
    from larder.functions.missing import log10_ieee
    from larder.operators import cleaning, household

    assert df.select(log10_ieee("quantity_100g")).first()[0] is None
    cuts = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "q20 double, q40 double, q60 double, q80 double")
    assert household.assign_quintile(df, "quantity_100g", cuts, "fifth").first().fifth is None
    rows = [(1, 10.0 + i % 3) for i in range(40)] + [(1, 1e9), (1, float("nan"))]
    kept = cleaning.outlier_log_sd(spark.createDataFrame(rows, "item_code long, q double"), "item_code", "q").collect()
    assert 1e9 not in [r.q for r in kept]


def test_adult_energy_changes_at_sixty(spark):
    from larder.operators import energy

    rows = spark.createDataFrame([(1, a, 65.0, 1.0, None) for a in (30.0, 59.5, 60.0)], "sex int, age double, meanw double, PAL double, TEE double")
    got = {r.age: r.BMR for r in energy.adult_tee(rows).collect()}
    assert got == pytest.approx({30.0: 1670.905, 59.5: 1618.78, 60.0: 1348.915})


def test_a_single_histogram_bin(spark):
    from larder.operators import explore

    df = spark.createDataFrame([(1, float(v)) for v in (1, 2, 5)], "item_code long, quantity_g double")
    assert [tuple(r) for r in explore.intake_histogram(df, bins=1).collect()] == [(1, 0, 1.0, 5.0, 3)]
