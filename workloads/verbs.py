"""Queries for the relational verbs and scalar rules, each over whole survey tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import missing
from larder.functions.columns import across, first_columns, others, recode
from larder.functions.reference import COMPOSITION_COLUMNS, requirement_table
from larder.operators import consumption, joins, quantiles
from larder.operators.cleaning import impute_group_median
from larder.operators.composition import fct_build
from larder.operators.consumption import NEW_MODULE, OLD_MODULE
from larder.operators.intake import apparent_intake, household_totals, nutrients_of, price
from larder.operators.quality import negative_rows, null_keys, repeated_keys
from larder.plans.chains import daily_consumption
from larder.sources import tables
from larder.sources.staging import new_path
from workloads.inputs import Tables, rounded
from workloads.oracle import NUTRIENTS, SHEET, each, rnd
from workloads.registry import query

RENAMED = ", ".join(f"{raw} AS {new}" for raw, new in NEW_MODULE.items())
RENAMED_OLD = ", ".join(f"{raw} AS {new}" for raw, new in OLD_MODULE.items())

#: The reports of both modules under working names.
BOTH = f"(SELECT 'new' AS module, {RENAMED} FROM in_raw_new UNION ALL BY NAME SELECT 'old' AS module, {RENAMED_OLD} FROM in_raw_old)"


def both(t: Tables):
    new = t.raw_new.withColumnsRenamed(NEW_MODULE).withColumn("module", F.lit("new"))
    return joins.union_by_name(new, t.raw_old.withColumnsRenamed(OLD_MODULE).withColumn("module", F.lit("old")))


# Sources and sinks


@query("SELECT y5_hhid, itemcode, hh_ja01, hh_ja02_1, hh_ja02_2, hh_ja09_2, NULL AS hh_j01, NULL AS hh_j02_2 FROM in_raw_new UNION ALL "
       "SELECT y5_hhid, itemcode, NULL, NULL, NULL, NULL, hh_j01, hh_j02_2 FROM in_raw_old")
def src_csv_na(t: Tables):
    key = {"y5_hhid": "string", "itemcode": "bigint"}
    new = key | {"hh_ja01": "int", "hh_ja02_1": "int", "hh_ja02_2": "double", "hh_ja09_2": "double"}
    back = []
    for raw, columns in ((t.raw_new, new), (t.raw_old, key | {"hh_j01": "int", "hh_j02_2": "double"})):
        path = new_path(t.spark, "csv")
        tables.write_csv_na(raw, path)
        back.append(tables.read_csv_na(t.spark, path, tables.schema_of(**columns)))
    return joins.union_by_name(*back)


@query(
    f"""SELECT h.res, count(*) AS n, {rnd('sum(c.quantity_g)', 1, 'quantity_g')}, {rnd('sum(f.energy_kcal)', 1, 'energy_kcal')}
    FROM st_cons c LEFT JOIN st_hh_info h ON c.hhid = h.hhid LEFT JOIN st_fct f ON c.item_code = f.item_code GROUP BY h.res"""
)
def load_survey(t: Tables):
    base = new_path(t.spark, "surveys")
    tables.save_survey(tables.Survey(t.hh_info, t.cons, t.fct), base, "survey1", "csv")
    survey = tables.load_survey(t.spark, base, "survey1", "csv")
    rows = joins.na_join(survey.food_consumption, survey.hh_info.select("hhid", "res"), "hhid", null_keys=False)
    rows = joins.na_join(rows, survey.fct, "item_code")
    sums = rows.groupBy("res").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity_g").alias("quantity_g"), F.sum("energy_kcal").alias("energy_kcal")
    )
    return rounded(sums, 1)


@query(
    f"""SELECT e.nutrient, ear_value, {rnd('mean_intake')} FROM (VALUES ('energy_kcal', 2100e0), ('vita_rae_mcg', 490e0),
    ('thia_mg', 0.9e0), ('ribo_mg', 1.3e0), ('niac_mg', 11e0), ('vitb6_mg', 1.3e0), ('folate_mcg', 250e0), ('vitb12_mcg', 2e0),
    ('fe_mg', 22.4e0), ('ca_mg', 860e0), ('zn_mg', 10.2e0)) e(nutrient, ear_value) LEFT JOIN (
    {each("SELECT '@' AS nutrient, avg(@) AS mean_intake FROM st_intake", sep=' UNION ALL ')}) i ON e.nutrient = i.nutrient"""
)
def ear_reference(t: Tables):
    means = apparent_intake(t.cons, t.fct, t.hh).agg(*[F.avg(n).alias(n) for n in NUTRIENTS])
    long = means.unpivot([], NUTRIENTS, "nutrient", "mean_intake")
    table = joins.na_join(requirement_table(t.spark), long, "nutrient")
    return rounded(table, ear_value=None)


@query(f"SELECT hhid, item_code, food_group, {rnd('quantity_g')}, {rnd('quantity_100g')} FROM st_cons")
def sink_roundtrip(t: Tables):
    path = new_path(t.spark, "csv")
    tables.write_csv_na(t.cons, path)
    return rounded(tables.read_csv_na(t.spark, path, tables.FOOD_CONSUMPTION_SCHEMA))


@query(
    f"""SELECT 'XXA' AS iso3, coalesce(res, 'Other') AS survey, count(*) AS n, {rnd('sum(quantity_g)', 1, 'quantity_g')}
    FROM st_cons c LEFT JOIN st_dates d ON c.hhid = d.hhid GROUP BY res"""
)
def sink_append_partitioned(t: Tables):
    path = new_path(t.spark, "appended")
    rows = joins.na_join(t.cons, joins.spread(t.residences), "hhid", null_keys=False)
    rows = rows.withColumns({"iso3": F.lit("XXA"), "survey": F.coalesce("res", F.lit("Other"))}).drop("res")
    known = F.col("survey") != "Other"
    tables.append_partitioned(rows.filter(known), path)
    tables.append_partitioned(rows.filter(~known), path)
    tables.append_partitioned(rows.filter(~known), path, replace=True)
    back = t.spark.read.schema(rows.schema).parquet(path)
    sums = back.groupBy("iso3", "survey").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity_g").alias("quantity_g"))
    return rounded(sums, 1)


# Projections


@query(f"SELECT hhid, item_code, consumed, unit, quantity FROM {BOTH}")
def proj_select(t: Tables):
    return both(t).select("hhid", "item_code", "consumed", "unit", "quantity")


@query("SELECT hhid, adm1, adm2, ea, survey_wgt FROM in_cover")
def proj_drop(t: Tables):
    return t.cover.drop("rural", "int_month_year")


@query("SELECT food_group, item_code FROM (SELECT * FROM in_groups_new UNION ALL SELECT * FROM in_groups_old)")
def proj_reorder(t: Tables):
    return first_columns(joins.union_by_name(t.groups_new, t.groups_old), "food_group")


@query(f"SELECT * FROM {BOTH}")
def proj_rename(t: Tables):
    return both(t)


@query("SELECT *, quantity / 7 AS per_day, quantity / 7 / 100 AS per_day_100, quantity / 700 > 1 AS large FROM "
       f"(SELECT hhid, item_code, consumed, unit, quantity FROM {BOTH})")
def proj_mutate(t: Tables):
    rows = both(t).select("hhid", "item_code", "consumed", "unit", "quantity").withColumn("per_day", F.col("quantity") / 7)
    return rows.withColumn("per_day_100", F.col("per_day") / 100).withColumn("large", F.col("quantity") / 700 > 1)


@query(f"SELECT item_code, item_name, {each('@ * 0.5e0 AS @')} FROM st_fct5")
def proj_across_scale(t: Tables):
    sheet = t.wave5_sheet
    return across(sheet, nutrients_of(sheet), lambda c: F.col(c) * 0.5)


@query(f"SELECT item_name, item_code, {', '.join(NUTRIENTS)} FROM st_fct4")
def proj_cast_all(t: Tables):
    return t.wave4_sheet


# Filters


@query(f"SELECT * FROM {BOTH} WHERE consumed = 1")
def filter_eq(t: Tables):
    return both(t).filter(F.col("consumed") == 1)


@query(f"SELECT * FROM {BOTH} WHERE unit <> 1")
def filter_ne(t: Tables):
    return both(t).filter(F.col("unit") != 1)


@query("SELECT hhid, indid, sex, age FROM in_roster WHERE age >= 2 AND age <= 53")
def filter_range(t: Tables):
    return t.roster.filter((F.col("age") >= 2) & (F.col("age") <= 53)).select("hhid", "indid", "sex", "age")


@query("SELECT hhid, indid, 'weight' AS missing FROM in_anthropometry WHERE weight IS NULL UNION ALL "
       "SELECT hhid, indid, 'none' AS missing FROM in_anthropometry WHERE weight IS NOT NULL")
def filter_null(t: Tables):
    absent = t.anthropometry.filter(F.col("weight").isNull()).select("hhid", "indid", F.lit("weight").alias("missing"))
    present = t.anthropometry.filter(F.col("weight").isNotNull()).select("hhid", "indid", F.lit("none").alias("missing"))
    return joins.union_by_name(absent, present)


@query("SELECT hhid, item_code, quantity_g, quantity_100g FROM st_daily WHERE quantity_g < 0 OR quantity_100g < 0")
def dq_negative_quantities(t: Tables):
    daily = daily_consumption(t.new_module, t.old_module)
    return negative_rows(daily, consumption.QUANTITIES).drop("itemname")


@query("""SELECT 'food groups' AS lookup, item_code, count(*) AS n FROM st_groups GROUP BY item_code HAVING count(*) > 1
    UNION ALL SELECT 'items' AS lookup, item_code, count(*) AS n FROM in_items GROUP BY item_code HAVING count(*) > 1
    UNION ALL SELECT 'null item' AS lookup, item_code, 1 AS n FROM in_items WHERE item_code IS NULL""")
def dq_lookup_keys(t: Tables):
    groups = consumption.food_group_recode(t.groups_new.union(t.groups_old).distinct())
    found = [
        repeated_keys(groups, ["item_code"]).withColumn("lookup", F.lit("food groups")),
        repeated_keys(t.items, ["item_code"]).withColumn("lookup", F.lit("items")),
        null_keys(t.items, ["item_code"]).select("item_code", F.lit(1).cast("bigint").alias("n"), F.lit("null item").alias("lookup")),
    ]
    return joins.union_by_name(*found)


# Joins


@query(f"""SELECT hhid, b.item_code, quantity, edible_portion FROM {BOTH} b LEFT JOIN st_edible e
    ON b.item_code IS NOT DISTINCT FROM e.item_code""")
def join_left(t: Tables):
    return joins.na_join(both(t).select("hhid", "item_code", "quantity"), t.edible, "item_code")


@query(f"""SELECT hhid, b.item_code, b.unit, quantity, conv_fac FROM {BOTH} b LEFT JOIN in_conv_new u
    ON b.item_code IS NOT DISTINCT FROM u.item_code AND b.unit IS NOT DISTINCT FROM u.unit""")
def join_left_composite(t: Tables):
    return joins.na_join(both(t).select("hhid", "item_code", "unit", "quantity"), t.conv_new, ["item_code", "unit"])


@query("""SELECT y5_hhid, itemcode, res FROM (SELECT y5_hhid, itemcode FROM in_raw_old UNION ALL SELECT y5_hhid, itemcode FROM in_raw_new)
    LEFT JOIN st_dates ON y5_hhid IS NOT DISTINCT FROM hhid""")
def join_left_renamed(t: Tables):
    rows = t.raw_old.select("y5_hhid", "itemcode").unionByName(t.raw_new.select("y5_hhid", "itemcode"))
    return joins.na_join(rows, t.residences, [("y5_hhid", "hhid")])


@query("SELECT p.hhid, p.indid, p.pregnant, e.age FROM in_pregnancies p JOIN st_eaters e ON p.hhid = e.hhid AND p.indid = e.indid")
def join_inner(t: Tables):
    eating = t.roster.filter(F.col("eat7d") == 1).select("hhid", "indid", "age")
    return joins.na_join(t.pregnancies, eating, ["hhid", "indid"], "inner")


@query("""SELECT k AS item, n, total FROM (SELECT nullif(item_code % 50, 7) AS k, count(*) AS n FROM st_cons GROUP BY 1) a LEFT JOIN
    (SELECT nullif(item_code % 40, 7) AS j, count(*) AS total FROM st_cons GROUP BY 1) b ON k IS NOT DISTINCT FROM j""")
def join_aggregates(t: Tables):
    """Two aggregates whose keys may be NULL."""
    a = t.cons.groupBy(F.expr("nullif(item_code % 50, 7)").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    b = t.cons.groupBy(F.expr("nullif(item_code % 40, 7)").alias("item")).agg(F.count(F.lit(1)).alias("total"))
    return joins.na_lookup(a, b, "item")


@query("SELECT item_id, item_desc FROM in_wave4 WHERE NOT EXISTS (SELECT 1 FROM in_wave5 WHERE itemcode = item_id)")
def join_anti(t: Tables):
    return joins.na_join(t.wave4.select("item_id", "item_desc"), t.wave5, [("item_id", "itemcode")], "left_anti")


# Aggregations


@query(f"SELECT hhid, {rnd('coalesce(sum(quantity_g), 0)', 2, 'quantity_g')} FROM st_daily GROUP BY hhid")
def agg_sum_zero(t: Tables):
    rows = daily_consumption(t.new_module, t.old_module)
    return rounded(rows.groupBy("hhid").agg(missing.sum_or_zero("quantity_g").alias("quantity_g")), 2)


@query("""SELECT hhid, count(*) FILTER (WHERE eat7d = 1) AS eaters, count(*) FILTER (WHERE age < 2) AS infants,
    count(*) FILTER (WHERE moid IS NOT NULL) AS with_mother FROM in_roster GROUP BY hhid""")
def agg_count_if(t: Tables):
    return t.roster.groupBy("hhid").agg(
        missing.count_where("eat7d = 1").alias("eaters"),
        missing.count_where("age < 2").alias("infants"),
        missing.count_where("moid IS NOT NULL").alias("with_mother"),
    )


@query(f"""SELECT sex, age, {rnd('avg(weight)', name='mean_weight')} FROM in_anthropometry a JOIN in_roster r
    ON a.hhid = r.hhid AND a.indid = r.indid GROUP BY sex, age""")
def agg_mean(t: Tables):
    rows = joins.na_join(t.anthropometry, t.roster.select("hhid", "indid", "sex", "age"), ["hhid", "indid"], "inner")
    return rounded(rows.groupBy("sex", "age").agg(F.avg("weight").alias("mean_weight")))


@query(f"SELECT item_code, {rnd('stddev_samp(quantity)', name='sd')} FROM {BOTH} GROUP BY item_code")
def agg_sd(t: Tables):
    return rounded(both(t).groupBy("item_code").agg(F.stddev_samp("quantity").alias("sd")))


@query(f"SELECT item_code, {rnd('median(quantity)', name='quantity')}, {rnd('median(weighed_quantity)', name='weighed_quantity')} "
       f"FROM {BOTH} GROUP BY item_code HAVING count(quantity) + count(weighed_quantity) > 0")
def agg_median(t: Tables):
    return rounded(quantiles.group_median(both(t), ["item_code"], ["quantity", "weighed_quantity"]))


@query("SELECT item_code, food_group, count(*) AS n FROM st_cons GROUP BY item_code, food_group")
def agg_count(t: Tables):
    return t.cons.groupBy("item_code", "food_group").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT hhid, {', '.join(rnd(f'coalesce(sum(c.quantity_100g * f.{n}), 0)', 2, n) for n in NUTRIENTS)} FROM st_cons c "
       "LEFT JOIN st_fct f ON c.item_code = f.item_code GROUP BY hhid")
def agg_across_sum(t: Tables):
    priced = price(t.cons, t.fct)
    kept = others(priced, ["hhid", "item_code", "food_group", "quantity_g", "quantity_100g"])
    return rounded(household_totals(priced, kept), 2)


@query("SELECT DISTINCT item_code, food_group FROM st_cons")
def agg_distinct(t: Tables):
    return t.cons.select("item_code", "food_group").distinct()


@query("SELECT 'all' AS scope, * FROM (SELECT q20, q40, q60, q80 FROM st_cuts)")
def weighted_quantile(t: Tables):
    cuts = quantiles.weighted_quantile(t.expenditure, "exp_pae", "hhweight")
    return first_columns(cuts.withColumn("scope", F.lit("all")), "scope")


@query("SELECT res, q20, q40, q60, q80 FROM st_cuts_by")
def weighted_quantile_by(t: Tables):
    spent = joins.na_join(t.expenditure, t.residences, "hhid", null_keys=False)
    return quantiles.weighted_quantile(spent, "exp_pae", "hhweight", by="res")


# Grouped values on rows, sorting, sets


@query(f"""SELECT hhid, item_code, {rnd('coalesce(quantity, median(quantity) OVER (PARTITION BY item_code))', name='quantity')}
    FROM {BOTH}""")
def window_group_median(t: Tables):
    rows = both(t).select("hhid", "item_code", "quantity")
    return rounded(impute_group_median(rows, "item_code", ["quantity"]))


@query(f"SELECT *, NULL AS quantity FROM (SELECT hhid, item_code, {rnd('quantity_g')} FROM st_resolved) UNION ALL SELECT hhid, "
       f"item_code, NULL, quantity FROM st_old")
def union_by_name(t: Tables):
    new = consumption.prepare_consumption(t.raw_new, t.items, t.edible, t.conv_new)
    grams = consumption.quantity_resolution(new, t.conv_new).select("hhid", "item_code", "quantity_g")
    old = consumption.prepare_consumption(t.raw_old, t.items, t.edible_old, t.conv_old, OLD_MODULE)
    return joins.union_by_name(rounded(grams), old.select("hhid", "item_code", "quantity"))


@query("SELECT * FROM in_groups_new UNION SELECT * FROM in_groups_old")
def union_distinct(t: Tables):
    return joins.union_by_name(t.groups_new, t.groups_old).distinct()


@query("SELECT * FROM st_fct")
def fct_override_union(t: Tables):
    return fct_build(t.wave5_sheet, t.wave4_sheet)


# Scalar rules


@query("""SELECT hhid, indid, CASE WHEN age < 2 THEN 'infant' WHEN age < 15 THEN 'child' WHEN sex = 2 AND moid IS NULL
    THEN 'woman' ELSE 'other' END AS stage, CASE sex WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' END AS sex_label FROM in_roster""")
def fn_case_when(t: Tables):
    stage_of = (
        F.when(F.col("age") < 2, "infant")
        .when(F.col("age") < 15, "child")
        .when((F.col("sex") == 2) & F.col("moid").isNull(), "woman")
        .otherwise("other")
    )
    return t.roster.select("hhid", "indid", stage_of.alias("stage"), recode("sex", {1: "Male", 2: "Female"}).alias("sex_label"))


@query("""SELECT hhid, indid, CASE WHEN weight IS NULL THEN NULL WHEN weight > 30 THEN 'heavy' ELSE 'light' END AS class
    FROM in_anthropometry""")
def fn_if_else_null(t: Tables):
    heavy = missing.if_else("weight > 30", "'heavy'", "'light'")
    return t.anthropometry.select("hhid", "indid", heavy.alias("class"))


@query("SELECT hhid, indid, weight IS NULL AS unweighed FROM in_anthropometry")
def fn_is_missing(t: Tables):
    return t.anthropometry.select("hhid", "indid", missing.is_missing("weight").alias("unweighed"))


@query("SELECT hhid, indid, coalesce(age_months, 12) AS age_months FROM in_child_ages")
def fn_coalesce(t: Tables):
    return t.child_ages.select("hhid", "indid", F.coalesce("age_months", F.lit(12.0)).alias("age_months"))


@query(f"""SELECT l_orderkey, l_partkey, {rnd("CASE WHEN l_discount - 0.05e0 = 0 THEN CAST('-Infinity' AS DOUBLE) WHEN l_discount > 0.05e0 "
                                 "THEN log10(l_discount - 0.05e0) END", 6, 'log_discount')} FROM lineitem""")
def fn_log10(t: Tables):
    rows = t.spark.read.schema("l_orderkey bigint, l_partkey bigint, l_discount double").parquet(f"{t.sf_dir}/lineitem.parquet")
    logs = rows.select("l_orderkey", "l_partkey", missing.log10_ieee("l_discount - 0.05D").alias("log_discount"))
    return rounded(logs, 6)


@query(f"""SELECT item_code, {rnd('energy_kcal * 0.25e0 / 7 + zn_mg - fe_mg', 6, 'mix')}, energy_kcal ** 2 AS square
    FROM st_fct5""")
def fn_arith(t: Tables):
    mix = F.col("energy_kcal") * 0.25 / 7 + F.col("zn_mg") - F.col("fe_mg")
    square = F.col("energy_kcal") * F.col("energy_kcal")
    return rounded(t.wave5_sheet.select("item_code", mix.alias("mix"), square.alias("square")), 6, square=None)


@query(f"""SELECT l_orderkey, l_partkey, {rnd("CASE WHEN l_tax = 0 THEN CASE WHEN l_discount > 0 THEN CAST('Infinity' AS DOUBLE) "
       "END ELSE l_discount / l_tax END", 6, 'ratio')} FROM lineitem""")
def fn_safe_div(t: Tables):
    rows = t.spark.read.schema("l_orderkey bigint, l_partkey bigint, l_discount double, l_tax double").parquet(
        f"{t.sf_dir}/lineitem.parquet"
    )
    return rounded(rows.select("l_orderkey", "l_partkey", missing.safe_div("l_discount", "l_tax").alias("ratio")), 6)


@query(f"SELECT hhid, item_code, round_even(coalesce(est_metric_quantity, quantity / 8), 1) AS tenths FROM {BOTH}")
def fn_round_even(t: Tables):
    rows = both(t).withColumn("x", F.expr("coalesce(est_metric_quantity, quantity / 8)"))
    return rows.select("hhid", "item_code", missing.round_half_even("x", 1).alias("tenths"))


@query(f"""SELECT itemname, {', '.join(f'TRY_CAST({raw} AS DOUBLE) AS {raw}' for raw in SHEET)} FROM in_wave5""")
def fn_try_cast(t: Tables):
    return t.wave5.select("itemname", *[missing.to_number(raw).alias(raw) for raw in COMPOSITION_COLUMNS])


@query("SELECT item_code, food_group FROM st_groups")
def food_group_recode(t: Tables):
    return consumption.food_group_recode(joins.union_by_name(t.groups_new, t.groups_old).distinct())
