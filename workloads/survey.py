"""Queries for the survey operators, each over whole survey tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import adequacy, cleaning, consumption, energy, explore, export, household, intake
from larder.operators.consumption import OLD_MODULE, QUANTITIES
from larder.operators.intake import ZoneOverride
from larder.operators.joins import na_join, union_by_name
from larder.operators.quantiles import weighted_quantile
from larder.plans import chains
from larder.sources.staging import stage
from workloads.inputs import Tables, rounded
from workloads.oracle import NUTRIENTS, TARGETS, div, each, intake as intake_sql, rnd, rounded_nutrients
from workloads.registry import query

ISO3, SURVEY = "XXA", "survey1"
TAG = f"'{ISO3}' AS iso3, '{SURVEY}' AS survey"
GRAMS = f"{rnd('quantity_g')}, {rnd('quantity_100g')}"


# Consumption


def new_rows(t: Tables) -> DataFrame:
    return consumption.prepare_consumption(t.raw_new, t.items, t.edible, t.conv_new)


def old_rows(t: Tables) -> DataFrame:
    return consumption.prepare_consumption(t.raw_old, t.items, t.edible_old, t.conv_old, OLD_MODULE)


@query("SELECT * FROM st_new")
def consumption_new(t: Tables):
    return new_rows(t)


@query("SELECT * FROM st_old")
def consumption_old(t: Tables):
    return old_rows(t)


@query(f"SELECT hhid, item_code, itemname, {GRAMS} FROM st_resolved")
def quantity_resolution(t: Tables):
    return rounded(consumption.quantity_resolution(new_rows(t), t.conv_new))


@query("SELECT * FROM st_old_kept")
def exclude_incomplete_households(t: Tables):
    return consumption.exclude_incomplete_groups(old_rows(t))


@query(f"SELECT hhid, item_code, itemname, {GRAMS} FROM (SELECT hhid, item_code, itemname, quantity * conv_fac * edible_portion "
       "AS quantity_g, quantity * conv_fac * edible_portion / 100 AS quantity_100g FROM st_old)")
def quantity_old(t: Tables):
    return rounded(consumption.quantity_old(old_rows(t)))


@query(f"SELECT hhid, item_code, itemname, {GRAMS} FROM st_daily")
def consumption_per_day(t: Tables):
    return rounded(chains.daily_consumption(t.new_module, t.old_module))


@query(f"SELECT hhid, item_code, food_group, {GRAMS} FROM st_cons")
def food_group_attach(t: Tables):
    return rounded(chains.food_consumption(t.new_module, t.old_module))


# Energy


@query("SELECT * FROM st_infants")
def under_two(t: Tables):
    return t.person_sets.under_two


@query("SELECT * FROM st_lactating")
def lactating(t: Tables):
    return t.person_sets.lactating


@query("SELECT * FROM st_pregnant")
def pregnant(t: Tables):
    return t.person_sets.pregnant


def others(t: Tables) -> DataFrame:
    eating, *sets = t.person_sets
    return energy.demographic_others(eating, *sets)


@query("SELECT * FROM st_others")
def demographic_others(t: Tables):
    return others(t)


@query(f"SELECT hhid, indid, {rnd('afe', 6)} FROM st_afe_infants")
def afe_under_two(t: Tables):
    return rounded(energy.afe_under_two(t.person_sets.under_two), 6)


def weights(t: Tables) -> DataFrame:
    return energy.mean_weights(t.anthropometry, energy.eaters(t.roster))


@query(f"SELECT sex, age, {rnd('meanw')}, PAL FROM st_weights")
def tee_mean_weight(t: Tables):
    return rounded(weights(t), PAL=None)


@query(f"SELECT sex, age, {rnd('TEE')} FROM st_child")
def tee_child(t: Tables):
    return rounded(energy.child_tee(weights(t)).select("sex", "age", "TEE"))


@query(f"SELECT sex, age, {rnd('TEE')}, {rnd('BMR')} FROM st_tee")
def tee_adult(t: Tables):
    return rounded(energy.tee_reference(t.anthropometry, energy.eaters(t.roster)).select("sex", "age", "TEE", "BMR"))


def tee(t: Tables) -> DataFrame:
    return stage(energy.tee_reference(t.anthropometry, t.person_sets.eaters), "energy")


@query(f"SELECT hhid, indid, {rnd('afe', 6)} FROM st_afe_lactating")
def afe_lactating(t: Tables):
    return rounded(energy.afe_lactating(t.person_sets.lactating, tee(t)), 6)


@query(f"SELECT hhid, indid, {rnd('afe', 6)} FROM st_afe_pregnant")
def afe_pregnant(t: Tables):
    return rounded(energy.afe_pregnant(t.person_sets.pregnant, tee(t)), 6)


@query(f"SELECT hhid, indid, {rnd('afe', 6)} FROM st_afe_others")
def afe_other(t: Tables):
    return rounded(energy.afe_other(others(t), tee(t)), 6)


@query(f"SELECT hhid, {rnd('afe', 6)} FROM st_afe")
def hh_afe(t: Tables):
    return rounded(t.afe, 6)


@query(f"""SELECT hhid, {rnd('sum(afe)', 6, 'afe')} FROM (SELECT hhid, indid, max(afe) AS afe FROM (SELECT * FROM st_afe_infants
    UNION ALL SELECT * FROM st_afe_lactating UNION ALL SELECT * FROM st_afe_pregnant UNION ALL SELECT * FROM st_afe_others)
    GROUP BY hhid, indid) GROUP BY hhid""")
def hh_afe_deduped(t: Tables):
    return rounded(chains.store_afe(t.homes, dedupe="max"), 6)


# Households


@query("SELECT hhid, adm1, adm2, ea, rural, survey_wgt, year, month FROM st_dates")
def interview_date(t: Tables):
    return household.interview_date(t.cover)


@query("SELECT hhid, adm1, adm2, ea, int_month_year, survey_wgt, res FROM st_dates")
def residence_recode(t: Tables):
    return household.residence_recode(t.cover)


@query("SELECT * FROM st_heads")
def household_head(t: Tables):
    return household.household_head(t.roster, t.education)


@query("SELECT hhid, exp_pae, sep_quintile FROM st_quintiles")
def sep_quintile(t: Tables):
    spent = stage(t.expenditure, "expenditure")
    cuts = weighted_quantile(spent, "exp_pae", "hhweight")
    return household.assign_quintile(spent, "exp_pae", cuts, "sep_quintile").drop("hhweight")


@query("SELECT hhid, res, exp_pae, res_quintile FROM st_quintiles")
def res_quintile(t: Tables):
    spent = stage(na_join(t.expenditure, t.residences, "hhid", null_keys=False), "expenditure")
    cuts = stage(weighted_quantile(spent, "exp_pae", "hhweight", by="res"), "cuts")
    return household.assign_quintile(spent, "exp_pae", cuts, "res_quintile", by="res").drop("hhweight")


@query(f"SELECT * REPLACE ({rnd('afe', 6)}) FROM st_hh_info")
def hh_info(t: Tables):
    return rounded(t.hh_info, 6, survey_wgt=None)


# Intake


@query(f"SELECT hhid, {rounded_nutrients()} FROM st_intake")
def apparent_intake(t: Tables):
    return rounded(intake.apparent_intake(t.cons, t.fct, t.hh))


@query(f"SELECT hhid, {rounded_nutrients()} FROM st_zonal")
def apparent_intake_zonal(t: Tables):
    zones = t.hh.select("hhid", F.col("adm1").alias("zone"))
    return rounded(intake.apparent_intake(t.cons, t.fct, t.hh, ZoneOverride(t.zone_fct, zones)))


@query(f"""SELECT hhid, {rnd('energy_kcal / 1000', 4, 'energy_1000kcal')},
    {', '.join(rnd(div(n, '(energy_kcal / 1000)'), 4, n + '_1000kcal') for n in NUTRIENTS[1:])} FROM (
    SELECT hhid, {each('coalesce(sum(quantity_100g * f.@), 0) AS @')} FROM st_cons c LEFT JOIN st_fct f
    ON c.item_code = f.item_code GROUP BY hhid)""")
def nutrient_density(t: Tables):
    return rounded(intake.nutrient_density(t.cons, t.fct))


@query(f"SELECT hhid, {rnd('afe')}, item_code, item_name, food_group, {GRAMS}, {rounded_nutrients()} FROM st_full_grid")
def full_item_list(t: Tables):
    return rounded(intake.full_item_list(t.hh, t.cons, t.fct))


@query(f"""SELECT item_code, food_group, {', '.join(rnd(f'coalesce(sum({n}), 0)', 2, n) for n in [*QUANTITIES, *NUTRIENTS])}
    FROM st_grid GROUP BY item_code, food_group""")
def full_item_totals(t: Tables):
    return rounded(intake.full_item_totals(t.hh, t.cons, t.fct, ["item_code", "food_group"]), 2)


@query(f"""SELECT food_group, (SELECT count(*) FROM st_hh WHERE afe > 0) AS households,
    {', '.join(rnd(f'coalesce(sum({n}) FILTER (WHERE afe > 0), 0) / (SELECT count(*) FROM st_hh WHERE afe > 0)', 4, n) for n in [*QUANTITIES, *NUTRIENTS])}
    FROM st_grid GROUP BY food_group""")
def food_group_mean_intake(t: Tables):
    return rounded(intake.food_group_mean_intake(t.hh, t.cons, t.fct))


GROUPS = [
    "grains_roots_tubers", "nuts_seeds", "dairy", "meat_poultry_fish", "eggs", "green_leafy_veg", "vita_fruit_veg", "other_veg",
    "other_fruit", "misc", "Condiments",
]


@query(f"""SELECT h.hhid, {rnd('afe', 6)}, {', '.join(rnd(f"coalesce({g}, CASE WHEN afe > 0 THEN 0 END)", 2, g) for g in GROUPS)} FROM st_hh h
    LEFT JOIN (SELECT hhid, {each("coalesce(sum(quantity_g) FILTER (WHERE food_group = '@'), 0) AS @", GROUPS)} FROM st_grid
    GROUP BY hhid) g ON h.hhid = g.hhid""")
def food_group_matrix(t: Tables):
    return rounded(intake.food_group_matrix(t.hh, t.cons, t.fct, GROUPS), 2, afe=6)


# Cleaning


def per_unit(t: Tables) -> DataFrame:
    rows = na_join(t.cons, t.hh.select("hhid", "afe"), "hhid", null_keys=False)
    return cleaning.rescale(rows, "afe", QUANTITIES, to_unit=True)


@query(f"""SELECT p.hhid, p.item_code, p.food_group, {rnd('afe', 6)},
    {rnd('CASE WHEN quantity_g > 0 AND log10(quantity_g) > upper_cut THEN NULL ELSE quantity_g END', 4, 'quantity_g')}
    FROM st_per_afe p LEFT JOIN st_cutpoints c ON p.item_code = c.item_code""")
def outlier_log_sd(t: Tables):
    kept = cleaning.outlier_log_sd(per_unit(t), "item_code", "quantity_g")
    return rounded(kept.drop("quantity_100g"), afe=6)


@query(f"SELECT hhid, item_code, food_group, {GRAMS} FROM st_imputed")
def impute_group_median(t: Tables):
    kept = cleaning.outlier_log_sd(per_unit(t), "item_code", "quantity_g")
    kept = cleaning.blank_where_missing(kept, "quantity_100g", where="quantity_g")
    return rounded(cleaning.impute_group_median(kept, "item_code", QUANTITIES).drop("afe"))


@query(f"""SELECT c.hhid, item_code, food_group, {rnd('CASE WHEN afe > 0 THEN quantity_g END', 4, 'quantity_g')},
    {rnd('CASE WHEN afe > 0 THEN quantity_100g END', 4, 'quantity_100g')} FROM st_cons c LEFT JOIN st_hh h ON c.hhid = h.hhid""")
def afe_rescale_roundtrip(t: Tables):
    rows = na_join(t.cons, t.hh.select("hhid", "afe"), "hhid", null_keys=False)
    there = cleaning.rescale(rows, "afe", QUANTITIES, to_unit=True)
    return rounded(cleaning.rescale(there, "afe", QUANTITIES, to_unit=False).drop("afe"))


@query(f"SELECT hhid, item_code, food_group, {GRAMS} FROM st_clean")
def clean_consumption(t: Tables):
    return rounded(chains.clean_consumption(t.cons, t.hh))


@query(f"SELECT hhid, {rounded_nutrients()} FROM st_base_ai")
def base_model(t: Tables):
    return rounded(chains.base_model(t.cons, t.hh, t.fct))


# Adequacy


def _targets(source: str, survey_id: str) -> str:
    ratios = " + ".join(
        f"CASE WHEN {n} <= {ref} THEN {n} / {ref} WHEN {n} > {ref} THEN 1 END" for n, ref in TARGETS.values()
    )
    return (
        f"SELECT hhid, {', '.join(rnd(n, 4, s + '_ai') for s, (n, _) in TARGETS.items())}, "
        f"{', '.join(f'{ref}e0 AS {s}_ref' for s, (_, ref) in TARGETS.items())}, {rnd(f'({ratios}) / 5', 6, 'mar_simple')}, "
        f"{survey_id} AS survey_id FROM {source}"
    )


def rounded_targets(df: DataFrame) -> DataFrame:
    return rounded(df, mar_simple=6, **{f"{s}_ref": None for s in TARGETS})


@query(_targets("st_intake", f"'{SURVEY}'"))
def adequacy_targets(t: Tables):
    return rounded_targets(adequacy.adequacy_targets(intake.apparent_intake(t.cons, t.fct, t.hh), SURVEY))


def _survey_rows(survey_id: str) -> str:
    return f"(SELECT c.* FROM st_cons c JOIN st_dates d ON c.hhid = d.hhid WHERE coalesce(res, 'Other') = '{survey_id}')"


ZONAL_URBAN = "(SELECT * FROM st_zonal WHERE hhid IN (SELECT hhid FROM st_dates WHERE res = 'Urban'))"


@query(
    " UNION ALL ".join(
        [
            _targets(f"({intake_sql(_survey_rows('Rural'), fct='st_fct5')})", "'Rural'"),
            _targets(f"({intake_sql(_survey_rows('Other'), fct='st_fct4')})", "'Other'"),
            _targets(ZONAL_URBAN, "'Urban'"),
        ]
    )
)
def multi_survey_targets(t: Tables):
    member = t.residences.select("hhid", F.coalesce("res", F.lit("Other")).alias("survey_id"))
    cons = na_join(t.cons, member, "hhid", null_keys=False)
    hh = na_join(t.hh, member, "hhid", null_keys=False)
    fct = union_by_name(
        t.wave5_sheet.withColumn("survey_id", F.lit("Rural")),
        t.wave4_sheet.withColumn("survey_id", F.lit("Other")),
        t.fct.withColumn("survey_id", F.lit("Urban")),
    )
    zones = t.hh.select("hhid", F.col("adm1").alias("zone"))
    override = ZoneOverride(t.zone_fct, zones)
    return rounded_targets(adequacy.multi_survey_targets(cons, fct, hh, ("Urban", override)))


@query(
    f"SELECT {TAG}, hhid, {', '.join(rnd(n) for n, _ in TARGETS.values())}, "
    + rnd("(" + " + ".join(f"CASE WHEN {n} / {ref} > 1 THEN 1 ELSE {n} / {ref} END" for n, ref in TARGETS.values()) + ") / 5", 6, "overall_mar")
    + " FROM st_base_ai"
)
def mar_export(t: Tables):
    table = adequacy.mar_export(chains.base_model(t.cons, t.hh, t.fct), ISO3, SURVEY)
    return rounded(table, overall_mar=6)


# Exploration


@query("""SELECT item_code, itemname, round_even(avg(quantity_g), 1) AS mean_intake, round_even(stddev_samp(quantity_g), 1)
    AS sd_intake, round_even(median(quantity_g), 1) AS median_intake, count(*) AS n FROM st_cons
    LEFT JOIN in_items USING (item_code) GROUP BY item_code, itemname ORDER BY n DESC, item_code, itemname LIMIT 10""")
def topk_items(t: Tables):
    return explore.item_distribution(t.cons, t.items)


@query("""SELECT itemname AS "Food Item", round_even(avg(quantity_g), 1) AS "Mean intake (g)", round_even(stddev_samp(quantity_g), 1)
    AS "S.D.", round_even(median(quantity_g), 1) AS "Median intake (g)", count(*) AS "n households" FROM st_cons
    LEFT JOIN in_items USING (item_code) GROUP BY item_code, itemname ORDER BY count(*) DESC, item_code, itemname LIMIT 10""")
def topk_items_presentation(t: Tables):
    return explore.presentation_table(explore.item_distribution(t.cons, t.items))


def _histogram(rows: str) -> str:
    spans = f"""(SELECT item_code, low, w, CASE WHEN bins = 1 THEN floor((low - 0.05e0) / 0.1e0) * 0.1e0 + 0.05e0 ELSE low - w / 2 END
     AS start, bins FROM (SELECT item_code, low, CASE WHEN high = low THEN 0.1e0 ELSE (high - low) / 29 END AS w,
     CASE WHEN high = low THEN 1 ELSE 30 END AS bins FROM (SELECT item_code, min(quantity_g) AS low, max(quantity_g) AS high
     FROM {rows} WHERE quantity_g IS NOT NULL GROUP BY item_code)))"""
    place = "least(greatest(ceil((quantity_g - start) / w - 1e-8) - 1, 0), bins - 1)"
    return f"""SELECT b.item_code, CAST(b.bin AS INT) AS bin, {rnd('b.start + b.bin * b.w', 4, 'bin_from')},
    {rnd('b.start + b.bin * b.w + b.w', 4, 'bin_to')}, coalesce(n, 0) AS n FROM (
     SELECT item_code, start, w, unnest(generate_series(0, bins - 1)) AS bin FROM {spans}) b LEFT JOIN (
     SELECT q.item_code, {place} AS bin, count(*) AS n FROM {rows} q JOIN {spans} s ON q.item_code = s.item_code
     WHERE quantity_g IS NOT NULL GROUP BY q.item_code, {place}) c ON b.item_code = c.item_code AND b.bin = c.bin"""


TOP = """(SELECT item_code, quantity_g FROM st_cons WHERE item_code IN (
    SELECT item_code FROM st_cons GROUP BY item_code ORDER BY count(*) DESC, item_code LIMIT 10))"""


@query(_histogram(TOP))
def intake_histogram(t: Tables):
    top = explore.top_items(t.cons, t.items)
    return rounded(explore.intake_histogram(t.cons, top))


@query(_histogram("st_cons"))
def intake_histogram_all(t: Tables):
    return rounded(explore.intake_histogram(t.cons))


# Export


@query(f"""SELECT {TAG}, h.hhid, adm1, adm2, ea, h.res, sep_quintile, res_quintile, year, month, survey_wgt, {rnd('afe', 6)},
    exp_pae AS pc_expenditure FROM st_hh_info h LEFT JOIN in_expenditure e ON h.hhid = e.hhid""")
def export_hh_information(t: Tables):
    table = export.export_hh_information(t.hh_info, t.expenditure, ISO3, SURVEY)
    return rounded(table, 6, survey_wgt=None, pc_expenditure=None)


@query(f"SELECT {TAG}, item_code, food_group FROM (SELECT DISTINCT item_code, food_group FROM st_cons) ORDER BY item_code")
def export_food_group(t: Tables):
    return export.export_food_group(t.cons, ISO3, SURVEY)


@query(f"SELECT {TAG}, hhid, item_code, {GRAMS} FROM st_cons")
def export_food_consumption(t: Tables):
    return rounded(export.export_food_consumption(t.cons, ISO3, SURVEY))


@query(f"SELECT {TAG}, * FROM st_fct")
def export_fct(t: Tables):
    return export.export_fct(t.fct, ISO3, SURVEY)


@query(f"SELECT {TAG}, hhid, {rounded_nutrients()} FROM st_base_ai")
def export_base_ai(t: Tables):
    return rounded(export.export_base_ai(chains.base_model(t.cons, t.hh, t.fct), ISO3, SURVEY))
