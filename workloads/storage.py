"""Queries for what the library stores and how: raw maps, checks, layers, grids, batches, ordered and named tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators import adequacy, composition, export, intake, quality
from larder.operators.grid import ImpliedGrid
from larder.operators.histogram import MomentHistogram
from larder.operators.joins import na_join, union_by_name
from larder.operators.layers import CompositionLayers, Layer
from larder.plans import chains
from larder.sources import batches, raw, staging, tables
from larder.sources.staging import new_path, scope, stage
from workloads.inputs import Tables, rounded
from workloads.oracle import NUTRIENTS, intake as intake_sql, rnd, rounded_nutrients
from workloads.registry import query
from workloads.survey import ISO3, SURVEY, TAG, _survey_rows, _targets, rounded_targets

QUANTITIES = ["quantity_g", "quantity_100g"]


# Checks that ride on the write


@query("""SELECT 'rows' AS name, count(*) AS n FROM st_cons UNION ALL SELECT 'negative_quantity_g', count(*) FILTER (WHERE quantity_g < 0)
    FROM st_cons UNION ALL SELECT 'negative_quantity_100g', count(*) FILTER (WHERE quantity_100g < 0) FROM st_cons
    UNION ALL SELECT 'null_hhid', count(*) FILTER (WHERE hhid IS NULL) FROM st_cons""")
def dq_checked_write(t: Tables):
    counts: dict[str, int] = {}
    checks = [*quality.not_negative(QUANTITIES, None), *quality.key_known(["hhid"])]
    stage(chains.food_consumption(t.new_module, t.old_module), "checked", checks=checks, counts=counts)
    return t.spark.createDataFrame(sorted(counts.items()), "name string, n bigint")


@query("""SELECT count(*) AS rows, count(DISTINCT item_code) AS items, count(*) - count(DISTINCT item_code) AS repeated_key FROM st_groups""")
def dq_repeated_lookup_keys(t: Tables):
    groups = t.groups_new.unionByName(t.groups_old).distinct()
    counts: dict[str, int] = {}
    lookup = stage(
        quality.numbered_copies(groups, ["item_code"]), "lookup", checks=[quality.key_unique(None)], drop=[quality.COPY], counts=counts
    )
    rows = lookup.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("item_code").alias("items"))
    return rows.withColumn("repeated_key", F.lit(counts["repeated_key"]).cast("bigint"))


# Raw tables


def raw_frames(t: Tables) -> dict:
    """The survey under its raw names, one table per map."""
    fresh = {
        "cover": t.cover, "roster": t.roster, "education": t.education, "pregnancies": t.pregnancies, "child_ages": t.child_ages,
        "anthropometry": t.anthropometry, "expenditure": t.expenditure, "consumption_new": t.raw_new, "consumption_old": t.raw_old,
        "items": t.items, "edible_new": t.edible_new, "edible_old": t.edible_old, "unit_conv_new": t.conv_new, "unit_conv_old": t.conv_old,
        "groups_new": t.groups_new, "groups_old": t.groups_old,
    }
    out = {}
    for name, df in fresh.items():
        mapping = raw.raw_map(name if name not in MANY else MANY[name])
        back = {working: raw_name for raw_name, (working, _) in mapping.columns.items()}
        out[name] = (df.withColumnsRenamed({c: back[c] for c in df.columns if c in back}), mapping)
    return out


MANY = {"unit_conv_new": "unit_conv", "unit_conv_old": "unit_conv", "groups_new": "groups", "groups_old": "groups"}


def raw_files(t: Tables) -> dict:
    """The same written as CSV and read back as text."""
    base = new_path(t.spark, "raw")
    out = {}
    for name, (df, mapping) in raw_frames(t).items():
        tables.write_csv_na(df, f"{base}/{name}")
        out[name] = (raw.read_text(t.spark, f"{base}/{name}"), mapping)
    return out


@query(f"SELECT hhid, {rounded_nutrients()} FROM st_base_ai")
def raw_to_base_ai(t: Tables):
    """From files under their raw names to the intake table."""
    r = {name: raw.apply(df, mapping) for name, (df, mapping) in raw_files(t).items()}
    units = {w: k for k, (w, _) in raw.raw_map("consumption_new").columns.items()}
    former = {w: k for k, (w, _) in raw.raw_map("consumption_old").columns.items()}
    new = chains.Module(r["consumption_new"].withColumnsRenamed(units), r["items"], r["edible_new"], r["unit_conv_new"], r["groups_new"])
    old = chains.Module(r["consumption_old"].withColumnsRenamed(former), r["items"], r["edible_old"], r["unit_conv_old"], r["groups_old"])
    cons = chains.store_consumption(new, old)
    homes = chains.store_households(chains.Households(*[r[name] for name in chains.Households._fields]))
    hh = stage(na_join(homes.cover.select("hhid"), chains.store_afe(homes), "hhid", null_keys=False), "raw-households", "hhid", arranged=True)
    return rounded(chains.base_model(cons, hh, t.fct))


@query("""SELECT 'edible_new' AS "table", 'y5' AS version, CAST(item_code AS VARCHAR) AS row_key, 'edible_portion' AS "column",
    'Edible_factor_in_FCT' AS raw_column, edible_portion AS value FROM in_edible_new WHERE TRY_CAST(edible_portion AS DOUBLE) IS NULL""")
def raw_quarantine(t: Tables):
    frames = raw_frames(t)
    kept = [raw.store(*frames[name]) for name in ("edible_new", "edible_old", "unit_conv_new", "cover", "consumption_new", "consumption_old")]
    assert all(s.bad_rows == 0 for s in kept[1:])
    return union_by_name(*[s.unparsed for s in kept])


# Layers and grids


@query(f"""SELECT c.survey_id, c.zone, c.item_code, CASE WHEN z.listed THEN {rnd('m.energy_kcal')[:-len(' AS energy_kcal')]}
    WHEN f.item_code IS NOT NULL THEN {rnd('f.energy_kcal')[:-len(' AS energy_kcal')]} ELSE {rnd('g.energy_kcal')[:-len(' AS energy_kcal')]} END AS energy_kcal
    FROM (SELECT DISTINCT res AS survey_id, adm1 AS zone, item_code FROM st_cons JOIN st_dates USING (hhid)) c
    LEFT JOIN (SELECT DISTINCT item_code, true AS listed FROM in_zone_fct) z ON c.item_code = z.item_code AND c.survey_id = 'Urban'
    LEFT JOIN in_zone_fct m ON c.item_code = m.item_code AND c.zone = m.zone
    LEFT JOIN st_fct5 f ON c.item_code = f.item_code AND c.survey_id IS NOT DISTINCT FROM 'Urban'
    LEFT JOIN st_fct4 g ON c.item_code = g.item_code""")
def composition_lookup(t: Tables):
    """Zone tables of one survey over that survey's sheet over a sheet for all surveys."""
    homes = na_join(t.hh.select("hhid", F.col("adm1").alias("zone")), t.residences, "hhid", null_keys=False)
    met = na_join(t.cons.select("hhid", "item_code"), homes, "hhid", "inner", null_keys=False)
    met = met.select(F.col("res").alias("survey_id"), "zone", "item_code").distinct()
    urban = F.lit("Urban")
    layers = CompositionLayers([Layer(t.zone_fct, urban, "zone"), Layer(t.wave5_sheet, urban), Layer(t.wave4_sheet)], NUTRIENTS)
    found = layers.resolve(met, F.col("survey_id"), F.col("zone"))
    return rounded(found.select("survey_id", "zone", "item_code", F.col("amounts")["energy_kcal"].alias("energy_kcal")))


@query(
    " UNION ALL ".join(
        [
            _targets(f"({intake_sql(_survey_rows('Rural'), fct='st_fct5')})", "'Rural'"),
            _targets(f"({intake_sql(_survey_rows('Other'), fct='st_fct4')})", "NULL"),
            _targets(f"({intake_sql(_survey_rows('Urban'))})", "'Urban'"),
        ]
    )
)
def multi_survey_targets_null(t: Tables):
    """Households without a residence are a survey whose name is NULL."""
    member = t.residences.select("hhid", F.col("res").alias("survey_id"))
    cons, hh = (na_join(df, member, "hhid", null_keys=False) for df in (t.cons, t.hh))
    fct = union_by_name(
        t.wave5_sheet.withColumn("survey_id", F.lit("Rural")),
        t.wave4_sheet.withColumn("survey_id", F.lit(None).cast("string")),
        t.fct.withColumn("survey_id", F.lit("Urban")),
    )
    return rounded_targets(adequacy.multi_survey_targets(cons, fct, hh))


def grid(t: Tables) -> ImpliedGrid:
    return ImpliedGrid(t.hh, t.cons, t.fct)


CELLS = "(SELECT adm1, afe, hhid, item_code, food_group FROM st_hh CROSS JOIN (SELECT item_code, food_group FROM st_fct JOIN (SELECT DISTINCT item_code, food_group FROM st_cons) USING (item_code)))"
GRID_SUMS = ", ".join(f"sum({n}) AS {n}" for n in [*QUANTITIES, *NUTRIENTS])


@query(f"""SELECT c.adm1, c.food_group, {', '.join(rnd(f'coalesce(g.{n}, 0)', 2, n) for n in [*QUANTITIES, *NUTRIENTS])}
    FROM (SELECT DISTINCT adm1, food_group FROM {CELLS}) c LEFT JOIN (SELECT h.adm1, food_group, {GRID_SUMS} FROM st_grid
    JOIN st_hh h USING (hhid) GROUP BY h.adm1, food_group) g ON c.adm1 = g.adm1 AND c.food_group = g.food_group""")
def grid_sum_by_zone(t: Tables):
    return rounded(grid(t).sum(["food_group"], ["adm1"]), 2)


@query(f"""SELECT c.adm1, c.food_group, c.households, {', '.join(rnd(f'coalesce(g.{n}, 0) / nullif(c.cells, 0)', 6, n) for n in [*QUANTITIES, *NUTRIENTS])}
    FROM (SELECT adm1, food_group, count(DISTINCT hhid) FILTER (WHERE afe > 0) AS households, count(*) FILTER (WHERE afe > 0) AS cells FROM {CELLS}
    GROUP BY adm1, food_group) c LEFT JOIN (SELECT h.adm1, food_group, {GRID_SUMS} FROM st_grid JOIN st_hh h USING (hhid) WHERE h.afe > 0
    GROUP BY h.adm1, food_group) g ON c.adm1 = g.adm1 AND c.food_group = g.food_group""")
def grid_cell_mean_by_zone(t: Tables):
    """The mean over all cells of a zone and food group, zeros included."""
    return rounded(grid(t).mean(["food_group"], ["adm1"], per="cell").drop("items"), 6)


@query(f"""SELECT adm1, food_group, count(DISTINCT hhid) FILTER (WHERE afe > 0) AS households, count(DISTINCT item_code) AS items FROM {CELLS}
    GROUP BY adm1, food_group""")
def grid_counts(t: Tables):
    return grid(t).counts(["food_group"], ["adm1"])


@query(f"""SELECT item_code, count(*) AS rows, count(quantity_g) AS n, {rnd('avg(quantity_g)', 4, 'mean')}, {rnd('stddev_samp(quantity_g)', 4, 'sd')},
    {rnd('min(quantity_g)', 4, 'low')}, {rnd('max(quantity_g)', 4, 'high')} FROM st_cons GROUP BY item_code""")
def item_moments(t: Tables):
    return rounded(MomentHistogram(t.cons, ["item_code"], ["quantity_g"]).moments().drop("square"))


# Batches, names, order, reuse


@query(f"""SELECT 'hh_information' AS "table", count(*) AS rows FROM st_hh_info UNION ALL SELECT 'food_group', count(*) FROM (SELECT DISTINCT item_code, food_group
    FROM st_cons) UNION ALL SELECT 'food_consumption', count(*) FROM st_cons UNION ALL SELECT 'fct', count(*) FROM st_fct
    UNION ALL SELECT 'base_ai', count(*) FROM st_intake UNION ALL SELECT 'ml_targets', count(*) FROM st_intake""")
def sink_append_batches(t: Tables):
    """The six tables, appended after a writer failed between two of them, and once more after that."""
    base = new_path(t.spark, "batches")
    base_ai = stage(intake.apparent_intake(t.cons, t.fct, t.hh), "base-ai")
    six = {
        "hh_information": export.export_hh_information(t.hh_info, t.homes.expenditure, ISO3, SURVEY),
        "food_group": export.export_food_group(t.cons, ISO3, SURVEY),
        "food_consumption": export.export_food_consumption(t.cons, ISO3, SURVEY),
        "fct": export.export_fct(t.fct, ISO3, SURVEY),
        "base_ai": export.export_base_ai(base_ai, ISO3, SURVEY),
        "ml_targets": adequacy.mar_export(base_ai, ISO3, SURVEY),
    }
    first = f"{ISO3}_{SURVEY}"
    six["hh_information"].write.parquet(f"{base}/hh_information/batch={first}")  # what a failed writer leaves
    batches.append(base, first, six)
    batches.append(base, first, six)
    parts = [batches.read(t.spark, base, name).groupBy().agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(name)) for name in six]
    return union_by_name(*parts)


@query(f"SELECT hhid, {rounded_nutrients()} FROM st_intake")
def base_ai_named(t: Tables):
    base = new_path(t.spark, "named")
    tables.save_base_ai(intake.apparent_intake(t.cons, t.fct, t.hh), base, "survey1", "csv")
    return rounded(tables.load_base_ai(t.spark, base, "survey1", "csv"))


@query(f"""SELECT row_number() OVER (ORDER BY item_code NULLS LAST, hhid, food_group NULLS FIRST, quantity_g NULLS FIRST) - 1 AS row_order, {TAG}, item_code, hhid,
    {rnd('quantity_g')} FROM st_cons""")
def export_ordered(t: Tables):
    path = new_path(t.spark, "ordered")
    rows = export.tagged(t.cons.select("item_code", "hhid", "food_group", "quantity_g"), ISO3, SURVEY)
    tables.write_ordered(rows, path, [F.asc_nulls_last("item_code"), F.asc("hhid"), F.asc("food_group"), F.asc("quantity_g")], rows_per_file=5000)
    return rounded(tables.read_ordered(t.spark, path).drop("food_group"))


@query("SELECT * FROM st_fct")
def fct_reused(t: Tables):
    """The composition table as a second run finds it."""
    kept = f"{staging.shared_dir(t.spark)}/kept"
    with scope(t.spark, reuse=kept):
        stage(composition.fct_build(t.wave5_sheet, t.wave4_sheet), "fct")
    with scope(t.spark, reuse=kept) as second:
        table = stage(composition.fct_build(t.wave5_sheet, t.wave4_sheet), "fct")
        assert second.reused == ["fct"]
    return table
