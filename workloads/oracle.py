"""SQL side of the checks: named steps over the survey tables, written independently of the operators."""

from __future__ import annotations

import re

from workloads.inputs import BASE_TABLES, BODIES

NUTRIENTS = ["energy_kcal", "vita_rae_mcg", "thia_mg", "ribo_mg", "niac_mg", "vitb6_mg", "folate_mcg", "vitb12_mcg", "fe_mg", "zn_mg"]
TARGETS = {"va": ("vita_rae_mcg", 490), "fo": ("folate_mcg", 250), "vb12": ("vitb12_mcg", 2), "fe": ("fe_mg", 22.4), "zn": ("zn_mg", 10.2)}
SHEET = {"ENERCkcal": "energy_kcal", "VITA_RAEmcg": "vita_rae_mcg", "THIAmg": "thia_mg", "RIBFmg": "ribo_mg", "NIAmg": "niac_mg", "VITB6_mg_standardised": "vitb6_mg", "FOLmcg_standardised": "folate_mcg", "VITB12mcg": "vitb12_mcg", "FEmg": "fe_mg", "ZNmg": "zn_mg"}


def rnd(expr: str, digits: int = 4, name: str | None = None) -> str:
    """A rounded expression, named like its column unless told otherwise."""
    return f"round({expr} + 1.23e-{digits + 2}, {digits}) AS {name or expr.split('.')[-1]}"


def each(pattern: str, names=NUTRIENTS, sep: str = ", ") -> str:
    """The pattern once per name, ``@`` standing for the name."""
    return sep.join(pattern.replace("@", n) for n in names)


def rounded_nutrients(digits: int = 4) -> str:
    return ", ".join(rnd(n, digits) for n in NUTRIENTS)


def div(n: str, d: str) -> str:
    """Division with signed infinity and NULL for a zero divisor."""
    return f"CASE WHEN {d} = 0 THEN CASE WHEN {n} > 0 THEN CAST('Infinity' AS DOUBLE) WHEN {n} < 0 THEN CAST('-Infinity' AS DOUBLE) END ELSE {n} / {d} END"


def known(expr: str) -> str:
    """The value, or NULL where it is not a number."""
    return f"CASE WHEN NOT isnan({expr}) THEN {expr} END"


def _sheet(source: str, code: str, name: str) -> str:
    numbers = ", ".join(f"TRY_CAST({raw} AS DOUBLE) AS {new}" for raw, new in SHEET.items())
    return f"SELECT CAST({code} AS BIGINT) AS item_code, {name} AS item_name, {numbers} FROM {source}"


def _quantiles(source: str, by: str = "") -> str:
    group, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    cuts = ", ".join(f"min(CASE WHEN cum >= 0.{p}e0 * tot THEN x END) AS q{p}0" for p in (2, 4, 6, 8))
    return f"""SELECT {group}{cuts} FROM (
 SELECT {group}x, sum(w) OVER ({part} ORDER BY x) AS cum, sum(w) OVER ({part}) AS tot FROM (
  SELECT {group}exp_pae AS x, sum(hhweight) AS w FROM {source} GROUP BY {group}exp_pae)) {f'GROUP BY {by}' if by else ''}"""


def _quintile(cut: str, x: str = "exp_pae") -> str:
    return (
        f"CASE WHEN {x} < {cut}.q20 THEN 1 WHEN {x} >= {cut}.q20 AND {x} < {cut}.q40 THEN 2 WHEN {x} >= {cut}.q40 AND"
        f" {x} < {cut}.q60 THEN 3 WHEN {x} >= {cut}.q60 AND {x} < {cut}.q80 THEN 4 WHEN {x} >= {cut}.q80 THEN 5 END"
    )


def intake(cons: str, fct: str = "st_fct", hh: str = "st_hh") -> str:
    sums = each("coalesce(sum(f.@ * c.quantity_100g), 0) AS @")
    shares = ", ".join(f"{div('t.' + n, 'h.afe')} AS {n}" for n in NUTRIENTS)
    return f"""SELECT t.hhid, {shares} FROM (SELECT c.hhid, {sums} FROM {cons} c
 LEFT JOIN {fct} f ON c.item_code IS NOT DISTINCT FROM f.item_code GROUP BY c.hhid) t LEFT JOIN {hh} h ON t.hhid = h.hhid"""


STEPS = {name: body.format(**{n: n for n in [*BASE_TABLES, *BODIES]}) for name, body in BODIES.items()} | {
    "st_edible": "SELECT item_code, TRY_CAST(edible_portion AS DOUBLE) AS edible_portion FROM in_edible_new",
    "st_new": """SELECT y5_hhid AS hhid, itemcode AS item_code, itemname, hh_ja02_1 AS unit, hh_ja02_2 AS quantity,
 hh_ja02b_1 AS est_metric_unit, hh_ja02b_2 AS est_metric_quantity, hh_ja09_1 AS weighed_unit,
 hh_ja09_2 AS weighed_quantity, edible_portion, conv_fac FROM in_raw_new
 LEFT JOIN in_items i ON itemcode IS NOT DISTINCT FROM i.item_code LEFT JOIN st_edible e ON itemcode IS NOT DISTINCT FROM
 e.item_code LEFT JOIN in_conv_new u ON itemcode IS NOT DISTINCT FROM u.item_code AND hh_ja02_1 IS NOT DISTINCT FROM u.unit
 WHERE hh_ja01 = 1""",
    "st_old": """SELECT y5_hhid AS hhid, itemcode AS item_code, itemname, hh_j02_1 AS unit, hh_j02_2 AS quantity, edible_portion,
 conv_fac FROM in_raw_old
 LEFT JOIN in_items i ON itemcode IS NOT DISTINCT FROM i.item_code LEFT JOIN in_edible_old e ON itemcode IS NOT DISTINCT FROM
 e.item_code LEFT JOIN in_conv_old u ON itemcode IS NOT DISTINCT FROM u.item_code AND hh_j02_1 IS NOT DISTINCT FROM u.unit
 WHERE hh_j01 = 1""",
    "st_reported": """SELECT *, CASE WHEN unit = 1 OR unit = 2 OR unit = 3 OR unit = 4
 THEN quantity * conv_fac * edible_portion END AS g1 FROM st_new""",
    "st_weighed": """SELECT s.*, CASE WHEN weighed_quantity IS NOT NULL AND g1 IS NULL
 THEN weighed_quantity * u.conv_fac * edible_portion ELSE g1 END AS g2 FROM st_reported s LEFT JOIN in_conv_new u
 ON s.item_code IS NOT DISTINCT FROM u.item_code AND s.weighed_unit IS NOT DISTINCT FROM u.unit""",
    "st_resolved": """SELECT hhid, item_code, itemname, g AS quantity_g, g / 100 AS quantity_100g FROM (
 SELECT s.hhid, s.item_code, itemname, CASE WHEN est_metric_quantity IS NOT NULL AND g2 IS NULL
 THEN est_metric_quantity * u.conv_fac * edible_portion ELSE g2 END AS g FROM st_weighed s LEFT JOIN in_conv_new u
 ON s.item_code IS NOT DISTINCT FROM u.item_code AND s.est_metric_unit IS NOT DISTINCT FROM u.unit)""",
    "st_old_kept": "SELECT * FROM st_old WHERE hhid NOT IN (SELECT hhid FROM st_old WHERE conv_fac IS NULL)",
    "st_old_grams": """SELECT hhid, item_code, itemname, quantity * conv_fac * edible_portion AS quantity_g,
 quantity * conv_fac * edible_portion / 100 AS quantity_100g FROM st_old_kept""",
    "st_daily": """SELECT hhid, item_code, itemname, quantity_g / 7 AS quantity_g, quantity_100g / 7 AS quantity_100g
 FROM (SELECT * FROM st_resolved UNION ALL SELECT * FROM st_old_grams)""",
    "st_groups": """SELECT item_code, CASE food_group WHEN 'Grains, roots, and tubers' THEN 'grains_roots_tubers'
 WHEN 'Nuts and seeds' THEN 'nuts_seeds' WHEN 'Dairy' THEN 'dairy' WHEN 'Meat, poultry, and fish' THEN 'meat_poultry_fish'
 WHEN 'Eggs' THEN 'eggs' WHEN 'Dark leafy greens and vegetables' THEN 'green_leafy_veg'
 WHEN 'Other Vitamin A-rich fruits and vegetables' THEN 'vita_fruit_veg' WHEN 'Other vegetables' THEN 'other_veg'
 WHEN 'Other fruits' THEN 'other_fruit' WHEN 'Misc' THEN 'misc' ELSE food_group END AS food_group
 FROM (SELECT * FROM in_groups_new UNION SELECT * FROM in_groups_old)""",
    "st_cons": """SELECT hhid, d.item_code, quantity_100g, food_group, quantity_g FROM st_daily d LEFT JOIN st_groups g
 ON d.item_code IS NOT DISTINCT FROM g.item_code""",
    "st_fct5": _sheet("in_wave5", "itemcode", "itemname"),
    "st_fct4": _sheet("in_wave4", "item_id", "item_desc"),
    "st_fct": """SELECT * FROM st_fct5 UNION ALL SELECT * FROM st_fct4 o WHERE NOT EXISTS (
 SELECT 1 FROM st_fct5 n WHERE n.item_code IS NOT DISTINCT FROM o.item_code)""",
    "st_eaters": "SELECT hhid, indid, sex, age, moid FROM in_roster WHERE eat7d = 1",
    "st_infants": """SELECT e.hhid, e.indid, CASE WHEN a.age_months IS NULL THEN CAST(e.age * 12 AS DOUBLE) ELSE a.age_months
 END AS age_months, e.age FROM st_eaters e LEFT JOIN in_child_ages a ON e.hhid = a.hhid AND e.indid = a.indid
 WHERE e.age < 2""",
    "st_lactating": """SELECT m.hhid, m.indid, under6_months, over6_months, sex, age FROM (
 SELECT e.hhid, e.moid AS indid, count(*) FILTER (WHERE age_months <= 6) AS under6_months,
 count(*) FILTER (WHERE age_months > 6) AS over6_months FROM st_eaters e JOIN st_infants i
 ON e.hhid = i.hhid AND e.indid = i.indid WHERE age_months <= 23 AND e.moid IS NOT NULL GROUP BY e.hhid, e.moid) m
 LEFT JOIN st_eaters e ON m.hhid = e.hhid AND m.indid = e.indid WHERE age <= 53""",
    "st_pregnant": """SELECT p.hhid, p.indid, age, sex FROM in_pregnancies p JOIN st_eaters e ON p.hhid = e.hhid
 AND p.indid = e.indid WHERE pregnant = 1""",
    "st_others": """SELECT hhid, indid, age, sex FROM st_eaters e
 WHERE NOT EXISTS (SELECT 1 FROM st_infants s WHERE s.hhid = e.hhid AND s.indid = e.indid)
 AND NOT EXISTS (SELECT 1 FROM st_lactating s WHERE s.hhid = e.hhid AND s.indid = e.indid)
 AND NOT EXISTS (SELECT 1 FROM st_pregnant s WHERE s.hhid = e.hhid AND s.indid = e.indid)""",
    "st_weights": """SELECT sex, age, CASE WHEN age >= 15 AND sex = 1 THEN 65e0 WHEN age >= 15 AND sex = 2 THEN 55e0
 ELSE avg(weight) END AS meanw, CASE WHEN age > 18 THEN 1.76e0 END AS PAL FROM in_anthropometry a JOIN st_eaters e
 ON a.hhid = e.hhid AND a.indid = e.indid WHERE age >= 2 GROUP BY sex, age""",
    "st_child": """SELECT *, 239.005736e0 * CASE WHEN age <= 18 AND sex = 1 THEN 1.298e0 + 0.265e0 * meanw - 0.0011e0 * meanw ** 2
 WHEN age <= 18 AND sex = 2 THEN 1.102e0 + 0.273e0 * meanw - 0.0019e0 * meanw ** 2 END AS TEE FROM st_weights""",
    "st_bmr": """SELECT *, CASE WHEN sex = 1 AND age > 18 AND age <= 30 THEN 15.057e0 * meanw + 692.2e0
 WHEN sex = 1 AND age > 30 AND age < 60 THEN 11.472e0 * meanw + 873.1e0 WHEN sex = 1 AND age >= 60 THEN 11.711e0 * meanw
 + 587.7e0 WHEN sex = 2 AND age > 18 AND age <= 30 THEN 14.818e0 * meanw + 486.6e0 WHEN sex = 2 AND age > 30 AND age < 60
 THEN 8.126e0 * meanw + 845.6e0 WHEN sex = 2 AND age >= 60 THEN 9.082e0 * meanw + 658.5e0 END AS BMR FROM st_child""",
    "st_tee": "SELECT sex, age, meanw, PAL, BMR, CASE WHEN age > 18 THEN BMR * PAL ELSE TEE END AS TEE FROM st_bmr",
    "st_afe_infants": """SELECT hhid, indid, CASE WHEN age_months <= 2 THEN 0e0 WHEN age_months BETWEEN 3 AND 5 THEN 76e0
 WHEN age_months BETWEEN 6 AND 8 THEN 269e0 WHEN age_months BETWEEN 9 AND 11 THEN 451e0 WHEN age_months >= 12 THEN 746e0 END
 / 2291 AS afe FROM st_infants""",
    "st_afe_lactating": """SELECT hhid, indid, (TEE + under6_months * 505 + over6_months * 460) / 2291 AS afe
 FROM st_lactating p LEFT JOIN st_tee t ON p.sex = t.sex AND p.age = t.age""",
    "st_afe_pregnant": """SELECT hhid, indid, (TEE + 275) / 2291 AS afe FROM st_pregnant p LEFT JOIN st_tee t
 ON p.sex = t.sex AND p.age = t.age""",
    "st_afe_others": """SELECT hhid, indid, TEE / 2291 AS afe FROM st_others p LEFT JOIN st_tee t
 ON p.sex = t.sex AND p.age = t.age""",
    "st_afe": """SELECT hhid, coalesce(sum(afe), 0) AS afe FROM (SELECT * FROM st_afe_infants UNION ALL
 SELECT * FROM st_afe_lactating UNION ALL SELECT * FROM st_afe_pregnant UNION ALL SELECT * FROM st_afe_others) GROUP BY hhid""",
    "st_hh": "SELECT c.hhid, adm1, afe FROM in_cover c LEFT JOIN st_afe a ON c.hhid = a.hhid",
    "st_dates": """SELECT *, CASE WHEN int_month_year = 1 THEN 2020 WHEN int_month_year BETWEEN 2 AND 13 THEN 2021
 WHEN int_month_year = 14 THEN 2022 END AS year, CASE int_month_year WHEN 1 THEN 12 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3
 WHEN 5 THEN 4 WHEN 6 THEN 5 WHEN 7 THEN 6 WHEN 8 THEN 7 WHEN 9 THEN 8 WHEN 10 THEN 9 WHEN 11 THEN 10 WHEN 12 THEN 11
 WHEN 13 THEN 12 WHEN 14 THEN 1 END AS month, CASE rural WHEN 1 THEN 'Rural' WHEN 2 THEN 'Urban' END AS res FROM in_cover""",
    "st_heads": """SELECT r.hhid, CASE sex WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' END AS sex_head, age AS age_head,
 educ AS educ_head FROM in_roster r LEFT JOIN in_education e ON r.hhid = e.hhid AND r.indid = e.indid
 WHERE relationship = 1""",
    "st_spent": "SELECT e.*, res FROM in_expenditure e LEFT JOIN st_dates d ON e.hhid = d.hhid",
    "st_cuts": _quantiles("st_spent"),
    "st_cuts_by": _quantiles("(SELECT * FROM st_spent WHERE res IS NOT NULL)", "res"),
    "st_quintiles": f"""SELECT s.*, {_quintile('a')} AS sep_quintile, {_quintile('b')} AS res_quintile FROM st_spent s
 JOIN st_cuts a ON true LEFT JOIN st_cuts_by b ON s.res = b.res""",
    "st_hh_info": """SELECT d.hhid, adm1, adm2, d.res, sep_quintile, res_quintile, age_head, sex_head, educ_head, year, month,
 survey_wgt, afe, ea FROM st_dates d LEFT JOIN st_heads h ON d.hhid = h.hhid LEFT JOIN st_afe a ON d.hhid = a.hhid
 LEFT JOIN st_quintiles q ON d.hhid = q.hhid""",
    "st_per_afe": f"""SELECT c.hhid, item_code, food_group, afe, {div('quantity_g', 'afe')} AS quantity_g,
 {div('quantity_100g', 'afe')} AS quantity_100g FROM st_cons c LEFT JOIN st_hh h ON c.hhid = h.hhid""",
    # The logarithm of a zero is -Infinity, so an item with a zero has no cut point and keeps its large quantities.
    "st_cutpoints": """SELECT item_code, CASE WHEN NOT bool_or(quantity_g = 0) THEN avg(log10(quantity_g)) FILTER (WHERE quantity_g > 0)
 + 3 * stddev_samp(log10(quantity_g)) FILTER (WHERE quantity_g > 0) END AS upper_cut FROM st_per_afe WHERE quantity_g >= 0 GROUP BY item_code""",
    "st_trimmed": """SELECT hhid, item_code, food_group, afe, g AS quantity_g, CASE WHEN g IS NOT NULL THEN quantity_100g END
 AS quantity_100g FROM (SELECT p.*, CASE WHEN quantity_g > 0 AND log10(quantity_g) > upper_cut THEN NULL ELSE quantity_g END AS g
 FROM st_per_afe p LEFT JOIN st_cutpoints u ON p.item_code IS NOT DISTINCT FROM u.item_code)""",
    "st_imputed": """SELECT hhid, item_code, food_group, afe,
 coalesce(quantity_g, median(quantity_g) OVER (PARTITION BY item_code)) AS quantity_g,
 coalesce(quantity_100g, median(quantity_100g) OVER (PARTITION BY item_code)) AS quantity_100g FROM st_trimmed""",
    "st_clean": f"""SELECT hhid, item_code, food_group, {known('quantity_g * afe')} AS quantity_g,
 {known('quantity_100g * afe')} AS quantity_100g FROM st_imputed""",
    "st_intake": intake("st_cons"),
    "st_base_ai": intake("st_clean"),
    "st_eaten": """SELECT hhid, item_code, food_group, coalesce(sum(quantity_100g), 0) AS quantity_100g,
 coalesce(sum(quantity_g), 0) AS quantity_g FROM st_cons GROUP BY hhid, item_code, food_group""",
    "st_grid": f"""SELECT hhid, afe, item_code, quantity_100g, quantity_g, item_name, {each(known('@ * quantity_100g') + ' AS @')}, food_group
 FROM (SELECT h.hhid, afe, e.item_code, {div('quantity_100g', 'afe')} AS quantity_100g, {div('quantity_g', 'afe')} AS quantity_g
 FROM st_hh h JOIN st_eaten e ON h.hhid = e.hhid) JOIN st_fct USING (item_code) JOIN (SELECT DISTINCT item_code, food_group
 FROM st_cons) USING (item_code)""",
    # Every household by every listed item, consumed or not.
    "st_full_grid": f"""SELECT hhid, afe, item_code, quantity_100g, quantity_g, item_name, {each(known('@ * quantity_100g') + ' AS @')}, food_group
 FROM (SELECT h.hhid, afe, l.*, {div('coalesce(e.quantity_100g, 0)', 'afe')} AS quantity_100g, {div('coalesce(e.quantity_g, 0)', 'afe')} AS quantity_g
 FROM st_hh h CROSS JOIN (SELECT f.*, food_group FROM st_fct f JOIN (SELECT DISTINCT item_code, food_group FROM st_cons) g
 ON f.item_code IS NOT DISTINCT FROM g.item_code) l
 LEFT JOIN st_eaten e ON h.hhid = e.hhid AND l.item_code IS NOT DISTINCT FROM e.item_code)""",
    "st_zonal": f"""SELECT t.hhid, {', '.join(f"{div('t.' + n, 'h.afe')} AS {n}" for n in NUTRIENTS)} FROM (
 SELECT hhid, {each('coalesce(sum(@), 0) AS @')} FROM (
  SELECT c.hhid, {each('f.@ * c.quantity_100g AS @')} FROM st_cons c LEFT JOIN st_fct f ON c.item_code = f.item_code
  WHERE c.item_code NOT IN (SELECT item_code FROM in_zone_fct)
  UNION ALL SELECT c.hhid, {each('z.@ * c.quantity_100g AS @')} FROM st_cons c LEFT JOIN st_hh h ON c.hhid = h.hhid
  LEFT JOIN in_zone_fct z ON c.item_code = z.item_code AND h.adm1 = z.zone
  WHERE c.item_code IN (SELECT item_code FROM in_zone_fct)) GROUP BY hhid) t LEFT JOIN st_hh h ON t.hhid = h.hhid""",
}


def with_steps(query: str) -> str:
    """The query behind a WITH chain of exactly the steps it needs, in definition order."""
    needed: set[str] = set()
    todo = [query]
    while todo:
        for name in re.findall(r"\b(?:in|st)_\w+\b", todo.pop()):
            if name in STEPS and name not in needed:
                needed.add(name)
                todo.append(STEPS[name])
    chain = ",\n".join(f"{name} AS ({body})" for name, body in STEPS.items() if name in needed)
    return f"WITH {chain}\n{query}" if chain else query
