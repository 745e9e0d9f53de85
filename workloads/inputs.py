"""Survey tables derived from the test tables.

The test data holds no survey, so households stand for customers, members for orders, food items for parts and consumption
rows for line items. The bodies run unchanged in Spark and in the SQL engine that checks the results; ``{name}`` refers to a
base table or an earlier body. Every customer, order and line item reaches its table; the lookups lack some items on purpose,
as survey lookups do.
"""

from __future__ import annotations

from functools import cached_property
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.columns import cast_numbers
from larder.operators import composition, household
from larder.operators.joins import na_join
from larder.plans import chains
from larder.sources.staging import co_partitioned, stage

# Columns used of the base tables.
BASE_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_discount double,"
    " l_tax double, l_returnflag string, l_linestatus string",
}

# Zones with their own composition; households of the fifth region have none.
ZONES = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]

BODIES = {
    # Household cover: 1 rural, 2 urban; codes 1-14 are interview months, 15 is unknown.
    "in_cover": """
SELECT CAST(c_custkey AS STRING) AS hhid, r_name AS adm1, n_name AS adm2, CAST(c_custkey % 40 AS INT) AS ea,
 CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 1 WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 2 END
 AS rural, CAST(1 + c_custkey % 15 AS INT) AS int_month_year, 0.5e0 + c_custkey % 7 AS survey_wgt
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "in_member": """
SELECT CAST(o_custkey AS STRING) AS hhid, o_orderkey AS indid, CAST(1 + o_orderkey % 2 AS INT) AS sex,
 CAST((o_orderkey * 37) % 71 AS INT) AS age, CASE WHEN o_orderkey % 11 = 0 THEN 2 ELSE 1 END AS eat7d,
 o_totalprice, o_orderpriority FROM {orders}""",
    "in_roster": """
SELECT p.hhid, p.indid, p.sex, p.age, p.eat7d, CASE WHEN p.age < 15 THEN h.mother END AS moid,
 CASE WHEN p.indid = h.first_member THEN 1 ELSE 2 END AS relationship
FROM {in_member} p JOIN (
 SELECT hhid, min(indid) AS first_member, max(CASE WHEN sex = 2 AND age BETWEEN 15 AND 60 THEN indid END) AS mother
 FROM {in_member} GROUP BY hhid) h ON p.hhid = h.hhid""",
    "in_anthropometry": """
SELECT hhid, indid, CASE WHEN indid % 13 <> 0 THEN 10e0 + o_totalprice / 1e4 END AS weight FROM {in_member}""",
    "in_child_ages": """
SELECT hhid, indid, CASE WHEN indid % 3 = 0 THEN CAST(age * 12 + indid % 12 AS DOUBLE) END AS age_months
FROM {in_member} WHERE age < 2""",
    "in_pregnancies": """
SELECT hhid, indid, CASE WHEN indid % 9 = 0 THEN 1 ELSE 2 END AS pregnant
FROM {in_member} WHERE sex = 2 AND age BETWEEN 15 AND 49""",
    "in_education": "SELECT hhid, indid, o_orderpriority AS educ FROM {in_member}",
    "in_expenditure": """
SELECT CAST(o_custkey AS STRING) AS hhid, 0.5e0 + o_custkey % 7 AS hhweight,
 CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / (100e0 * count(*)) AS exp_pae
FROM {orders} GROUP BY o_custkey""",
    # Consumption: units 1 kg, 2 g, 20 other; a few reports are negative, zero or a thousandfold. Households in debt were interviewed with the old module.
    "in_report": """
SELECT CAST(o_custkey AS STRING) AS y5_hhid, l_partkey AS itemcode, CASE WHEN l_discount > 0.095e0 THEN 2 ELSE 1 END
 AS consumed, CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 20 END AS unit,
 CASE WHEN l_returnflag = 'A' AND l_tax > 0.075e0 THEN NULL WHEN l_orderkey % 97 = 0 THEN l_quantity * 1000 WHEN l_orderkey % 89 = 0 THEN 0
 WHEN l_tax < 0.005e0 AND l_quantity > 49 THEN -l_quantity ELSE l_quantity END AS quantity, l_quantity, l_linestatus, l_linenumber, c_acctbal < 0 AS old_module
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey""",
    "in_raw_new": """
SELECT y5_hhid, itemcode, consumed AS hh_ja01, unit AS hh_ja02_1, quantity AS hh_ja02_2,
 CASE WHEN l_linenumber % 2 = 0 THEN 1 END AS hh_ja02b_1, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity / 8 END
 AS hh_ja02b_2, CASE WHEN l_linestatus = 'F' THEN 2 END AS hh_ja09_1, CASE WHEN l_linestatus = 'F' THEN l_quantity * 90 END
 AS hh_ja09_2 FROM {in_report} WHERE NOT old_module""",
    "in_raw_old": """
SELECT y5_hhid, itemcode, consumed AS hh_j01, unit AS hh_j02_1, quantity AS hh_j02_2 FROM {in_report} WHERE old_module""",
    "in_items": "SELECT p_partkey AS item_code, p_name AS itemname FROM {part}",
    "in_edible_new": """
SELECT p_partkey AS item_code, CASE WHEN p_size = 13 THEN 'n/a' ELSE CAST(0.5e0 + p_size / 128e0 AS STRING) END
 AS edible_portion FROM {part}""",
    "in_edible_old": "SELECT p_partkey AS item_code, 0.5e0 + p_size / 256e0 AS edible_portion FROM {part}",
    "in_conv_new": """
SELECT p_partkey AS item_code, 1 AS unit, 1000e0 AS conv_fac FROM {part} WHERE p_size <> 49 OR p_type <> 'PROMO'
UNION ALL SELECT p_partkey AS item_code, 2 AS unit, 1e0 AS conv_fac FROM {part} WHERE p_size <> 49 OR p_type <> 'PROMO'""",
    "in_conv_old": """
SELECT p_partkey AS item_code, 1 AS unit, 1000e0 AS conv_fac FROM {part} WHERE p_size <> 50 OR p_type <> 'ECONOMY'
UNION ALL SELECT p_partkey AS item_code, 2 AS unit, 1e0 AS conv_fac FROM {part} WHERE p_size <> 50 OR p_type <> 'ECONOMY'
UNION ALL SELECT p_partkey AS item_code, 20 AS unit, 250e0 AS conv_fac FROM {part}
 WHERE p_size <> 50 OR p_type <> 'ECONOMY'""",
    "in_groups_new": """
SELECT p_partkey AS item_code, CASE
 WHEN p_type = 'STANDARD' AND p_size <= 25 THEN 'Grains, roots, and tubers' WHEN p_type = 'STANDARD' THEN 'Other vegetables'
 WHEN p_type = 'PROMO' AND p_size <= 25 THEN 'Nuts and seeds' WHEN p_type = 'PROMO' THEN 'Meat, poultry, and fish'
 WHEN p_type = 'SMALL' AND p_size <= 25 THEN 'Dairy' WHEN p_type = 'SMALL' THEN 'Dark leafy greens and vegetables'
 WHEN p_type = 'LARGE' AND p_size <= 25 THEN 'Eggs' WHEN p_type = 'LARGE' THEN 'Other Vitamin A-rich fruits and vegetables'
 WHEN p_type = 'ECONOMY' AND p_size <= 25 THEN 'Misc' WHEN p_type = 'ECONOMY' THEN 'Other fruits'
 ELSE 'Condiments' END AS food_group FROM {part}""",
    "in_groups_old": """
SELECT p_partkey AS item_code, CASE WHEN p_brand = 'Brand#7' THEN 'Misc' ELSE food_group END AS food_group
FROM {part} JOIN {in_groups_new} ON p_partkey = item_code""",
    # Composition sheets hold text; some cells are not numbers.
    "in_wave5": """
SELECT CAST(p_partkey AS STRING) AS itemcode, p_name AS itemname, CAST(p_size * 10e0 AS STRING) AS ENERCkcal,
 CAST(p_partkey % 64 * 8e0 AS STRING) AS VITA_RAEmcg, CAST(p_size / 64e0 AS STRING) AS THIAmg,
 CAST(p_size / 32e0 AS STRING) AS RIBFmg, CAST(p_size / 4e0 AS STRING) AS NIAmg,
 CAST(p_partkey % 8 / 16e0 AS STRING) AS VITB6_mg_standardised, CAST(p_partkey % 32 * 4e0 AS STRING) AS FOLmcg_standardised,
 CASE WHEN p_brand = 'Brand#3' THEN 'trace' ELSE CAST(p_size / 16e0 AS STRING) END AS VITB12mcg,
 CAST(p_partkey % 16 / 8e0 AS STRING) AS FEmg, CASE WHEN p_brand = 'Brand#4' THEN '' ELSE CAST(p_size / 8e0 AS STRING) END
 AS ZNmg FROM {part} WHERE p_type <> 'MEDIUM'""",
    "in_wave4": """
SELECT CAST(p_partkey AS STRING) AS item_id, p_name AS item_desc, CAST(p_size * 11e0 AS STRING) AS ENERCkcal,
 CAST(p_partkey % 64 * 9e0 AS STRING) AS VITA_RAEmcg, CAST(p_size / 128e0 AS STRING) AS THIAmg,
 CAST(p_size / 16e0 AS STRING) AS RIBFmg, CAST(p_size / 8e0 AS STRING) AS NIAmg,
 CAST(p_partkey % 8 / 32e0 AS STRING) AS VITB6_mg_standardised, CAST(p_partkey % 32 * 5e0 AS STRING) AS FOLmcg_standardised,
 CAST(p_size / 32e0 AS STRING) AS VITB12mcg, CAST(p_partkey % 16 / 4e0 AS STRING) AS FEmg,
 CAST(p_size / 4e0 AS STRING) AS ZNmg FROM {part} WHERE p_brand <> 'Brand#25'""",
    # Composition by zone for some items.
    "in_zone_fct": "\nUNION ALL ".join(
        f"""
SELECT p_partkey AS item_code, '{zone}' AS zone, p_size * {10 + step}e0 AS energy_kcal, p_size * {1 + step}e0
 AS vita_rae_mcg, p_size / 64e0 AS thia_mg, p_size / 32e0 AS ribo_mg, p_size / 4e0 AS niac_mg, 0.25e0 AS vitb6_mg,
 p_size * 2e0 AS folate_mcg, p_size / 16e0 AS vitb12_mcg, {1 + step} / 8e0 AS fe_mg, {2 + step} / 8e0 AS zn_mg
FROM {{part}} WHERE p_brand = 'Brand#1' OR p_brand = 'Brand#2'"""
        for step, zone in enumerate(ZONES)
    ),
}


def references(body: str) -> list[str]:
    """Names a body refers to, in order, each once."""
    return list(dict.fromkeys(name for _, name, _, _ in Formatter().parse(body) if name))


class Tables:
    """The base tables of one directory and the survey tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A base table or a derived one; nothing is read before the table is used."""
        if name not in self._tables:
            if name in BASE_TABLES:
                scan = self.spark.read.schema(BASE_TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")
                self._tables[name] = scan
            else:
                body = BODIES[name]
                self._tables[name] = self.spark.sql(body, **{ref: self.table(ref) for ref in references(body)})
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if f"in_{name}" not in BODIES:
            raise AttributeError(name)
        return self.table(f"in_{name}")

    @property
    def edible(self) -> DataFrame:
        return cast_numbers(self.edible_new, keep=["item_code"])

    @property
    def new_module(self) -> chains.Module:
        return chains.Module(self.raw_new, self.items, self.edible, self.conv_new, self.groups_new)

    @property
    def old_module(self) -> chains.Module:
        return chains.Module(self.raw_old, self.items, self.edible_old, self.conv_old, self.groups_old)

    @property
    def wave5_sheet(self) -> DataFrame:
        return composition.composition_sheet(self.wave5, "itemcode", "itemname")

    @property
    def wave4_sheet(self) -> DataFrame:
        return composition.composition_sheet(self.wave4, "item_id", "item_desc")

    @cached_property
    def fct(self) -> DataFrame:
        """The composition table of the survey, stored."""
        return stage(composition.fct_build(self.wave5_sheet, self.wave4_sheet), "fct")

    @cached_property
    def cons(self) -> DataFrame:
        """The consumption table of the survey, stored."""
        return chains.store_consumption(self.new_module, self.old_module)

    @cached_property
    def homes(self) -> chains.Households:
        """The household tables of the survey, stored alike."""
        return chains.store_households(
            chains.Households(
                self.cover, self.roster, self.anthropometry, self.child_ages, self.pregnancies, self.education, self.expenditure
            )
        )

    @cached_property
    def person_sets(self) -> chains.PersonSets:
        return chains.person_sets(self.homes.roster, self.homes.child_ages, self.homes.pregnancies)

    @cached_property
    def afe(self) -> DataFrame:
        """Equivalents per household, stored."""
        return chains.store_afe(self.homes)

    @cached_property
    def hh(self) -> DataFrame:
        """Households with their equivalents, stored."""
        rows = na_join(self.homes.cover.select("hhid", "adm1"), self.afe, "hhid", null_keys=False)
        return stage(rows, "households", "hhid", arranged=True)

    @cached_property
    def residences(self) -> DataFrame:
        return household.residence_recode(self.homes.cover.select("hhid", "rural"))

    @cached_property
    def hh_info(self) -> DataFrame:
        """The household table of the survey, stored."""
        homes = self.homes
        with co_partitioned(self.spark):
            table = chains.household_table(homes.cover, homes.roster, homes.education, self.afe, homes.expenditure)
            return stage(table, "hh-info", "hhid", arranged=True)


def rounded(df: DataFrame, digits: int = 4, **other_digits: int | None) -> DataFrame:
    """Every double rounded for comparison; the shift keeps values that sit on a rounding tie from splitting.

    Name a column to give it other digits, or None to leave it. Zeros, of which the full item list is mostly made, need no rounding.
    """
    places = {name: other_digits.get(name, digits) for name, kind in df.dtypes if kind == "double"}
    return df.withColumns(
        {c: F.expr(f"CASE WHEN `{c}` = 0 THEN 0.0D ELSE round(`{c}` + 1.23e-{d + 2}D, {d}) END") for c, d in places.items() if d is not None}
    )
