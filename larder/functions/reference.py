"""Fixed reference values: nutrient requirements, energy constants, label recodes, source column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Estimated average requirement per adult female and day.
REQUIREMENTS = {
    "energy_kcal": 2100.0,
    "vita_rae_mcg": 490.0,
    "thia_mg": 0.9,
    "ribo_mg": 1.3,
    "niac_mg": 11.0,
    "vitb6_mg": 1.3,
    "folate_mcg": 250.0,
    "vitb12_mcg": 2.0,
    "fe_mg": 22.4,
    "ca_mg": 860.0,
    "zn_mg": 10.2,
}

# Nutrients of the adequacy targets and their short names.
TARGET_NUTRIENTS = {
    "vita_rae_mcg": "va",
    "folate_mcg": "fo",
    "vitb12_mcg": "vb12",
    "fe_mg": "fe",
    "zn_mg": "zn",
}

# Food-group labels of the survey and their harmonised codes.
FOOD_GROUP_CODES = {
    "Grains, roots, and tubers": "grains_roots_tubers",
    "Nuts and seeds": "nuts_seeds",
    "Dairy": "dairy",
    "Meat, poultry, and fish": "meat_poultry_fish",
    "Eggs": "eggs",
    "Dark leafy greens and vegetables": "green_leafy_veg",
    "Other Vitamin A-rich fruits and vegetables": "vita_fruit_veg",
    "Other vegetables": "other_veg",
    "Other fruits": "other_fruit",
    "Misc": "misc",
}

# Nutrient columns of a composition sheet and their working names.
COMPOSITION_COLUMNS = {
    "ENERCkcal": "energy_kcal",
    "VITA_RAEmcg": "vita_rae_mcg",
    "THIAmg": "thia_mg",
    "RIBFmg": "ribo_mg",
    "NIAmg": "niac_mg",
    "VITB6_mg_standardised": "vitb6_mg",
    "FOLmcg_standardised": "folate_mcg",
    "VITB12mcg": "vitb12_mcg",
    "FEmg": "fe_mg",
    "ZNmg": "zn_mg",
}

# Energy model.
KCAL_PER_AFE = 2291.0
KCAL_PER_MJ = 239.005736
ACTIVITY_LEVEL = 1.76
ADULT_WEIGHT_KG = {1: 65.0, 2: 55.0}
LACTATION_KCAL_FIRST_SIX_MONTHS = 505
LACTATION_KCAL_LATER = 460
PREGNANCY_KCAL = 275
OLDEST_LACTATING_AGE = 53

# Kcal a child under two needs from food, by first and last month of age (None = no limit).
UNDER_TWO_KCAL = [
    (None, 2, 0.0),
    (3, 5, 76.0),
    (6, 8, 269.0),
    (9, 11, 451.0),
    (12, None, 746.0),
]

# Energy of children in MJ by sex = constant + linear * kg + square * kg^2.
CHILD_ENERGY = {
    1: (1.298, 0.265, -0.0011),
    2: (1.102, 0.273, -0.0019),
}

# Basal metabolic rate in kcal by sex and age = slope * kg + constant.
ADULT_BMR = [
    (1, "age > 18 AND age <= 30", 15.057, 692.2),
    (1, "age > 30 AND age < 60", 11.472, 873.1),
    (1, "age >= 60", 11.711, 587.7),
    (2, "age > 18 AND age <= 30", 14.818, 486.6),
    (2, "age > 30 AND age < 60", 8.126, 845.6),
    (2, "age >= 60", 9.082, 658.5),
]


def requirement_table(spark: SparkSession) -> DataFrame:
    """The requirements as a long table (nutrient, ear_value)."""
    return spark.createDataFrame(list(REQUIREMENTS.items()), "nutrient string, ear_value double")
