"""Adult-female equivalents of a household from roster, anthropometry and pregnancy tables.

Persons are identified by (hhid, indid). The household id is never NULL, so tables bucketed by it meet where they lie. Each person
set is its own table, as the sets overlap on purpose: a woman who is pregnant and lactating belongs to both and counts in both
unless ``hh_afe(dedupe='max')`` is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import reference as ref
from larder.functions.missing import count_where, if_else, sum_or_zero
from larder.operators.joins import na_join, union_by_name, without_keys

PERSON = ["hhid", "indid"]
MAY_BE_NULL = ["indid"]
PROFILE = ["sex", "age"]


def eaters(roster: DataFrame) -> DataFrame:
    """Members who ate at home in the recall period."""
    return roster.filter(F.col("eat7d") == 1).select(*PERSON, "sex", "age", "moid")


def under_two(eating: DataFrame, child_ages: DataFrame) -> DataFrame:
    """Children below two years, age in months taken from the child table or else from the years."""
    months = F.coalesce(F.col("age_months"), F.col("age") * 12).cast("double")
    rows = na_join(eating.filter(F.col("age") < 2), child_ages.select(*PERSON, "age_months"), PERSON, null_keys=MAY_BE_NULL)
    return rows.select(*PERSON, months.alias("age_months"), "age")


def lactating(eating: DataFrame, infants: DataFrame, max_age: int = ref.OLDEST_LACTATING_AGE) -> DataFrame:
    """Mothers of eating children up to 23 months, with the number of children up to and past six months."""
    children = (
        na_join(eating.select(*PERSON, "moid"), infants.select(*PERSON, "age_months"), PERSON, "inner", MAY_BE_NULL)
        .filter((F.col("age_months") <= 23) & F.col("moid").isNotNull())
    )
    mothers = children.groupBy("hhid", F.col("moid").alias("indid")).agg(
        count_where("age_months <= 6").alias("under6_months"),
        count_where("age_months > 6").alias("over6_months"),
    )
    return na_join(mothers, eating.select(*PERSON, *PROFILE), PERSON, null_keys=MAY_BE_NULL).filter(F.col("age") <= max_age)


def pregnant(eating: DataFrame, pregnancies: DataFrame) -> DataFrame:
    """Pregnant eaters with age and sex."""
    rows = pregnancies.filter(F.col("pregnant") == 1).select(*PERSON)
    return na_join(rows, eating.select(*PERSON, "age", "sex"), PERSON, "inner", MAY_BE_NULL)


def demographic_others(eating: DataFrame, *sets: DataFrame) -> DataFrame:
    """Eaters in none of the person sets."""
    return without_keys(eating, sets, PERSON, MAY_BE_NULL).select(*PERSON, "age", "sex")


def under_two_kcal(months: str) -> Column:
    """Energy needed from food by age in months; ages between two listed spans are NULL."""
    cases = []
    for first, last, value in ref.UNDER_TWO_KCAL:
        limits = [f"{months} >= {first}"] * (first is not None) + [f"{months} <= {last}"] * (last is not None)
        cases.append(f"WHEN {' AND '.join(limits)} THEN {value}D")
    return F.expr(f"CASE {' '.join(cases)} END")


def afe_under_two(infants: DataFrame, kcal_per_afe: float = ref.KCAL_PER_AFE) -> DataFrame:
    return infants.select(*PERSON, (under_two_kcal("age_months") / kcal_per_afe).alias("afe"))


def mean_weights(
    anthropometry: DataFrame, eating: DataFrame, pal: float = ref.ACTIVITY_LEVEL, adult_kg: dict = ref.ADULT_WEIGHT_KG
) -> DataFrame:
    """Mean weight per sex and age from two years on, assumed weights from 15 on, and the activity level of adults."""
    weighed = na_join(anthropometry.select(*PERSON, "weight"), eating.select(*PERSON, *PROFILE), PERSON, null_keys=MAY_BE_NULL)
    rows = weighed.groupBy(*PROFILE).agg(F.avg("weight").alias("meanw")).filter(F.col("age") >= 2)
    for code, assumed in adult_kg.items():
        rows = rows.withColumn("meanw", if_else(f"age >= 15 AND sex = {code}", f"{assumed}D", "meanw"))
    return rows.withColumn("PAL", if_else("age > 18", f"{pal}D", "NULL"))


def child_tee(weights: DataFrame) -> DataFrame:
    """Daily kcal up to 18 years from the quadratic weight equations."""
    mj = "CAST(NULL AS DOUBLE)"
    for code, (constant, linear, square) in ref.CHILD_ENERGY.items():
        equation = f"{constant}D + {linear}D * meanw + ({square}D) * meanw * meanw"
        child = f"sex = {code} AND age <= 18"
        mj = f"CASE WHEN {child} THEN {equation} WHEN NOT ({child}) THEN {mj} END"
    return weights.withColumn("TEE", F.expr(mj) * ref.KCAL_PER_MJ)


def adult_tee(weights: DataFrame) -> DataFrame:
    """Basal metabolic rate by sex and age span; kcal past 18 years is that times the activity level."""
    cases = [f"WHEN sex = {code} AND {span} THEN {slope}D * meanw + {constant}D" for code, span, slope, constant in ref.ADULT_BMR]
    return weights.withColumn("BMR", F.expr(f"CASE {' '.join(cases)} END")).withColumn(
        "TEE", if_else("age > 18", "BMR * PAL", "TEE")
    )


def tee_reference(
    anthropometry: DataFrame, eating: DataFrame, pal: float = ref.ACTIVITY_LEVEL, adult_kg: dict = ref.ADULT_WEIGHT_KG
) -> DataFrame:
    """Daily energy expenditure per sex and age."""
    return adult_tee(child_tee(mean_weights(anthropometry, eating, pal, adult_kg)))


def _person_afe(persons: DataFrame, tee: DataFrame, extra_kcal: Column, kcal_per_afe: float) -> DataFrame:
    rows = na_join(persons, tee.select(*PROFILE, "TEE"), PROFILE)
    return rows.select(*PERSON, ((F.col("TEE") + extra_kcal) / kcal_per_afe).alias("afe"))


def afe_lactating(mothers: DataFrame, tee: DataFrame, kcal_per_afe: float = ref.KCAL_PER_AFE) -> DataFrame:
    extra = (
        F.col("under6_months") * ref.LACTATION_KCAL_FIRST_SIX_MONTHS
        + F.col("over6_months") * ref.LACTATION_KCAL_LATER
    )
    return _person_afe(mothers, tee, extra, kcal_per_afe)


def afe_pregnant(women: DataFrame, tee: DataFrame, kcal_per_afe: float = ref.KCAL_PER_AFE) -> DataFrame:
    return _person_afe(women, tee, F.lit(ref.PREGNANCY_KCAL), kcal_per_afe)


def afe_other(persons: DataFrame, tee: DataFrame, kcal_per_afe: float = ref.KCAL_PER_AFE) -> DataFrame:
    return _person_afe(persons, tee, F.lit(0), kcal_per_afe)


def hh_afe(*person_afe: DataFrame, dedupe: str | None = None) -> DataFrame:
    """Sum of the members' equivalents per household; 0 when none is known.

    ``dedupe='max'`` counts a person who is in several sets once, with the largest equivalent.
    """
    rows = union_by_name(*person_afe)
    if dedupe == "max":
        rows = rows.groupBy(*PERSON).agg(F.max("afe").alias("afe"))
    elif dedupe is not None:
        raise ValueError(f"unknown dedupe rule: {dedupe}")
    return rows.groupBy("hhid").agg(sum_or_zero("afe").alias("afe"))
