"""The processing chains from raw survey tables to the household table and the base model.

A chain decides which tables are stored because several later steps read them; storing a table runs a job while the chain is
built. Household tables are stored in buckets of the household id, so that members, measurements and covers of a household meet without an
exchange after that; checks of a table are counted in the job that stores it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import cleaning, consumption, energy, household, intake, quantiles
from larder.operators.consumption import NEW_MODULE, OLD_MODULE, QUANTITIES
from larder.operators.joins import na_join, union_by_name
from larder.operators.quality import key_known, not_negative
from larder.sources.staging import co_partitioned, stage


class Module(NamedTuple):
    """One consumption module with its lookups."""

    raw: DataFrame
    items: DataFrame
    edible: DataFrame
    unit_conv: DataFrame
    groups: DataFrame


def daily_consumption(new: Module, old: Module, recall_days: int = 7) -> DataFrame:
    """Grams per household, item and day from both modules."""
    fresh = consumption.quantity_resolution(
        consumption.prepare_consumption(new.raw, new.items, new.edible, new.unit_conv, NEW_MODULE), new.unit_conv
    )
    former = consumption.prepare_consumption(old.raw, old.items, old.edible, old.unit_conv, OLD_MODULE)
    former = consumption.quantity_old(consumption.exclude_incomplete_groups(former))
    return consumption.combine_modules(fresh, former, recall_days=recall_days)


def food_consumption(new: Module, old: Module, recall_days: int = 7) -> DataFrame:
    """The consumption table of a survey, with food groups."""
    return consumption.attach_food_group(daily_consumption(new, old, recall_days), [new.groups, old.groups])


def store_consumption(
    new: Module, old: Module, recall_days: int = 7, buckets: int | None = None, negative: int | None = None, no_household: int | None = 0
) -> DataFrame:
    """The consumption table of a survey in buckets of the household id.

    Negative quantities and rows without a household are counted as they are written; more than the limits are an error.
    """
    checks = [*not_negative(QUANTITIES, negative), *key_known(["hhid"], no_household)]
    return stage(food_consumption(new, old, recall_days), "food-consumption", "hhid", buckets, checks=checks)


class Households(NamedTuple):
    """The household tables of a survey, each keyed by ``hhid`` or by (hhid, indid)."""

    cover: DataFrame
    roster: DataFrame
    anthropometry: DataFrame
    child_ages: DataFrame
    pregnancies: DataFrame
    education: DataFrame
    expenditure: DataFrame


def store_households(tables: Households, buckets: int | None = None, limit: int | None = 0) -> Households:
    """The tables in buckets of the household id, all alike. More than ``limit`` rows without one are an error."""
    checks = key_known(["hhid"], limit)
    return Households(
        *[stage(df, name.replace("_", "-"), "hhid", buckets, checks=checks) for name, df in zip(tables._fields, tables, strict=True)]
    )


class PersonSets(NamedTuple):
    """Members who ate at home, and the overlapping sets among them that need their own energy rule."""

    eaters: DataFrame
    under_two: DataFrame
    lactating: DataFrame
    pregnant: DataFrame


def person_sets(roster: DataFrame, child_ages: DataFrame, pregnancies: DataFrame) -> PersonSets:
    """Split the roster. Nothing is stored: every set starts from a filter of the roster, which lies as its partners do."""
    eating = energy.eaters(roster)
    infants = energy.under_two(eating, child_ages)
    return PersonSets(eating, infants, energy.lactating(eating, infants), energy.pregnant(eating, pregnancies))


def household_afe(
    roster: DataFrame,
    anthropometry: DataFrame,
    child_ages: DataFrame,
    pregnancies: DataFrame,
    dedupe: str | None = None,
) -> DataFrame:
    """Adult-female equivalents per household.

    The members with a rule of their own are stored with their equivalents; everybody else is found against that table. Sets, rules and
    sums per household need no exchange if the four tables are bucketed by household and the plan is run inside ``co_partitioned``, as
    ``store_afe`` does.
    """
    eating, infants, mothers, expecting = person_sets(roster, child_ages, pregnancies)
    tee = stage(energy.tee_reference(anthropometry, eating), "energy")
    special = stage(
        union_by_name(
            energy.afe_under_two(infants), energy.afe_lactating(mothers, tee), energy.afe_pregnant(expecting, tee)
        ),
        "special-members",
        "hhid",
        arranged=True,
    )
    rest = energy.afe_other(energy.demographic_others(eating, special), tee)
    return energy.hh_afe(special, rest, dedupe=dedupe)


def store_afe(homes: Households, dedupe: str | None = None, buckets: int | None = None) -> DataFrame:
    """The equivalents of stored households, stored alike."""
    with co_partitioned(homes.roster.sparkSession):
        afe = household_afe(homes.roster, homes.anthropometry, homes.child_ages, homes.pregnancies, dedupe)
        return stage(afe, "afe", "hhid", buckets, arranged=True)


def expenditure_quintiles(expenditure: DataFrame, residences: DataFrame) -> DataFrame:
    """Overall and within-residence quintile of every household's expenditure.

    The whole population and each residence are groups of one quantile run.
    """
    spent = expenditure.select("hhid", "hhweight", "exp_pae")
    spent = stage(na_join(spent, residences.select("hhid", "res"), "hhid", null_keys=False), "spent", "hhid", arranged=True)
    everyone = F.lit("")
    grouped = spent.select("hhweight", "exp_pae", F.explode(F.array(everyone, "res")).alias("domain"))
    cuts = stage(quantiles.weighted_quantile(grouped, "exp_pae", "hhweight", by="domain"), "cuts")
    rows = household.assign_quintile(spent, "exp_pae", cuts.filter(F.col("domain") == everyone), "sep_quintile")
    within = cuts.withColumnRenamed("domain", "res")
    return household.assign_quintile(rows, "exp_pae", within, "res_quintile", by="res")


def household_table(
    cover: DataFrame, roster: DataFrame, education: DataFrame, afe: DataFrame, expenditure: DataFrame
) -> DataFrame:
    """The household table of a survey."""
    decoded = household.residence_recode(household.interview_date(cover))
    return household.hh_info(
        decoded, household.household_head(roster, education), afe, expenditure_quintiles(expenditure, decoded)
    )


def clean_consumption(cons: DataFrame, hh: DataFrame, k: float = 3, **median_options) -> DataFrame:
    """Consumption with implausibly large quantities replaced by the median of their item.

    Neither the rows per equivalent nor a copy of their values is stored: the join with the households is part of each pass, and needs no
    exchange where both tables lie bucketed by household.
    """
    rows = na_join(cons, hh.select("hhid", "afe"), "hhid", null_keys=False)
    per_unit = cleaning.rescale(rows, "afe", QUANTITIES, to_unit=True)
    filled = cleaning.replace_outliers(per_unit, "item_code", QUANTITIES, k, **median_options)
    return cleaning.rescale(filled, "afe", QUANTITIES, to_unit=False).drop("afe")


def base_model(cons: DataFrame, hh: DataFrame, fct: DataFrame, k: float = 3) -> DataFrame:
    """Apparent intake per household from cleaned consumption."""
    return intake.apparent_intake(clean_consumption(cons, hh, k), fct, hh)
