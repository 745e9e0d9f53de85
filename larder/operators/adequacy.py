"""Nutrient adequacy ratios."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import across, column_range
from larder.functions.missing import if_else
from larder.functions.reference import REQUIREMENTS, TARGET_NUTRIENTS
from larder.operators.intake import ZoneOverride, nutrients_of
from larder.operators.joins import na_join
from larder.operators.layers import SURVEY, CompositionLayers, Layer


def _mean(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns) / len(columns)


def adequacy_targets(
    intake: DataFrame,
    survey_id: str | None = None,
    requirements: dict[str, float] = REQUIREMENTS,
    nutrients: dict[str, str] = TARGET_NUTRIENTS,
    score: str = "mar_simple",
) -> DataFrame:
    """Intakes, requirements and the mean adequacy ratio; any missing intake makes the mean missing.

    ``survey_id`` is a constant, or ``None`` when the table already carries a ``survey_id`` column.
    """
    rows = intake if survey_id is None else intake.withColumn("survey_id", F.lit(survey_id))

    def ratio(short: str) -> Column:
        return if_else(f"{short}_ai <= {short}_ref", f"{short}_ai / {short}_ref", "1.0D")

    return (
        rows.select(
            F.col("hhid").cast("string").alias("hhid"),
            *[F.col(name).alias(f"{short}_ai") for name, short in nutrients.items()],
            *[F.lit(requirements[name]).alias(f"{short}_ref") for name, short in nutrients.items()],
            "survey_id",
        )
        .withColumn(score, _mean([ratio(short) for short in nutrients.values()]))
    )


def multi_survey_targets(
    cons: DataFrame, fct: DataFrame, hh: DataFrame, zoned: tuple[str, ZoneOverride] | None = None
) -> DataFrame:
    """Adequacy targets of all surveys at once, from tables that carry a ``survey_id`` column; rows whose survey is NULL are a survey too.

    ``zoned`` names the one survey whose composition differs by zone, with its override. All surveys are priced by one layered lookup
    in one aggregation keyed by (survey, household).
    """
    layers = [Layer(fct, survey=F.col(SURVEY))]
    if zoned is not None:
        survey_id, override = zoned
        layers.insert(0, Layer(override.fct, F.lit(survey_id), override.zone))
        hh = na_join(hh, override.zones.select("hhid", F.col(override.zone).alias("zone")), "hhid", null_keys=False)
    lookup = CompositionLayers(layers, nutrients_of(fct, [SURVEY]))
    return adequacy_targets(lookup.intake(cons, hh, (SURVEY, "hhid"), F.col(SURVEY)))


def mar_export(
    intake: DataFrame,
    iso3: str,
    survey: str,
    requirements: dict[str, float] = REQUIREMENTS,
    nutrients: dict[str, str] = TARGET_NUTRIENTS,
) -> DataFrame:
    """Intakes of the target nutrients with the mean of their adequacy ratios, each capped at 1."""
    rows = intake.withColumns(
        {f"{short}_nar": F.col(name) / requirements[name] for name, short in nutrients.items()}
    )
    shorts = list(nutrients.values())
    ratios = column_range(rows, f"{shorts[0]}_nar", f"{shorts[-1]}_nar")
    capped = across(rows, ratios, lambda c: if_else(f"{c} > 1", "1.0D", c))
    return capped.select(
        F.lit(iso3).alias("iso3"),
        F.lit(survey).alias("survey"),
        "hhid",
        *nutrients,
        _mean([F.col(c) for c in ratios]).alias("overall_mar"),
    )


def requirement_nutrients(fct: DataFrame, requirements: dict[str, float] = REQUIREMENTS) -> list[str]:
    """Nutrients that have both a requirement and a composition column."""
    return [n for n in nutrients_of(fct) if n in requirements]
