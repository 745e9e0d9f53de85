"""Missing-value and floating-point rules shared by every operator.

NULL is the only missing value in this engine. Floating-point NaN is turned into NULL wherever a source or an arithmetic
step can produce it, because Spark orders NaN above every number and lets it poison sums. Infinities are kept.

Arguments are column names or SQL expressions. A rule is one parsed expression rather than a tree of column calls, which
keeps plans over many nutrient columns quick to build.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(x: str) -> Column:
    """The value, or NULL where it is NaN."""
    return F.expr(f"nanvl({x}, CAST(NULL AS DOUBLE))")


def is_missing(x: str) -> Column:
    """True for NULL and for NaN."""
    return F.expr(f"({x}) IS NULL OR isnan({x})")


def if_else(condition: str, yes: str, no: str) -> Column:
    """Two-branch conditional whose result is NULL when the condition is NULL (unlike ``when/otherwise``)."""
    return F.expr(f"CASE WHEN {condition} THEN {yes} WHEN NOT ({condition}) THEN {no} END")


def safe_div(numerator: str, denominator: str) -> Column:
    """Division with IEEE results for a zero divisor: signed infinity, and NULL for 0/0."""
    n, d = f"double({numerator})", f"double({denominator})"
    return F.expr(
        f"CASE WHEN {d} = 0 THEN CASE WHEN {n} > 0 THEN double('Infinity') WHEN {n} < 0 THEN double('-Infinity') END"
        f" ELSE nanvl({n} / {d}, CAST(NULL AS DOUBLE)) END"
    )


def times(a: str, b: str) -> Column:
    """Product in double precision; infinity times zero is NULL."""
    return F.expr(f"nanvl(double({a}) * double({b}), CAST(NULL AS DOUBLE))")


def log10_ieee(x: str) -> Column:
    """Base-10 logarithm with -Infinity at zero and NULL below it and for NaN."""
    return F.expr(f"CASE WHEN isnan({x}) THEN NULL WHEN {x} = 0 THEN double('-Infinity') WHEN {x} > 0 THEN log10({x}) END")


def sum_or_zero(x: str) -> Column:
    """Sum that skips missing values and is 0 when nothing is left."""
    return F.expr(f"coalesce(sum({x}), 0.0D)")


def count_where(condition: str) -> Column:
    """Number of rows where the condition holds."""
    return F.expr(f"count_if({condition})")


def to_number(x: str) -> Column:
    """Text to double; unparseable text and NaN become NULL."""
    return F.expr(f"nanvl(try_cast({x} AS DOUBLE), CAST(NULL AS DOUBLE))")


def to_integer(x: str, kind: str) -> Column:
    """Text to an integer type; ``3.0`` and ``1e5`` are integers too, text that is none becomes NULL."""
    number = f"try_cast({x} AS DOUBLE)"
    return F.expr(f"coalesce(try_cast({x} AS {kind}), CASE WHEN {number} = floor({number}) THEN try_cast({number} AS {kind}) END)")


def round_half_even(x: str, digits: int = 1) -> Column:
    return F.expr(f"bround({x}, {digits})")
