"""Helpers over lists of column names."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.missing import to_number


def others(df: DataFrame, known: Iterable[str]) -> list[str]:
    """Every column of ``df`` that is not in ``known``, in order."""
    known = set(known)
    return [c for c in df.columns if c not in known]


def first_columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns first, then the rest in their order."""
    return df.select(*names, *others(df, names))


def ending_with(df: DataFrame, suffix: str) -> list[str]:
    """Columns whose name ends with ``suffix``, ignoring case."""
    return [c for c in df.columns if c.lower().endswith(suffix.lower())]


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """The columns from ``first`` to ``last`` by position, both included."""
    names = df.columns
    return names[names.index(first) : names.index(last) + 1]


def across(df: DataFrame, names: Iterable[str], fn: Callable[[str], Column], rename: str = "{col}") -> DataFrame:
    """Apply ``fn`` to many columns, given by name, in one projection; ``rename`` gives the new names."""
    return df.withColumns({rename.format(col=c): fn(c) for c in names})


def cast_numbers(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    """Turn every column but ``keep`` into a number, unparseable text into NULL."""
    return across(df, others(df, keep), to_number)


def _literal(value) -> str:
    if not isinstance(value, str):
        return str(value)
    text = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def recode(x: str, mapping: dict, default: str | None = None) -> Column:
    """Replace listed values; anything else becomes the expression ``default`` (NULL when not given)."""
    cases = " ".join(f"WHEN {_literal(old)} THEN {_literal(new)}" for old, new in mapping.items())
    return F.expr(f"CASE {x} {cases} ELSE {default or 'NULL'} END")
