"""Data checks: queries that return the offending rows, and counts of them that ride on the write of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def negative_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where any of the columns is below zero (none are expected)."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns]))


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys of a lookup that occur more than once, and so would multiply rows in a join."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows with a NULL in the key."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key]))


@dataclass(frozen=True)
class Check:
    """Rows for which ``condition`` (SQL) holds are offending. More than ``limit`` of them are an error; None only reports."""

    name: str
    condition: str
    limit: int | None = None

    def count(self) -> Column:
        return F.expr(f"count_if({self.condition})").alias(self.name)


class CheckFailed(ValueError):
    """A table had more offending rows than its limits allow; ``counts`` has all counts of the table."""

    def __init__(self, label: str, counts: dict[str, int], broken: list[str]):
        super().__init__(f"{label}: " + ", ".join(f"{name} {counts[name]}" for name in broken) + f" of {counts['rows']} rows")
        self.label, self.counts = label, counts


def enforce(label: str, checks: Sequence[Check], counts: Mapping[str, int]) -> dict[str, int]:
    """The counts of a table that has been written; raises if a limit is exceeded."""
    found = dict(counts)
    broken = [c.name for c in checks if c.limit is not None and found[c.name] > c.limit]
    if broken:
        raise CheckFailed(label, found, broken)
    return found


def not_negative(columns: Sequence[str], limit: int | None = 0) -> list[Check]:
    return [Check(f"negative_{c}", f"`{c}` < 0", limit) for c in columns]


def key_known(columns: Sequence[str], limit: int | None = 0) -> list[Check]:
    return [Check(f"null_{c}", f"`{c}` IS NULL", limit) for c in columns]


COPY = "__copy"


def numbered_copies(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """A lookup whose rows are numbered within their key, for ``key_unique``; takes one exchange of the lookup by its key."""
    return df.withColumn(COPY, F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0))))


def key_unique(limit: int | None = 0) -> Check:
    """Rows beyond the first of their key, of a lookup that ``numbered_copies`` has numbered."""
    return Check("repeated_key", f"{COPY} > 1", limit)
