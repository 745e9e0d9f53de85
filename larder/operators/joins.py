"""Joins in which a missing key matches a missing key."""

from __future__ import annotations

from collections.abc import Collection, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def na_join(
    left: DataFrame, right: DataFrame, on, how: str = "left", null_keys: bool | Collection[str] = True
) -> DataFrame:
    """Equi-join that keeps the left key columns and adds the right non-key columns.

    ``on`` is a name, or a list of names and (left, right) pairs. NULL keys match each other; pass ``null_keys=False``
    when the right side holds no NULL key, or the left names of those that it may hold NULLs in, which gives the same rows from
    plain equality and lets the join share its hash partitioning with a neighbouring ``groupBy`` or the buckets of a stored
    table. No broadcast hint is set: Catalyst picks the strategy from the sizes.
    """
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in ([on] if isinstance(on, str) else on)]
    renamed = {rk: f"__right_{rk}" for _, rk in pairs}
    extra = [c for c in right.columns if c not in renamed]
    clash = set(extra) & set(left.columns)
    if clash and how not in ("left_anti", "left_semi"):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    keyed = right.withColumnsRenamed(renamed)
    if how in ("left_anti", "left_semi"):
        keyed = keyed.select(*renamed.values())

    def matches(lk: str, rk: str):
        l, r = F.col(lk), F.col(renamed[rk])
        return l.eqNullSafe(r) if null_keys is True or (null_keys and lk in null_keys) else l == r

    joined = left.join(keyed, reduce(lambda a, b: a & b, [matches(lk, rk) for lk, rk in pairs]), how)
    return joined.drop(*renamed.values())


#: Rows without a key that a lookup may hold in ``na_lookup``.
MOST_WITHOUT_KEY = 1000


def na_lookup(left: DataFrame, right: DataFrame, on: str, most: int = MOST_WITHOUT_KEY) -> DataFrame:
    """As ``na_join`` on one key, sharing the partitioning of the key with groupings and joins around it.

    ``na_join`` compares NULL keys through two derived keys, which no ``groupBy`` of the key shares, so the join of two aggregates takes four
    exchanges. Here rows with a key join by plain equality, and rows without one meet the lookup's rows without one, which arrive as a scalar: two
    exchanges. More than ``most`` such rows in the lookup are an error.
    """
    extra = [c for c in right.columns if c != on]
    clash = set(extra) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    key, entry = "__right_key", F.struct(*[F.col(f"`{c}`") for c in extra])
    keyed = right.withColumnRenamed(on, key)
    without = keyed.filter(F.col(key).isNull()).limit(most + 1).select(F.collect_list(entry).alias("rows"))
    too_many = F.raise_error(F.lit(f"the lookup has over {most} rows without {on}"))
    checked = without.select(F.when(F.size("rows") > most, too_many.cast(without.schema["rows"].dataType)).otherwise(F.col("rows"))).scalar()
    joined = left.join(keyed.filter(F.col(key).isNotNull()), F.col(on) == F.col(key), "left")
    own = F.array(entry)
    met = F.when(F.col(on).isNull(), F.when(F.size(checked) > 0, checked).otherwise(own)).otherwise(own)
    rows = joined.withColumn("__met", F.explode(met))
    return rows.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col("__met")[c].alias(c) for c in extra])


#: Rows of a lookup that Catalyst may broadcast. It goes by the size of compressed files, and every task counts each of its broadcasts whole.
MOST_BROADCAST = 100_000


def spread(lookup: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """``lookup`` as the right side of a join: dealt by its key, to be hashed part by part, if it has over ``most`` rows; else as it is."""
    return lookup.hint("shuffle_hash") if lookup.select(F.lit(1)).limit(most + 1).count() > most else lookup


def na_entries(left: DataFrame, right: DataFrame, on: str, *looks: tuple[str, str, dict[str, str]]) -> DataFrame:
    """Successive left ``na_join``s with one lookup, on ``on`` and one more column each, in one join.

    A look is (left column, right column, {column to add: its new name}). The lookup comes as one row per ``on`` with the list of its rows, so
    that looks by different columns need no exchange beyond that of ``on``, which joins on ``on`` before and after share.
    """
    added = [name for _, _, names in looks for name in names.values()]
    clash = set(added) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    used = dict.fromkeys(c for _, key, names in looks for c in (key, *names))

    def matching(lk: str, rk: str):
        return F.filter("__entries", lambda entry: entry[rk].eqNullSafe(F.col(lk)))

    nested = right.groupBy(on).agg(F.collect_list(F.struct(*used)).alias("__entries"))
    rows = na_join(left, spread(nested), on)
    for lk, rk, names in looks:
        rows = rows.withColumn("__met", F.explode_outer(matching(lk, rk))).withColumns({new: F.col("__met")[c] for c, new in names.items()}).drop("__met")
    return rows.drop("__entries")


def without_keys(
    df: DataFrame, key_sets: Iterable[DataFrame], on: list[str], null_keys: bool | Collection[str] = True
) -> DataFrame:
    """Rows of ``df`` whose key is in none of the sets: one anti join against the union of the keys."""
    keys = reduce(DataFrame.unionByName, [s.select(*on) for s in key_sets])
    return na_join(df, keys, on, "left_anti", null_keys)


def union_by_name(*parts: DataFrame) -> DataFrame:
    """Union of any number of tables by column name, missing columns filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def override_union(primary: DataFrame, secondary: DataFrame, key: str | list[str]) -> DataFrame:
    """``primary`` plus the ``secondary`` rows whose key it lacks."""
    return union_by_name(primary, na_join(secondary, primary, key, "left_anti"))
