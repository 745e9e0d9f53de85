"""Registration of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workloads.inputs import Tables
from workloads.oracle import with_steps

FUNCTIONS: dict[str, Callable[[Tables], DataFrame]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str, name: str | None = None):
    """Register a function of ``Tables`` under its own name together with its SQL counterpart."""

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        FUNCTIONS[key] = fn
        QUERIES[key] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        ORACLE[key] = with_steps(sql)
        return fn

    return register
