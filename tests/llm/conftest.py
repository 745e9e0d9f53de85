from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import llm_cases  # noqa: E402


@pytest.fixture(scope="session")
def cases(spark):
    return spark.createDataFrame(llm_cases.texts(), llm_cases.SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], llm_cases.SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
