"""Fixtures of the training-data operators' tests."""

from __future__ import annotations

import pytest

from odd_rows import make_docs, odd_rows
from strata.llm.queries import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    return make_docs(spark, odd_rows())


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])
