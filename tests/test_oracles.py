"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from skyledger.catalog.oracles import ORACLES
from skyledger.catalog.queries import REGISTRY
from tests.compare import differences, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_same_as_sql(spark, engine, name):
    assert differences(spark, engine, SMALL, name) is None


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLES)


def test_entry(spark):
    rows = entry(spark).collect()
    assert sum(r["row_count"] for r in rows) == 1000
    assert abs(sum(r["percentage"] for r in rows) - 100) < 0.05
