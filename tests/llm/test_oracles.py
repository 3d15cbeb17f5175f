"""Corpus queries against their SQL, and the contract of their columns."""

from __future__ import annotations

import pytest

from __spark_entry__ import CORPUS_ORACLES, CORPUS_QUERIES
from tests.compare import differences, duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CORPUS_ORACLES))
def test_same_as_sql(spark, name):
    assert differences(spark, duck(SMALL), SMALL, name) is None


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in CORPUS_QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in CORPUS_QUERIES
