"""Registered queries against their oracle SQL on the smallest data.

Of families that write and stream files or have very many keys the first one runs; ``CHART_ALL=1``
runs all of them.
"""

from __future__ import annotations

import os
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks import load_checks, operator_checks, oracle_queries, spark_queries
from checks.compare import connect, differences

SF = "/root/testdata/sf0.001"
SLOW = ("s1_", "s2_", "s4_", "s5_", "x1_", "x2_", "x3_", "c8_", "c11_", "v", "g9_", "k", "a", "l", "p")
WITH_SQL = [k for k in queries() if k in oracle_sql()]
FIRST = {next(k for k in WITH_SQL if k.startswith(prefix)) for prefix in SLOW}
KEYS = [
    k for k in WITH_SQL if os.environ.get("CHART_ALL") or k in FIRST or not k.startswith(SLOW)
]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) <= set(queries())
    assert set(spark_queries.QUERIES) == set(oracle_queries.ORACLE)
    for part in (load_checks.CHECKS, operator_checks.CHECKS):
        assert set(part.QUERIES) == set(part.ORACLE)


def test_entry(spark):
    assert entry(spark).count() == 20


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, con, key):
    assert differences(queries()[key](spark, SF), con, oracle_sql()[key]) == ""
