"""Queries against their DuckDB SQL, on whole tables."""

import pytest

from millrace.llm import queries
from oracle.compare import compare, duck

SF = "/root/testdata/sf0.001"
ORACLES = queries.all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_operator_is_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.all_queries() if k.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries.all_queries()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, con, key):
    r = compare(queries.all_queries()[key](spark, SF), con, ORACLES[key])
    assert r["ok"], r
