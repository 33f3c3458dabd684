"""Every registered query against its DuckDB oracle (sf0.001 by default;
``python tests/oracle_harness.py`` runs the same check at sf0.01)."""

import pytest

import __spark_entry__ as E
from rosterline import plans
from oracle_harness import compare, duck

KEYS = list(plans.queries())
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in plans.queries()}


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_key_has_an_oracle():
    # the only keys without SQL would be non-SQL operators; there are none yet
    assert set(KEYS) == set(ORACLE)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, con, key):
    ok, msg = compare(spark, key, E.queries()[key], ORACLE.get(key), sf_small, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 27
    assert "account" in df.columns and "factory" in df.columns
