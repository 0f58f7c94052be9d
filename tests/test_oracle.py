"""Every catalog query with an oracle equals its DuckDB SQL (sf0.001 here;
the driver runs the same pairs at sf0.01, see tests/oracle_harness.py)."""

import pytest

from conftest import SF_SMALL
from emberflow.plans.catalog import QUERIES
from emberflow.plans.oracle import SQL
from oracle_harness import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert r["ok"], r.get("why")


def test_every_query_runs_and_keeps_schema(spark):
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.columns == ["dt", "tm_name", "order_amount", "rk"]
    assert df.count() > 0
    for name in sorted(set(QUERIES) - set(SQL)):
        assert QUERIES[name](spark, SF_SMALL).count() >= 0
