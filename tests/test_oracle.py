"""Every registered query against its DuckDB SQL on sf0.001 (the driver gate runs sf0.01)."""

import pytest

import __spark_entry__ as entry
from tidepool.plans.registry import QUERIES as LIBRARY
from conftest import SF_SMALL
from helpers import compare_with_sql, duck

# the optional subpackage's queries have their own tests
QUERIES = {k: v for k, v in entry.queries().items() if k in LIBRARY}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in LIBRARY}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    compare_with_sql(QUERIES[name](spark, SF_SMALL), con, SQL[name])


def test_every_query_has_oracle_or_is_listed():
    # queries without SQL get the weaker rows-only check; keep that set explicit
    assert set(QUERIES) - set(SQL) == set()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "view_count"]
    assert df.count() > 0
