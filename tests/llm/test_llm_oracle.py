"""Queries of the subpackage that SQL can express, against DuckDB on the smallest tables."""

import pytest

from conftest import SF_SMALL
from helpers import compare_with_sql, duck
from tidepool.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    compare_with_sql(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE[name])
