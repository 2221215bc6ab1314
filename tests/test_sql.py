"""Every query that has SQL agrees with it on the tables."""

import pytest

from pressmill.plans.catalog import QUERIES, SQL
from tests.oracle import agree


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, medium, name):
    agree(spark, medium, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
