"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from quern.plans.oracle import all_sql
from quern.plans.queries import all_queries
from tools.check import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_sql(spark, duck, name):
    mine = all_queries()[name](spark, FOLDER).toPandas()
    other = duck.execute(all_sql()[name]).df()
    assert difference(mine, other) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10
