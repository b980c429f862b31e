"""Every registered query against DuckDB on the test tables."""

import pytest

from compare import difference, duck
from conftest import SF_DIR
from tickbars.registry.oracle import ORACLE
from tickbars.registry.queries import QUERIES
import __spark_entry__ as entry_point


@pytest.fixture(scope="module")
def database():
    connection = duck(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert difference(frame, database, ORACLE[name]) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry_gives_bars(spark):
    assert entry_point.entry(spark).count() == 228
