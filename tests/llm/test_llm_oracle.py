"""Text queries against DuckDB on the test tables."""

import pytest

from compare import difference, duck
from conftest import SF_DIR
from tickbars.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    connection = duck(SF_DIR)
    assert difference(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) is None
    connection.close()
