import pytest

from distriq.llm import queries
from tests.helpers import rows_of, sql_rows

DIRECTORY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert rows_of(queries.QUERIES[name](spark, DIRECTORY)) == sql_rows(queries.ORACLE_SQL[name], DIRECTORY)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, DIRECTORY).count() > 0
