"""Every query with SQL against it, over whole tables."""

import pytest

from distriq.plans import parsing, preparation, relational
from tests.helpers import rows_of, sql_rows

DIRECTORY = "/root/testdata/sf0.001"
CASES = [(name, m.QUERIES[name], m.ORACLE_SQL[name]) for m in (preparation, relational, parsing) for name in m.QUERIES if name in m.ORACLE_SQL]


@pytest.mark.parametrize(("name", "run", "sql"), CASES, ids=[c[0] for c in CASES])
def test_query_equals_sql(spark, name, run, sql):
    assert rows_of(run(spark, DIRECTORY)) == sql_rows(sql, DIRECTORY)


def test_entry_has_rows(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["child_table", "period", "kind", "n_orphans"]
    assert df.count() > 0


def test_names_of_sql_are_names_of_queries():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
