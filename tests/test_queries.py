import pytest

import __spark_entry__ as entry
from tests.oracle import connection, same

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connection(sf_dir)


@pytest.mark.parametrize("name", sorted(n for n in SQL if n in QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    same(QUERIES[name](spark, sf_dir), duck, SQL[name])


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
