"""Every registered query against its SQL, whole results."""

import pytest

import __spark_entry__ as registry
from oracle.compare import connect, differences

QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(registry.BUILD) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(registry.BUILD))
def test_matches_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == []


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() > 0
