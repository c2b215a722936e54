"""Every registered query against its SQL, whole results."""

import pytest

import __spark_entry__ as entry_module
from tests.compare import differences, tables
from tickloom.plans.queries import QUERIES as MARKET

QUERIES = {name: query for name, query in entry_module.queries().items() if name in MARKET}
ORACLE = {name: sql for name, sql in entry_module.oracle_sql().items() if name in MARKET}


def test_every_query_has_sql():
    assert set(QUERIES) == set(MARKET) == set(ORACLE)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = tables(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert len(got) > 0
    assert differences(got, duck.execute(ORACLE[name]).df()) is None


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["symbol", "window_start", "window_end", "weighted_price_sum", "volume_sum", "vwap"]
    assert df.count() > 0
