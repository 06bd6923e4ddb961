"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from meterline.plans import oracle
from meterline.plans.queries import registered
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"
QUERIES, SQL = registered(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, duck.sql(SQL[name])) is None
    assert df.columns, name


def test_entry_is_stable(spark):
    df = entry.entry(spark)
    assert df.columns == ["zone_id", "window_end", "trip_count", "revenue"]
    assert df.count() > 0
