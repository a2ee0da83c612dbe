"""Every registered query against its SQL, over whole tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks import ORACLES, QUERIES
from compare import TABLES, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= queries().items() and ORACLES.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sql, name):
    got = QUERIES[name](spark, SF)
    want = sql.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
