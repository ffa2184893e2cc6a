"""Every registered query that has SQL gives the same rows, on the smallest test tables."""

import os

import pytest

import verification
from verification.check import TABLES, as_rows

SF_DIR = "/root/testdata/sf0.001"
verification.load()
# streams and whole pipelines take long; the others show that each operator matches its SQL
SLOW = ("stream_", "etl_")
NAMES = [name for name in verification.ORACLES if not name.startswith(SLOW)]


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not there")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(verification.ORACLES) <= set(verification.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_sql(spark, sql, name):
    got, want = verification.QUERIES[name](spark, SF_DIR).toPandas(), sql.execute(verification.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert as_rows(got) == as_rows(want)


def test_entry_runs(spark):
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() > 0
