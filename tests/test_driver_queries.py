"""Every registered driver query against its DuckDB oracle (small scale)."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lodgeflow.plans.catalog import QUERIES

from .conftest import SMALL_SF
from .helpers import assert_same

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SMALL_SF)
    assert_same(df, con, oracle_sql()[name])


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() >= 0
    assert "active_listing_rate" in df.columns
