"""Queries that have DuckDB SQL, over the whole smallest tables."""

import duckdb
import pytest

from lodgeflow.llm.oracle_sql import ORACLE
from lodgeflow.llm.queries import QUERIES

from ..conftest import SMALL_SF
from ..helpers import assert_same


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL_SF}/{table}.parquet')")
    assert_same(QUERIES[name](spark, SMALL_SF), con, ORACLE[name])
