"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from siltworks.llm.queries import QUERIES, SQL


def compare(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    wanted = con.execute(SQL[name])
    columns = [c[0] for c in wanted.description]
    found = QUERIES[name](spark, folder)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in found.select(*columns).collect()))) == sorted(map(repr, wanted.fetchall()))


@pytest.mark.parametrize("name", SQL)
def test_whole_tables(spark, name):
    compare(spark, "/root/testdata/sf0.001", name)
