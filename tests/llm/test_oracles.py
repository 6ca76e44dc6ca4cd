"""Queries whose result DuckDB SQL can express, side by side on sf0.001."""
import duckdb
import pytest

from tickerlens.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(SQL[name])
    cols = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    assert sorted(map(repr, map(tuple, got.select(cols).collect()))) == sorted(map(repr, want.project(", ".join(cols)).fetchall()))
