"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import duckdb
import pytest

import __spark_entry__ as E
from tickerlens.plans.queries import QUERIES
from tools.compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_oracle_or_is_documented():
    rows_only = {"bow_train"}
    assert set(QUERIES) - set(E.oracle_sql()) == rows_only and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        docs = duck.execute("SELECT count(*) FROM documents").fetchone()[0]
        assert len(srows) == docs and {r[df.columns.index("pn")] for r in srows} <= {"P", "N"}
        return
    cur = duck.execute(sql)
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, srows) == rows_of(ocols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 16
