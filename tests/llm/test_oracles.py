import duckdb
import pytest

from ledgerlens.llm import queries

TABLES = "documents embeddings pages labels".split()


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.sql(queries.oracle_sql()[key])
    got = queries.queries()[key](spark, sf)
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    rows = sorted(tuple(r[c] for c in order) for r in got.collect())
    assert rows == sorted(tuple(r[want.columns.index(c)] for c in order) for r in want.fetchall())
