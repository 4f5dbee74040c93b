import math
import random

import duckdb
import numpy as np

from ledgerlens.llm import oracle, queries, topk


def brute(rows, k=10, scale=1024, every=100):
    v = [(i, [math.floor(scale * float(c)) for c in x]) for i, x in rows
         if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = set()
    for q in {i for i, _ in v if i % every == 0}:
        score = sorted((-sum(a * b for a, b in zip(x, y)), j) for i, x in v if i == q for j, y in v if j != q)
        out |= {(q, rank, j, -s) for rank, (s, j) in enumerate(score[:k], 1)}
    return out


def test_query_against_brute_force(spark, sf):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.op10_topk_search(spark, sf).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(brute(rows))


def test_edge_rows_ties_and_blocks(spark):
    r = random.Random(4)
    rows = [(i, [float(r.randint(-2, 2)) / 4 for _ in range(5)]) for i in range(0, 700, 7)]
    rows += [(100, None), (203, [None, 1.0]), (204, [float("nan")] * 5), (205, [float("inf")] * 5), (None, [1.0] * 5), (206, []), (207, [2.0, 2.0])]
    rows += rows[:20] + [(0, [9.0, 9.0, 9.0, 9.0, 9.0])]
    df = spark.createDataFrame([(i, x, "q", 1) for i, x in rows], "vec_id long, embedding array<float>, q string, rank int").repartition(5)
    for blocks in (8, 16384):
        got = topk.top_k(df, block_rows=blocks, block_queries=2).collect()
        assert {tuple(x) for x in got} == brute(rows) and len(got) == len(brute(rows))
    assert topk.top_k(df.limit(0)).collect() == []
    few = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (2, [1.0])], "vec_id long, embedding array<float>")
    assert [tuple(x) for x in topk.top_k(few).orderBy("rank").collect()] == [(0, 1, 1, 1048576), (0, 2, 2, 1048576)]


def test_repeated_ids_equal_the_sql(spark, tmp_path):
    """Different vectors under one id are candidates of their own; a query's own id never is."""
    r = random.Random(8)
    rows = [(i % 140, [float(r.randint(-9, 9)) / 8 for _ in range(4)]) for i in range(420)] + [(7, [1.0, 1.0, 1.0, 1.0])] * 200
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    df.coalesce(1).write.parquet(str(tmp_path / "e"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/e/*.parquet')")
    want = sorted(con.sql(oracle.TOP_K).select("query_id, rank, vec_id, score").fetchall())
    for block in (16, 16384):
        assert sorted(map(tuple, topk.top_k(df, block_rows=block, block_queries=3).collect())) == want


def test_block_search_with_negative_and_large_numbers():
    r = np.random.default_rng(1)
    x = r.integers(-90_000, 100_000, (300, 9))
    ids = r.permutation(1000)[:300].astype(np.int64)
    got = {}
    for q, i, s in topk.search_block(ids, x, ids[:15], x[:15], 7):
        got.setdefault(q, set()).add((i, s))
    for n, q in enumerate(ids[:15].tolist()):
        score = sorted(((-int(x[j] @ x[n]), int(ids[j])) for j in range(300) if j != n))[:7]
        assert got[q] == {(i, -s) for s, i in score}
