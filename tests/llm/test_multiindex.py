import random

import numpy as np
import pytest

from ledgerlens.llm import multiindex, queries

SCHEMA = "vec_id long, embedding array<float>, score double, rank int, cell int, block long, uid long, copies int"


def neighbours(rows, k=5, every=50):
    """Exact: query -> [(id, cosine)], best first, ties to the smaller id."""
    rows = [(i, np.array(x, dtype=float)) for i, x in rows
            if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    width = max((len(x) for _, x in rows), default=0)
    m = np.array([np.pad(x, (0, width - len(x))) for _, x in rows])
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    ids = np.array([i for i, _ in rows])
    out = {}
    for q in sorted({int(i) for i in ids if i % every == 0}):
        score = (u[ids == q] @ u.T).max(axis=0)
        at = sorted(np.flatnonzero(ids != q), key=lambda j: (-round(score[j], 12), ids[j]))[:k]
        out[q] = [(int(ids[j]), score[j]) for j in at]
    return out


def table(spark, rows, path):
    spark.createDataFrame([(i, x, 0.5, 1, 2, 3, 4, 5) for i, x in rows], SCHEMA).repartition(4).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def answers(spark, path):
    out = {}
    for r in sorted(queries.op13_nearest_neighbours(spark, path).collect()):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_recall_on_the_table(spark, sf):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, got = neighbours(rows), answers(spark, sf)
    hits = sum(len({i for _, i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    assert set(got) == set(want) and hits >= 0.9 * sum(map(len, want.values()))
    u = {i: np.array(x) / np.linalg.norm(x) for i, x in rows}
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 6)) and q not in [i for _, i, _ in found]
        assert [s for _, _, s in found] == sorted((s for _, _, s in found), reverse=True)
        assert all(abs(s - u[q] @ u[i]) < 1e-12 for _, i, s in found)


def test_clustered_vectors_meet_a_small_share(spark, tmp_path):
    r = np.random.default_rng(5)
    centres = r.normal(size=(60, 16))
    rows = [(i, (centres[i % 60] + 0.05 * r.normal(size=16)).tolist()) for i in range(6000)]
    sample = multiindex.unit(np.array([x for _, x in rows]))
    assert multiindex.Index(sample, 10, 5, 0.95).share < 0.3
    rows = [(i, np.float32(x).tolist()) for i, x in rows]
    want, got = neighbours(rows), answers(spark, table(spark, rows, tmp_path))
    hits = sum(len({i for _, i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_copies_ties_repeated_ids_and_vectors_without_a_part(spark, tmp_path):
    """A third of the rows is one vector; ties go to the smaller id; a row's copies under one id count each."""
    r = random.Random(2)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(r.randint(-3, 3)) for _ in range(3)]) for i in range(300)]
    rows += [(7, [1.0, 2.0, 3.0])] * 3 + [(0, [9.0, 0.0, 1.0])] + [(50, [1.0, 2.0, 3.0])] * 9
    rows += [(100, None), (301, [None, 1.0]), (302, [float("nan")] * 3), (303, [float("inf")] * 3), (None, [1.0] * 3), (304, []), (350, [0.0, 0.0, 0.0]),
             (305, [2.0]), (306, [2.0, 4.0, 6.0])]
    kept = [(i, x) for i, x in rows if x and i is not None and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    want = neighbours(kept)
    got = answers(spark, table(spark, rows, tmp_path))
    assert set(got) == set(want) == {0, 50, 100, 150, 200, 250}
    for q, w in want.items():
        assert [round(s, 9) for _, _, s in got[q]] == [round(s, 9) for _, s in w]
        if q in (50, 150):  # queries of the large group: its smallest other ids
            assert [i for _, i, _ in got[q]] == [i for i, _ in w]


def test_few_rows_and_none(spark, tmp_path):
    few = table(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])], tmp_path / "few")
    assert {q: [i for _, i, _ in w] for q, w in answers(spark, few).items()} == {0: [1, 2]}
    assert answers(spark, table(spark, [(0, [1.0])], tmp_path / "one")) == {}
    assert answers(spark, table(spark, [], tmp_path / "none")) == {}


def test_walk_meets_all_cells_in_order():
    r = np.random.default_rng(1)
    index = multiindex.Index(multiindex.unit(r.normal(size=(400, 8))), 9, 5, 0.9)
    for x in multiindex.unit(r.normal(size=(20, 8))):
        first, second = (d[0] for d in index.apart(x[None]))
        cells = list(index.walk(first, second))
        sums = [first[c // 9] + second[c % 9] for c in cells]
        assert sorted(cells) == list(range(81)) and all(a <= b + 1e-12 for a, b in zip(sums, sums[1:]))


@pytest.mark.parametrize("seed", range(20))
def test_blocks_are_bounded_and_cells_keep_their_own(seed):
    r = np.random.default_rng(seed)
    rows = r.integers(0, 30, size=r.integers(1, 60))
    first, parts = multiindex.blocks(rows, 10)
    held = {}
    for cell, (at, n) in enumerate(zip(first.tolist(), parts.tolist())):
        for block in range(at, at + n):
            held.setdefault(block, []).append(cell)
    for cells in held.values():
        full = [c for c in cells if rows[c]]
        assert len(full) <= 1 or sum(rows[c] for c in full) <= 10


def test_extreme_values_keep_their_cosine():
    x = np.array([[3e200, 4e200], [3e-200, 4e-200], [3.0, 4.0]])
    assert np.allclose(multiindex.cosine(multiindex.scaled(x), np.array([[4.0, 3.0]] * 3)), 24 / 25, atol=1e-15)
