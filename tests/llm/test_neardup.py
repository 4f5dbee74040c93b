import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import neardup as N
from ledgerlens.llm import queries


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, width):
    w = words(text)
    return frozenset(tuple(w[i: i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def groups(rows, width, percent=80):
    """(set size, smallest id of the component) of each row, by comparing all."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= percent * (len(a) + len(b) - n):
                    root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, len(sets[i]), least.get(find(i))) for i, (k, _) in enumerate(rows)]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def result(df):
    rows = df.collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=key)


def test_query_against_all_pairs(spark, sf, texts):
    assert result(queries.op4_near_duplicates(spark, sf)) == sorted(groups(list(texts.items()), 2), key=key)


def test_edge_rows(spark, edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert result(N.link(edge)) == sorted(groups(rows, 5), key=key)
    assert N.link(empty).collect() == []


@pytest.fixture(scope="module")
def crowd(spark, tmp_path_factory):
    """A crowd of edits of one text around the threshold, copies and strangers."""
    r = random.Random(5)
    base = [f"w{r.randint(0, 900)}" for _ in range(60)]
    rows = []
    for i in range(260):
        own = list(base)
        for _ in range(r.choice([1, 2, 3, 4, 5, 6])):
            own[r.randrange(60)] = f"x{r.randint(0, 10 ** 6)}"
        rows.append((i * 3 + 1, " ".join(own)))
    rows += [(5000 + i, rows[i % 7][1].upper() + "  ") for i in range(60)]
    rows += [(9000 + i, " ".join(f"v{r.randint(0, 10 ** 6)}" for _ in range(30))) for i in range(40)]
    path = str(tmp_path_factory.mktemp("crowd") / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(path)
    return spark.read.parquet(path), rows


def test_a_crowd_loses_no_link(crowd):
    df, rows = crowd
    assert result(N.link(df, width=2)) == sorted(groups(rows, 2), key=key)


def test_word_and_shingle_hashes_follow_words_only():
    a, b, c = N.shingle_sets(["The  cat\tsat On\n", "the cat SAT on", "the cat sat on é"], 2)
    assert (a == b).all() and len(c) == 4 and np.isin(a, c).all()
    x, y, z = N.shingle_sets(["one", "ONE ", ""], 5)
    assert (x == y).all() and len(x) == 1 and len(z) == 0
    long = " ".join(f"w{i}" for i in range(500_000))  # cut into several parts inside
    (s,) = N.shingle_sets([long], 2)
    assert len(s) == 499_999


def test_components_of_chains_stars_and_rings(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 160)] + [(200 + i, 200 + (i + 1) % 30) for i in range(30)]
    edges += [(300 + r.randint(0, 80), 300 + r.randint(0, 80)) for _ in range(60)]
    name = {i: bytes([r.randint(0, 255) for _ in range(6)]) + i.to_bytes(2, "big") for i in range(400)}
    df = spark.createDataFrame([(name[a], name[b]) for a, b in edges if a != b], "a binary, b binary")
    got = {bytes(x["node"]): bytes(x["root"]) for x in N.components(df).collect()}
    root = dict.fromkeys(range(400))
    for i in root:
        root[i] = i
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert set(got) == {name[i] for i in nodes}
    assert all((got[name[a]] == got[name[b]]) == (root[a] == root[b]) for a in nodes for b in nodes)


def test_extra_columns_do_not_clash(spark, edge):
    named = edge.withColumns({c: F.lit("x") for c in ("a", "b", "sig", "root", "near", "id", "u", "v")})
    assert N.link(named.filter("doc_id < 4")).count() == edge.filter("doc_id < 4").count()


@pytest.fixture(scope="module")
def template(spark, tmp_path_factory):
    """A template most documents share below the threshold, and planted pairs above it."""
    r = random.Random(8)
    base = [f"w{i}" for i in range(80)]

    def edited(words, n, tag):
        own = list(words)
        for k, i in enumerate(r.sample(range(0, 80, 2), n)):
            own[i] = f"{tag}x{k}"
        return own

    # Five edits of their own: any two are at most 69 / 89 alike, an edited copy is at least 71 / 87 like its first.
    texts = [edited(base, 5, f"a{i}") for i in range(1500)]
    texts += [edited(t, 4, f"b{i}") for i, t in enumerate(texts[:600])]
    rows = list(enumerate(" ".join(t) for t in texts))
    path = str(tmp_path_factory.mktemp("template") / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(path)
    return spark.read.parquet(path), rows


def test_pairs_inside_a_template_crowd_are_found(template):
    df, rows = template
    assert result(N.link(df, width=2)) == [(i, 79, i if i < 1500 else i - 1500) for i, _ in rows]


def test_blocks_of_a_shared_shingle_lose_no_pair(template, monkeypatch):
    """Every shingle's sets meet in many pairs of blocks."""
    df, rows = template
    monkeypatch.setattr(N, "MEET", 7)
    monkeypatch.setattr(N, "SALTS", 5)
    assert result(N.link(df, width=2)) == [(i, 79, i if i < 1500 else i - 1500) for i, _ in rows]


def test_node_holds_the_size_of_its_set():
    def size(n):
        return int.from_bytes(N.node_of(np.arange(n, dtype=np.uint64))[-2:], "big")

    sizes = np.array([size(n) for n in range(1, 400)])
    assert (np.diff(sizes) >= 0).all() and size(0) == size(1) == 0 and len(N.node_of(np.arange(3, dtype=np.uint64))) == 16
    for percent in (65, 80):
        for n in range(1, 400):
            m = np.arange(1, 400)
            can = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            fits = N.alike_in_size(sizes[n - 1], sizes[m - 1], percent)
            assert fits[can].all() and not fits[100 * np.minimum(n, m) < (percent - 1) * np.maximum(n, m)].any()


def test_rows_without_an_id_keep_their_links(spark, tmp_path):
    r = random.Random(4)
    rows = []
    for i in range(40):
        own = [f"w{r.randint(0, 10 ** 6)}" for _ in range(50)]
        edit = [*own[:-1], f"x{i}"]
        rows += [(None, " ".join(own)), (i if i % 2 else None, " ".join(edit)), (None, " ".join(own))]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    got = result(N.link(spark.read.parquet(path)))
    assert got == sorted(groups(rows, 5), key=key) and sum(c is not None for _, _, c in got) == 60


def test_regions_cut_by_a_border_count_as_crowds():
    tree, keys = np.zeros(6, dtype=np.int32), np.zeros((6, N.DEPTH), dtype=np.int64)
    keys[3:, 0] = 1
    assert [x.tolist() for x in N.neighbours(tree, keys)][2] == []
    assert N.neighbours(tree, keys, True, False)[2].tolist() == [0, 1, 2]
    assert N.neighbours(tree, keys, False, True)[2].tolist() == [3, 4, 5]
    assert N.neighbours(tree[:1], keys[:1], True, False)[2].tolist() == [0]


def test_long_texts_are_cut_at_the_contracts_white_space_only():
    r = random.Random(9)
    long = ["".join(r.choices("abcXYZé", k=n)) for n in (1_200_000, 600_000, 499_999, 500_001)]
    nbsp = "\u00a0".join(["ab"] * 400_000)
    texts = [long[0], " ".join(long), None, nbsp + " end", "x " + long[3] + "\t" + nbsp + "\u3000y z"]
    got = list(N.shingle_sets(texts, 1))
    assert [len(s) for s in got] == [1, 4, 0, 2, 4]
    assert np.isin(got[0], got[1]).all()
    alone = [next(N.shingle_sets([w], 1))[0] for w in long]
    assert len(set(alone)) == 4 and (np.sort(np.array(alone)) == got[1]).all()
    assert next(N.shingle_sets(["A" * 700_000 + " b"], 1)).tolist() == next(N.shingle_sets(["b " + "a" * 700_000], 1)).tolist()
    assert next(N.shingle_sets(["a" * 700_000], 1)).tolist() != next(N.shingle_sets(["a" * 700_001], 1)).tolist()
