import hashlib
import random

from pyspark.sql import functions as F

from ledgerlens.llm import fingerprints as P
from ledgerlens.llm import queries


def lanes(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["fp"] for r in P.with_fingerprint(df, "t", "fp").orderBy("i").collect()]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)


def check(got, rows):
    rows = in_order([(i, t or "") for i, t in rows])
    want = []
    for k, (i, t) in enumerate(rows):
        after, n = rows[(k + 1) % len(rows)][1], len(t)
        edited = t[: n - n // 3] + after[: n // 3]
        want.append((i, n, hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got], key=key) == sorted(want, key=key)


def test_query_against_brute_force(spark, sf, texts):
    got = queries.op3_fingerprints(spark, sf).collect()
    check(got, texts.items())
    by_fp = {}
    for r in got:
        by_fp.setdefault(r["fingerprint"], set()).add(texts[r["doc_id"]])
    assert all(len(v) == 1 for v in by_fp.values()) and len(by_fp) == len(set(texts.values()))
    assert sum(r["near_edited"] > r["near_next"] for r in got) > 0.95 * len(got)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))


def test_edge_rows(spark, edge, empty):
    # Without ids there is no order to follow from: those rows come last, by text.
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    check(P.edited_fingerprints(edge).collect(), rows)
    assert P.edited_fingerprints(empty).collect() == []
    one = edge.filter("doc_id = 1")
    assert [r["near_next"] for r in P.edited_fingerprints(one).collect()] == [1.0]


def test_many_borders_give_the_same_next(spark):
    r = random.Random(3)
    rows = [(r.randint(0, 400), f"text {i} " * r.randint(0, 4)) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = P.with_next(df, "doc_id", ["text"], every=4).collect()
    order = in_order(rows)
    want = sorted((i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))
    assert sorted(map(tuple, got)) == want


def test_paragraphs_add_up_in_any_order(spark):
    a, b, c = "One. Two, three\nnext line", "middle\n\nparagraph here", "last one. End"
    whole, mixed, fa, fb, fc = lanes(spark, [f"{a}\n{b}\n{c}", f"{c}\n{a}\n{b}", a, b, c])
    assert whole == mixed
    df = spark.createDataFrame([(whole, fa, fb, fc)], "w array<long>, a array<long>, b array<long>, c array<long>")
    r = df.select(P.combine([F.col("a"), F.col("b"), F.col("c")]).alias("sum"), P.remove(F.col("w"), F.col("b")).alias("less"),
                  P.add(F.col("a"), F.col("c")).alias("ac")).first()
    assert r["sum"] == whole and r["less"] == r["ac"]


def test_texts_that_differ_anywhere_differ(spark):
    texts = ["a b", "a  b", "a b ", "a\nb", "a\n\nb", "A b", "", "\n", " ", "a b\na b"]
    assert len({tuple(x) for x in lanes(spark, texts)}) == len(texts)


def test_likeness_follows_shared_phrases(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base = [f"{word()} {word()}." for _ in range(300)]
    share = {0.0: base, 0.25: base[:225], 0.5: base[:150]}
    for lost, kept in share.items():
        fill = [f"{word()} {word()}." for _ in range(300 - len(kept))]
        x, y = lanes(spark, [" ".join(base), " ".join(kept + fill)])
        df = spark.createDataFrame([(x, y)], "x array<long>, y array<long>")
        got = df.select(P.likeness(F.col("x"), F.col("y"))).first()[0]
        assert abs(got - (1 - lost)) < 0.35
