import math
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import mixing as M
from ledgerlens.llm import queries

SIZE = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes, weights=(5, 2, 1), most=3.0):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, out = set(), {}
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        free = [s for s in names if s not in stopped]
        out = {s: most * sizes[s] if s in stopped else left * weight[s] / sum(weight[f] for f in free) for s in names}
        above = {s for s in free if out[s] > most * sizes[s] + 1e-9}
        if not above:
            return out
        stopped |= above


def check(rows, texts, near):
    sizes = {}
    for r in rows:
        assert r["size"] == len(SIZE.findall(texts[r["doc_id"]][0] or ""))
        s = texts[r["doc_id"]][1]
        sizes[s] = sizes.get(s, 0) + r["size"]
    target = shares(sizes)
    taken = dict.fromkeys(sizes, 0)
    largest = dict.fromkeys(sizes, 0)
    for r in rows:
        s = texts[r["doc_id"]][1]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(near * target[s], largest[s])
    return target, taken


def test_query_reaches_the_targets_and_repeats(spark, sf):
    docs = {r["doc_id"]: (r["text"], r["source"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op5_mixing(spark, sf).collect()
    assert len(rows) == len(docs)
    check(rows, docs, 0.02)
    assert sorted(rows) == sorted(queries.op5_mixing(spark, sf).collect())


def test_rates_are_exponential_tilts(spark, docs):
    rows = M.mix(docs).select("doc.source", "size", "target", "rate").collect()
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    for own in by.values():
        assert sum(r["rate"] * r["size"] for r in own) == pytest.approx(own[0]["target"], rel=1e-6)
        tilt = {round(math.log(r["rate"]) / r["size"], 9) for r in own if r["size"] and r["rate"] < 3}
        assert len(tilt) <= 1


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 1}, {"a": 1, "b": 1, "c": 1000}, {"a": 5}, {"a": 0, "b": 0}, {"a": 0, "b": 7, None: 3},
                                   {"é": 50, "z": 50, "Z": 50, None: 1, "": 9}])
def test_targets_are_the_reshared_ones(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in M.targets(df).collect()}
    assert got == pytest.approx(shares(sizes))


def test_a_source_that_needs_all_its_copies(spark, tmp_path):
    rows = [(i, "w " * 10, "a") for i in range(3)] + [(10 + i, "w " * 20, "b") for i in range(50)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "d"))
    got = M.mix(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert {r["copies"] for r in got if r["doc"]["source"] == "a"} == {3}


def test_edge_rows(spark, edge, empty):
    rows = M.mix(edge).collect()
    assert len(rows) == edge.count() and rows[0]["doc"].asDict().keys() == set(edge.columns)
    assert all(0 <= r["copies"] <= 3 and r["size"] == len(SIZE.findall(r["doc"]["text"] or "")) for r in rows)
    assert sum(r["target"] for r in {r["doc"]["source"]: r for r in rows}.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert M.mix(empty).collect() == []


def test_one_source_holds_a_third(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', int(id % 37) + 1)").alias("text"),
                                  F.expr("if(id % 3 = 0, 'hot', concat('s', id % 40))").alias("source"))
    df.write.parquet(str(tmp_path / "d"))
    rows = M.mix(spark.read.parquet(str(tmp_path / "d"))).select("doc.source", "size", "target", "copies").collect()
    taken = {}
    for r in rows:
        t = taken.setdefault(r["source"], [r["target"], 0])
        t[1] += r["copies"] * r["size"]
    assert all(abs(a - b) <= max(37, 0.02 * a) for a, b in taken.values())


def test_steps_that_do_not_suffice_are_an_error(spark):
    import pytest
    pairs = spark.createDataFrame([("a", 5, 10), ("a", 900, 3)], "source string, size long, n long")
    goals = spark.createDataFrame([("a", 2750, 3000.0)], "source string, source_size long, target double")
    with pytest.raises(ArithmeticError):
        M.tilts(pairs, goals, steps=1)
    assert M.tilts(pairs, goals).count() == 1
