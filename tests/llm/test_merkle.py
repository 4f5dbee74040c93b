import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import merkle, queries


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(*(field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def tree(hashes, fan):
    """Root, and of every leaf (siblings before, siblings after) level by level."""
    paths, place, now = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(now) > 1:
        for i, at in enumerate(place):
            first = at // fan * fan
            paths[i].append((now[first:at], now[at + 1: first + fan]))
            place[i] = at // fan
        now = [digest(*now[i: i + fan]) for i in range(0, len(now), fan)]
    return now[0], paths


def brute(rows, fan=8):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"], leaf(r, r["text"]), r))
    for g in groups.values():
        g.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {g: tree([h for _, h, _ in groups[g]], fan) for g in names}
    root, tops = tree([subs[g][0] for g in names], fan) if names else (None, [])
    out = []
    for g, top in zip(names, tops):
        for (i, own, r), path in zip(groups[g], subs[g][1]):
            proof = path + top
            lower = r["text"] and r["text"].translate({c: c + 32 for c in range(65, 91)})
            claimed = leaf(r, lower) if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 else own
            up = claimed
            for before, after in proof:
                up = digest(*before, up, *after)
            out.append((i, own, subs[g][0], root, digest(*(h for b, a in proof for h in b + a)), up, up == root))
    return sorted(out, key=repr)


def run(spark, rows, path):
    rows.write.parquet(f"{path}/documents.parquet")
    return sorted(map(tuple, queries.op12_merkle_manifest(spark, str(path)).collect()), key=repr)


def test_query_against_brute_force(spark, sf, docs):
    got = sorted(map(tuple, queries.op12_merkle_manifest(spark, sf).collect()), key=repr)
    assert got == brute(docs.collect()) and 0 < sum(r[-1] for r in got) < len(got)


def test_edge_rows(spark, edge, tmp_path):
    """Nulls, empty and long texts, repeated rows, a null language first, extra columns."""
    assert run(spark, edge, tmp_path) == brute(edge.collect())


@pytest.mark.parametrize("n, langs", [(1, 1), (2, 2), (8, 1), (9, 1), (65, 9), (20, 20)])
def test_lone_leaves_and_short_last_runs(spark, tmp_path, n, langs):
    rows = spark.createDataFrame([(i, f"Text {i}", f"l{i % langs}", None, None) for i in range(n)],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert run(spark, rows, tmp_path) == brute(rows.collect())


def test_empty_table(spark, empty):
    table = empty.withColumn("leaf", F.lit(""))
    assert merkle.manifest(table, ["doc_id"], "lang", "doc_id", "leaf").collect() == []


def test_deep_trees_jump_with_salts(spark):
    """Runs of two: over eight levels, so that the last jumps salt their targets; a third of the
    rows is one repeated row."""
    rows = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("lang"))
    rows = rows.withColumn("leaf", F.sha2(F.col("doc_id").cast("string").cast("binary"), 256)).drop("id")
    found = merkle.manifest(rows, ["doc_id"], "lang", "doc_id", "leaf", fan=2)
    found = found.withColumn("up", merkle.folded(F.col("leaf"), F.col("proof"))).collect()
    hashes = [digest(str(i)) for i in sorted(7 if i % 3 == 0 else i for i in range(600))]
    root, paths = tree(hashes, 2)
    assert {r["up"] for r in found} == {root} == {r["root"] for r in found} and len(found) == 600
    got = sorted((r["leaf"], tuple((bytes(s["before"]).hex(), bytes(s["after"]).hex()) for s in r["proof"])) for r in found)
    assert got == sorted((h, tuple(("".join(b), "".join(a)) for b, a in p)) for h, p in zip(hashes, paths))


def test_changed_rows_fail_and_order_of_partitions_does_not_matter(spark, docs):
    table = docs.withColumn("leaf", merkle.leaf(*(F.col(c) for c in ("doc_id", "text"))))
    one = merkle.manifest(table.repartition(5), ["doc_id"], "lang", "doc_id", "leaf").select("root").distinct().collect()
    other = merkle.manifest(table.where("doc_id > 0"), ["doc_id"], "lang", "doc_id", "leaf").select("root").distinct().collect()
    again = merkle.manifest(table.repartition(2, "text"), ["doc_id"], "lang", "doc_id", "leaf").select("root").distinct().collect()
    assert one == again and one != other and len(one) == 1
