from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerlens.llm import langid, queries
from tests.llm.test_mixing import check as check_mix
from tests.llm.test_neardup import groups
from tests.llm.test_packing import check_places, piece, whole
from tests.llm.test_secrets import spans


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    """Every stage's input and output on the smallest table."""
    out, docs = {}, spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf).write.parquet(path)
        done = spark.read.parquet(path)
        out[name] = docs, done
        docs = done
    return out


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in P.STAGES] == ["language", "near duplicates", "secrets", "mixing", "packing"]
    assert P.ORACLE_SQL is None


def test_all_but_the_last_keep_the_columns(steps):
    for name, (before, after) in steps.items():
        if name != "packing":
            assert after.columns == before.columns


def test_language_drops_what_it_rejects(spark, steps):
    before, after = steps["language"]
    model = langid.train(before, F.lit(True))
    judged = langid.identify(before, model, ["doc_id"], spans=False).collect()
    want = {r["doc"]["doc_id"] for r in judged if r["lang_pred"] != "und" and r["score"] >= P.LEAST_SHARE}
    assert {r["doc_id"] for r in after.collect()} == want and len(want) > 0.95 * len(judged)
    assert not rows(after) - rows(before)


def test_one_document_of_each_group_stays(steps):
    before, after = steps["near duplicates"]
    want = {k for k, _, least in groups([(r["doc_id"], r["text"]) for r in before.collect()], 5) if k == least}
    assert {r["doc_id"] for r in after.collect()} == want and after.count() == len(want)


def test_secrets_are_gone_and_the_rest_untouched(steps):
    before, after = steps["secrets"]
    old = {r["doc_id"]: r for r in before.collect()}
    new = {r["doc_id"]: r for r in after.collect()}
    assert old.keys() == new.keys()
    for k, r in new.items():
        assert r["n_chars"] == len(r["text"])
        if spans(old[k]["text"]):
            want, at = [], 0
            for s, _, e, *_ in spans(old[k]["text"]):
                if s >= at:
                    want.append(old[k]["text"][at: s] + "[SECRET]")
                at = max(at, e)
            assert r["text"] == "".join(want) + old[k]["text"][at:]
        else:
            assert r["text"] == old[k]["text"]


def test_mix_takes_each_source_to_its_target(spark, steps):
    before, after = steps["mixing"]
    docs = {r["doc_id"]: (r["text"], r["source"]) for r in before.collect()}
    copies = Counter(r["doc_id"] for r in after.collect())
    assert max(copies.values()) <= 3 and not set(map(tuple, after.collect())) - set(map(tuple, before.collect()))
    from ledgerlens.llm import mixing
    taken = mixing.mix(before).select("doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies").collect()
    assert {r["doc_id"]: r["copies"] for r in taken if r["copies"]} == dict(copies)
    check_mix(taken, docs, 0.02)


def test_packing_holds_every_token_once(steps):
    before, after = steps["packing"]
    got = after.collect()
    assert Counter(map(piece, got)) == whole([(r["doc_id"], r["text"]) for r in before.collect()])
    check_places(got)


def test_run_is_the_query(spark, sf, steps):
    _, last = steps["packing"]
    got = queries.pipeline(spark, sf)
    assert got.columns == last.columns and sorted(map(piece, got.collect())) == sorted(map(piece, last.collect()))


def test_edge_rows_pass_every_stage(spark, edge, empty, tmp_path):
    for name, docs in (("edge", edge), ("empty", empty)):
        for step, stage in P.STAGES:
            path = str(tmp_path / name / step)
            stage(spark, docs, "").write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == (name == "edge")


def test_repeated_ids_keep_one_row_of_each_group(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text, "a"), (2, text + " x", "a"), (3, "other words " * 9 + "here", "b"), (3, "other words " * 9 + "here", "c"), (3, text, "d"),
            (4, "p q r s t u v", "e"), (4, "k l m n o p q", "e"), (5, "", "f"), (5, None, "g"), (None, "n1 n2 n3 n4 n5 n6", "h"), (None, text, "i")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "d"))
    left = P.near_duplicates(spark, spark.read.parquet(str(tmp_path / "d")), "").collect()
    got = sorted((str(r["doc_id"]), (r["text"] or "")[:5]) for r in left)
    assert got == sorted([("1", "w0 w1"), ("3", "other"), ("4", "p q r"), ("4", "k l m"), ("5", ""), ("5", ""), ("None", "n1 n2")])
