import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import chars, langid, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.97 and got.score.between(0, 1).all()


def test_viterbi_against_all_labelings():
    r = np.random.default_rng(0)
    for _ in range(40):
        lengths = r.integers(0, 6, 4)
        scores = r.normal(0, 3, (int(lengths.sum()), 3)).astype(np.float32)
        got = langid.viterbi(scores, lengths, penalty=2.0)
        at = 0
        for n in lengths:
            own = scores[at: at + n]

            def value(path):
                return sum(own[i, k] for i, k in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

            if n:
                best = max(value(p) for p in itertools.product(range(3), repeat=int(n)))
                assert abs(value(got[at: at + n].tolist()) - best) < 1e-3
            at += n


def model_of(spark, rows):
    return langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))


def test_scripts_and_mixed_spans(spark):
    rows = [(i, t, la) for i, (t, la) in enumerate([("the cat and the dog went with them there", "en"), ("der hund und die katze gehen nicht heim", "de"),
                                                    ("это большая собака и кошка", "ru"), ("αυτό είναι ένα βιβλίο", "el")] * 5)]
    model = model_of(spark, rows)
    text = "the dog and the cat went there " * 3 + "книга собака кошка " + "der hund und die katze " * 3
    names, _, spans = langid.label_texts(model, [text], True)
    assert [s["lang"] for s in spans.to_pylist()[0]] == ["en", "ru", "de"] and names.to_pylist() == ["en"]
    s = spans.to_pylist()[0][1]
    assert text[s["start"]: s["end"]] == "книга собака кошка"
    names, score = langid.label_texts(model, ["漢字", "123 !", "", None, "βιβλίο"], False)
    assert names.to_pylist() == ["de", "und", "und", "und", "el"] and score.to_pylist()[:4] == [0.0] * 4


def test_long_texts_cut_into_parts_give_the_same(spark, monkeypatch):
    model = model_of(spark, [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de")] * 3)
    texts = ["the cat " * 50 + "der hund " * 50, None, "the " * 30, "", "die katze " * 100]
    whole = [a.to_pylist() for a in langid.label_texts(model, texts, True)]
    small = chars.chunks
    monkeypatch.setattr(langid.chars, "chunks", lambda t: small(t, 64))
    assert [a.to_pylist() for a in langid.label_texts(model, texts, True)] == whole


def test_edge_rows(spark, edge, empty):
    model = langid.train(edge, F.lit(True))
    rows = langid.identify(edge, model, edge.columns).collect()
    assert len(rows) == edge.count()
    for r in rows:
        has = any(c.isalpha() for c in r["doc"]["text"] or "")
        assert (r["lang_pred"] == "und") == (not has) and 0 <= r["score"] <= 1
    none = langid.train(empty, F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(edge, none, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(empty, model, ["doc_id"]).collect() == []


def test_more_than_256_labels():
    scores = np.full((6, 300), -5.0, dtype=np.float32)
    scores[:3, 280], scores[3:, 24] = 0.0, 0.0
    assert langid.viterbi(scores, np.array([3, 3])).tolist() == [280] * 3 + [24] * 3
