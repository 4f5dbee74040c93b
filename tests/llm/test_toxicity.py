import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import queries, toxicity
from ledgerlens.llm.common import remainder


def symbols(word):
    return bytes(ord(c) - 96 for c in word)


def kernel(s, t):
    """The gap-weighted subsequence kernel by enumeration."""
    total = 0.0
    for i in itertools.combinations(range(len(s)), 3):
        for j in itertools.combinations(range(len(t)), 3):
            spans = i[2] - i[0] + 1, j[2] - j[0] + 1
            if max(spans) <= toxicity.SPAN and all(s[a] == t[b] for a, b in zip(i, j)):
                total += toxicity.DECAY ** sum(spans)
    return total


@pytest.mark.parametrize("a, b", [("idiot", "idixot"), ("moron", "mmoron"), ("abcabc", "cabcab"), ("clown", "brown"), ("aaaa", "aaa")])
def test_unit_vectors_are_the_normalised_kernel(a, b):
    a, b = symbols(a), symbols(b)
    want = kernel(a, b) / (kernel(a, a) * kernel(b, b)) ** 0.5
    assert float(toxicity.unit(a) @ toxicity.unit(b)) == pytest.approx(want, abs=1e-5)


def test_decision_by_table_equals_the_kernel_expansion():
    marks = [symbols(w) for w in ("idiot", "moron", "table", "green")]
    coefficient = np.array([1.5, 2.0, -0.7, -0.3])
    model = toxicity.Model(sum(c * toxicity.unit(m) for c, m in zip(coefficient, marks)).astype(np.float32), 0.1)
    words = [symbols(w) for w in ("idiiot", "morron", "bananana", "tab", "idiotmoron", "mornings")]
    value = model.decide(_words(words))
    for w, v in zip(words, value):
        norm = [kernel(w, m) / (kernel(w, w) * kernel(m, m)) ** 0.5 for m in marks]
        assert v == pytest.approx(max(toxicity.FLOOR, float(coefficient @ norm) + 0.1), abs=1e-4)


def _words(words):
    n = np.array([len(w) for w in words])
    return toxicity.Words(np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum(n) - n, n, n, n)


def test_spelled_out_and_punctuated_words_are_one():
    from ledgerlens.llm import chars
    seen = []
    for rows, codes, starts in chars.chunks(["an i d i o t", "an i.d-i*ot", "x", "y z"]):
        w = toxicity.words_of(rows, codes, starts)
        seen += [(int(r), w.letters[a: a + n].tobytes()) for r, a, n in zip(w.row, w.first, w.length)]
    assert (0, symbols("idiot")) in seen and (1, symbols("idiot")) in seen
    assert (2, symbols("x")) in seen and (3, symbols("yz")) in seen  # never joined across documents


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    more = spark.read.parquet(f"{sf}/labels.parquet").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    got = queries.op1_toxicity(spark, sf).join(more, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3).astype(int) == got.predicted).all()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    gap = toxic.score.to_numpy()[:, None] - clean.score.to_numpy()[None, :]
    assert (gap > 0).mean() + (gap == 0).mean() / 2 > 0.75  # some labels of this small table are noise
    assert clean.predicted.mean() < 0.05 and toxic[toxic.lang == "en"].predicted.mean() > 0.8


def test_edge_rows_are_scored(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1, "s"), (1, 0, "s"), (3, 0, "s"), (6, None, "s"), (None, 1, "s")], "doc_id long, toxic int, score string")
    model = toxicity.train(edge, labels, remainder("doc_id", 4) != 9)
    rows = toxicity.score(edge, model, edge.columns).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r["doc"]["text"] or "", set()).add(r["score"])
    assert all(len(v) == 1 for v in by_text.values())  # equal texts, equal scores
    assert toxicity.score(empty, toxicity.train(empty, labels, F.lit(True)), ["doc_id"]).count() == 0


def test_without_one_of_the_labels_the_score_is_their_share(spark, edge):
    for label, want in ((1, 1.0), (0, 0.0)):
        labels = spark.createDataFrame([(1, label), (2, label)], "doc_id long, toxic int")
        model = toxicity.train(edge, labels, F.lit(True))
        assert {round(r["score"], 6) for r in toxicity.score(edge, model, ["doc_id"]).collect()} == {want}
