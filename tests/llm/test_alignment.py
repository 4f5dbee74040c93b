import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import alignment, queries

ODD = [" ", "  ", "\n", "\t", "a", "the", "é", "密码", "😀", "▁", "<s>", "<|endoftext|>", "'s", "can't", "123", " ", "　", "\x1c", "\x85",
       "​", "...", "<0x41>", "ß", "\r\n", "\x00", "﻿", "\U0010ffff"]


@pytest.fixture(scope="module")
def tokens():
    return alignment.Tokenizers(public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE))


def plain(tokens, texts):
    """(n_a, n_b, n_groups, links, groups text) of whole texts; None where there are no tokens."""
    out = []
    for t in texts:
        raw = (" " + (t or "")).encode()
        x = tokens.a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = tokens.b.encode(t) if t else []
        a, b = [tokens.a_bytes[i] for i in x], [tokens.b_bytes[i] for i in y]
        if not t or b"".join(a) != raw or b"".join(b) != raw:
            out.append(None)
            continue
        a_end, b_end = np.cumsum([len(i) for i in a]).tolist(), np.cumsum([len(i) for i in b]).tolist()
        said, links, i, j = [], Counter(), 0, 0
        for cut in sorted(set(a_end) & set(b_end)):
            first_a, first_b, i, j = i, j, a_end.index(cut) + 1, b_end.index(cut) + 1
            said.append(",".join(map(str, x[first_a:i])) + "|" + ",".join(map(str, y[first_b:j])))
            for u in range(first_a, i):
                for v in range(first_b, j):
                    if max(a_end[u] - len(a[u]), b_end[v] - len(b[v])) < min(a_end[u], b_end[v]):
                        links[x[u], y[v]] += 1
        out.append((len(x), len(y), len(said), links, ";".join(said)))
    return out


def brute(tokens, rows):
    found = plain(tokens, [t for _, t in rows])
    docs = Counter(p for f in found if f for p in f[3])
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for (i, _), f in zip(rows, found):
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((i, *f[:3], sum(f[3].values()), sum(n for p, n in f[3].items() if docs[p] == best[p[0]]),
                        sum(n * docs[p] for p, n in f[3].items()), hashlib.sha256(f[4].encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark, sf, docs, tokens):
    got = sorted(map(tuple, queries.op11_alignment(spark, sf).collect()), key=repr)
    assert got == brute(tokens, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edge_rows_in_small_chunks(spark, edge, tokens, tmp_path, monkeypatch):
    """Nulls, empty and very long texts, repeated rows and clashing names."""
    edge.where("doc_id IS NULL OR doc_id != 6").unionByName(edge.where("doc_id = 6").withColumn("text", F.substring("text", 1, 6000))).write.parquet(
        f"{tmp_path}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op11_alignment(spark, str(tmp_path)).collect()), key=repr)
    assert got == brute(tokens, rows)


def test_empty_table(spark, empty):
    assert alignment.align(empty, ["doc_id"]).collect() == []


def test_odd_texts_and_any_chunking(tokens, monkeypatch):
    r = random.Random(1)
    texts = ["".join(r.choice(ODD) for _ in range(r.randint(0, 12))) for _ in range(800)] + [None, "", " ", "  x  y ", "密" * 3000, "x" * 5000, " " * 3000]
    want = plain(tokens, texts)
    monkeypatch.setattr(alignment, "MOST_WORDS", 50)
    for size in (len(texts), 7):
        for at in range(0, len(texts), size):
            found = alignment.Aligned(tokens, texts[at: at + size])
            for g, a, b, n, w in zip(found.groups(), found.n_a, found.n_b, found.n_groups, want[at: at + size]):
                assert (int(a), int(b), int(n), g.decode()) == ((0, 0, 0, "") if w is None else (*w[:3], w[4]))


def test_stretches_alone_where_spaces_part_nothing(tokens, monkeypatch):
    texts = ["the cat  sat", "▁ x", "naïve café 密码 end"]
    want = alignment.Aligned(tokens, texts).groups()
    monkeypatch.setattr(tokens, "local", False)
    assert alignment.Aligned(tokens, texts).groups() == want


def test_divide_and_conquer_finds_every_shared_end():
    r = random.Random(3)
    for _ in range(300):
        total, docs, a, b, sizes = 0, r.randint(1, 4), [], [], []
        for _ in range(docs):
            n = r.randint(1, 40)
            ends = [sorted(set(r.sample(range(1, n + 1), r.randint(1, n))) | {n}) for _ in range(2)]
            a += [total + e for e in ends[0]]
            b += [total + e for e in ends[1]]
            sizes.append(len(ends[0]))
            total += n
        hi = np.cumsum(sizes)
        cut = alignment.shared_cuts(np.array(a), np.array(b), hi - np.array(sizes), hi)
        assert [x for x, c in zip(a, cut) if c] == sorted(set(a) & set(b))


def test_groups_as_text(spark, docs, tokens):
    rows = alignment.groups(docs.limit(20), ["doc_id", "text"]).collect()
    want = plain(tokens, [r["doc"]["text"] for r in rows])
    assert [r["groups"] for r in rows] == [w[4] if w else "" for w in want]


def test_a_pair_that_all_documents_share_over_many_chunks(spark, tokens, tmp_path, monkeypatch):
    texts = [f"the same start of {i % 7} {'word' * (i % 5)}" for i in range(300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op11_alignment(spark, str(tmp_path)).collect()), key=repr)
    assert got == brute(tokens, list(enumerate(texts)))
