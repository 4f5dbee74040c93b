"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenise the text with a space before it.  Offsets where tokens of both end
are shared cuts; what lies between neighbouring ones is a group.

Cuts by divide and conquer: an interval (at first a document) is cut at the shared
end nearest to its middle token, found by bisecting the other tokenizer's ends,
and both halves go on; an interval without any shared end inside is a leaf, a
group.  The intervals of one depth are worked on together, for all documents of a
chunk.

Two tokens are linked if their byte ranges overlap.  How many documents hold an id
pair linked is counted over the corpus by way of chunk dictionaries: a chunk of
documents numbers its distinct pairs, so a pair that most documents hold is one
row per chunk in the shuffle, and a document's links are numbers into its chunk's
dictionary.  Counts come back to the chunk as one array.

Tokenisers work on stretches between single spaces, which are remembered: neither
tokenizer merges over such a space (that is checked when they are loaded; where it
does not hold, texts are tokenised whole).

Defined results: texts that are null, empty, or whose tokens do not give back the
text's bytes have no tokens: zeros and an empty digest.  Rows repeated under one
id are documents of their own.  Extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerlens.llm import chars
from ledgerlens.llm.common import written

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
CHARS = 3_000_000  # characters of a chunk (a longer text is a chunk of its own)
MOST_WORDS, LONGEST_WORD = 400_000, 64  # entries of a worker's memory of stretches, and their length
PAIR_BITS = 24  # an id pair is one long: id of A, then PAIR_BITS for id of B
MARK = "▁"  # how B writes a space
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a visible byte as itself, the others from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Texts -> ids of both, with the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        letter = byte_letters()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(letter[c] for c in t) if all(c in letter for c in t) else t.encode() for t in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace(MARK, " ").encode() for p in pieces]
        own = json.loads(self.a.to_str())
        cut = own["pre_tokenizer"] or {}
        self.local = (own["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
                      and not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces))
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        v, w = len(self.a_bytes), len(self.b_bytes)
        self.said = np.array([f"{i}{end}".encode() for n, ends in ((v, ",|"), (w, ",;")) for end in ends for i in range(n)], dtype=object)
        self.a_flat, self.b_flat = (np.frombuffer(b"".join(x), dtype=np.uint8) for x in (self.a_bytes, self.b_bytes))
        self.a_at, self.b_at = np.cumsum(self.a_size) - self.a_size, np.cumsum(self.b_size) - self.b_size
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}

    def one(self, part: str) -> tuple[bytes, bytes]:
        """Ids (little-endian 32 bit) of both for a stretch after a space."""
        x = self.a.encode_batch_fast([" " + part], add_special_tokens=False)[0].ids
        return np.array(x, dtype="<u4").tobytes(), np.array(self.b.encode(part), dtype="<u4").tobytes()

    def many(self, parts: list[str]) -> list[tuple[bytes, bytes]]:
        """The same for many: encoded as one text, cut where the stretches end.  Where
        a tokenizer does not give back the bytes there are no such ends, and each is
        encoded alone."""
        text = " ".join(parts)
        ends = np.cumsum([1 + len(p.encode("utf-8", "surrogatepass")) for p in parts])
        out = []
        for ids, size in ((self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.a_size), (self.b.encode(text), self.b_size)):
            ids = np.array(ids, dtype="<u4")
            got = np.cumsum(size[ids])
            at = np.searchsorted(got, ends)
            if not len(ids) or at[-1] >= len(got) or got[-1] != ends[-1] or (got[at] != ends).any():
                return [self.one(p) for p in parts]
            raw, cuts = ids.tobytes(), ((at + 1) * 4).tolist()
            out.append([raw[i:j] for i, j in zip([0, *cuts], cuts)])
        return list(zip(*out))

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        cut = [(_BETWEEN.split(t) if self.local else [t]) if t else [] for t in texts]
        known, older = self.known, self.older
        new = set().union(*cut).difference(known)
        for p in new.intersection(older):
            known[p] = older[p]
        rest = list(new.difference(older))
        short = [p for p in rest if len(p) <= LONGEST_WORD]
        for at in range(0, len(short), 8192):
            known.update(zip(short[at: at + 8192], self.many(short[at: at + 8192])))
        long = [p for p in rest if len(p) > LONGEST_WORD]
        known.update((p, self.one(p)) for p in long)
        found = [[known[p] for p in parts] for parts in cut]
        for p in long:
            del known[p]
        if 2 * len(known) > MOST_WORDS:  # stretches in use move over from the older half, the rest goes with it
            self.known, self.older = {}, known
        return [(b"".join([x for x, _ in f]), b"".join([y for _, y in f])) for f in found]

    def exact(self, texts: list[str | None], pairs: list[tuple[bytes, bytes]]) -> np.ndarray:
        """Whether both tokenizers' tokens of each text give back its bytes."""
        raw = [b" " + t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        size, want = np.array([len(r) for r in raw]), np.frombuffer(b"".join(raw), dtype=np.uint8)
        ok = np.ones(len(texts), dtype=bool)
        for side, (sizes, flat, starts) in enumerate(((self.a_size, self.a_flat, self.a_at), (self.b_size, self.b_flat, self.b_at))):
            ids = np.frombuffer(b"".join([p[side] for p in pairs]), dtype="<u4")
            n = sizes[ids]
            own = np.add.reduceat(np.append(n, 0), np.cumsum([0, *(len(p[side]) // 4 for p in pairs[:-1])])) if pairs else n
            own[[not p[side] for p in pairs]] = 0
            got = flat[np.repeat(starts[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            ok &= own == size
            if len(got) == len(want) and (own == size).all():
                same = np.append(got == want, True)
                ok &= np.logical_and.reduceat(same, np.cumsum(size) - size) | (size == 0)
            else:
                at, to = np.cumsum(own) - own, np.cumsum(size) - size
                for i in np.flatnonzero(ok):
                    ok[i] = np.array_equal(got[at[i]: at[i] + own[i]], want[to[i]: to[i] + size[i]])
        return ok


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def _tokenizers(a: str, b: str) -> Tokenizers:
    """One per worker process."""
    if (a, b) not in _LOADED:
        import public_tokenizers
        _LOADED[a, b] = Tokenizers(public_tokenizers.path(a), public_tokenizers.path(b))
    return _LOADED[a, b]


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, number) for all numbers of the ranges lo..hi-1."""
    n = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + lo[which]


def _near_middle(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For every interval of A tokens lo..hi-1 the token before hi-1 nearest to the
    middle whose end is an end of B too, by bisect; -1 if there is none."""
    found = np.full(len(lo), -1, dtype=np.int64)
    mid = (lo + hi - 2) // 2
    left = np.arange(len(lo))
    inner, reach = -1, 0  # tokens up to ``inner`` places from the middle are done, now those up to ``reach``
    while len(left):
        m, first, last = mid[left], lo[left], hi[left] - 2
        below = _spread(np.maximum(m - reach, first), m - inner)
        above = _spread(m + inner + 1, np.minimum(m + reach, last) + 1) if reach else (below[0][:0], below[1][:0])
        which, at = np.concatenate([below[0], above[0]]), np.concatenate([below[1], above[1]])
        place = np.searchsorted(b, a[at])
        same = b[np.minimum(place, len(b) - 1)] == a[at]
        which, at = which[same], at[same]
        order = np.lexsort((np.abs(at - m[which]), which))  # the nearest of each interval comes first
        which, at = which[order], at[order]
        one = np.flatnonzero(np.diff(which, prepend=-1))
        found[left[which[one]]] = at[one]
        more = (m - reach > first) | (m + reach < last)
        more[which[one]] = False
        left = left[more]
        inner, reach = reach, max(1, 2 * reach)
    return found


def shared_cuts(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether a shared cut follows each A token.  ``a``, ``b``: ascending ends;
    lo..hi-1: the A tokens of every document, the last of which ends with B's."""
    cut = np.zeros(len(a), dtype=bool)
    cut[hi[hi > lo] - 1] = True
    while True:
        several = hi - lo > 1
        lo, hi = lo[several], hi[several]
        if not len(lo):
            return cut
        at = _near_middle(a, b, lo, hi)
        lo, hi, at = lo[at >= 0], hi[at >= 0], at[at >= 0]
        cut[at] = True
        lo, hi = np.stack([lo, at + 1], axis=1).ravel(), np.stack([at + 1, hi], axis=1).ravel()  # still in text order


class Aligned:
    """A chunk of texts, aligned.  Arrays are over the documents, over all A or B
    tokens, or over all links, in text order."""

    def __init__(self, tokens: Tokenizers, texts: list[str | None]):
        pairs = tokens.encode(texts)
        pairs = [p if ok else (b"", b"") for p, ok in zip(pairs, tokens.exact(texts, pairs).tolist())]
        self.tokens, self.docs = tokens, len(texts)
        self.n_a = np.array([len(x) // 4 for x, _ in pairs], dtype=np.int64)
        self.n_b = np.array([len(y) // 4 for _, y in pairs], dtype=np.int64)
        self.a = np.frombuffer(b"".join([x for x, _ in pairs]), dtype="<u4").astype(np.int64)
        self.b = np.frombuffer(b"".join([y for _, y in pairs]), dtype="<u4").astype(np.int64)
        del pairs
        a_end, b_end = np.cumsum(tokens.a_size[self.a]), np.cumsum(tokens.b_size[self.b])
        last = np.cumsum(self.n_a)
        cut = shared_cuts(a_end, b_end, last - self.n_a, last)
        self.a_cuts = np.flatnonzero(cut)  # the last A token of every group
        self.b_cuts = np.searchsorted(b_end, a_end[self.a_cuts])
        self.n_groups = np.bincount(np.repeat(np.arange(self.docs), self.n_a)[self.a_cuts], minlength=self.docs)
        self.n_links = self.n_a + self.n_b - self.n_groups
        ends = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        ends = ends[np.diff(ends, prepend=0) > 0]  # every stretch between ends is where one A token and one B token overlap
        self.links = (self.a[np.searchsorted(a_end, ends)] << PAIR_BITS) | self.b[np.searchsorted(b_end, ends)]

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every document."""
        v, w = len(self.tokens.a_bytes), len(self.tokens.b_bytes)
        a_in, b_in = (np.diff(c, prepend=-1) for c in (self.a_cuts, self.b_cuts))  # tokens of each group
        text = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        a_code, b_code = self.a.copy(), self.b + 2 * v
        a_code[self.a_cuts] += v
        b_code[self.b_cuts] += w
        text[np.arange(len(self.a)) + np.repeat(np.cumsum(b_in) - b_in, a_in)] = a_code
        text[np.arange(len(self.b)) + np.repeat(np.cumsum(a_in), b_in)] = b_code
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return [b"".join(self.tokens.said[text[s:e]].tolist())[:-1] for s, e in zip([0, *ends], ends)]


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    texts = batch.column("text").to_pylist()
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t or "") > CHARS:
            yield batch.slice(first, i - first), texts[first:i]
            first, size = i, 0
        size += len(t or "")
    if texts:
        yield batch.slice(first), texts[first:]


def _slim(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))


def groups(docs: DataFrame, keep: list[str], text_col: str = "text", a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """``keep`` columns as the struct ``doc`` and ``groups``: the aligned ids as text."""
    slim = _slim(docs, keep, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chars.sliced(batches):
            for rows, texts in _chunks(batch):
                said = [g.decode() for g in Aligned(_tokenizers(a_file, b_file), texts).groups()]
                yield pa.RecordBatch.from_arrays([rows.column("doc"), pa.array(said, pa.string())], ["doc", "groups"])

    return slim.mapInArrow(run, StructType([slim.schema["doc"], StructField("groups", StringType())]))


def align(docs: DataFrame, keep: list[str], text_col: str = "text", a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """``keep`` columns as the struct ``doc``, the COUNTS of every document, and
    groups_sha256 of its groups' text."""
    slim = _slim(docs, keep, text_col)
    own = ["n_a", "n_b", "n_groups", "n_links"]
    doc = StructField("doc", slim.schema["doc"].dataType)  # null in a chunk's dictionary row
    schema = StructType([StructField("chunk", LongType()), doc, *StructType.fromDDL(
        ", ".join(f"{c} long" for c in own) + ", groups_sha256 string, slots array<int>, times array<int>, pairs array<long>, docs array<int>").fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        tokens = _tokenizers(a_file, b_file)
        for batch in chars.sliced(batches):
            for rows, texts in _chunks(batch):
                found = Aligned(tokens, texts)
                n = found.docs
                pairs, slot = np.unique(found.links, return_inverse=True)
                width = max(1, len(pairs))
                held, times = np.unique(np.repeat(np.arange(n), found.n_links) * width + slot, return_counts=True)
                ends = np.searchsorted(held, np.arange(n + 1) * width).astype(np.int32)
                slots = (held % width).astype(np.int32)
                sums = [hashlib.sha256(g).hexdigest() if k else "" for g, k in zip(found.groups(), found.n_a.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * n, pa.int64()), rows.column("doc"), *(pa.array(getattr(found, c), pa.int64()) for c in own), pa.array(sums, pa.string()),
                     pa.ListArray.from_arrays(ends, pa.array(slots)), pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                     pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))], names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.nulls(1, rows.column("doc").type), *(pa.nulls(1, pa.int64()) for _ in own), pa.nulls(1, pa.string()),
                     pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int32())),
                     pa.array([pairs], pa.list_(pa.int64())), pa.array([np.bincount(slots, minlength=len(pairs)).astype(np.int32)], pa.list_(pa.int32()))], names)
                chunk += 1

    both = written(slim.mapInArrow(run, schema), "aligned")
    dictionary = both.filter("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("slot", "x")).select(
        "chunk", "slot", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    counts = written(dictionary.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", PAIR_BITS)), "pair-counts")
    best = counts.groupBy("a").agg(F.max("n").alias("most"))  # a row per id of A: bounded by its vocabulary
    judged = counts.join(F.broadcast(best), "a").select(F.col("pair").alias("_pair"), "n", (F.col("n") == F.col("most")).alias("best"))
    answers = dictionary.join(judged, F.col("pair") == F.col("_pair")).select(F.col("chunk").alias("_chunk"), "slot", "n", "best")
    rows = both.filter("pairs IS NULL").drop("pairs", "docs")
    out = StructType([doc, *StructType.fromDDL(", ".join(f"{c} long" for c in COUNTS) + ", groups_sha256 string").fields])

    def fill(left: pa.Table, right: pa.Table) -> pa.Table:
        n = np.zeros(1 + max(right["slot"].to_numpy(), default=-1), dtype=np.int64)
        top = np.zeros(len(n), dtype=np.int64)
        at = right["slot"].to_numpy()
        n[at], top[at] = right["n"].to_numpy(), right["best"].to_numpy(zero_copy_only=False) if right.num_rows else 0
        slots, times = left["slots"].combine_chunks(), left["times"].combine_chunks()
        which = np.repeat(np.arange(left.num_rows), np.diff(slots.offsets.to_numpy()))
        slot, times = slots.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        sums = []
        for value in (top, n):
            total = np.zeros(left.num_rows, dtype=np.int64)
            np.add.at(total, which, times * value[slot])
            sums.append(pa.array(total, pa.int64()))
        return pa.Table.from_arrays([left["doc"], *(left[c] for c in own), *sums, left["groups_sha256"]], names=out.names)

    return rows.groupBy("chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(fill, out)
