"""Best-fit packing of tokenised documents by exact-complement hashing.

A document is tokenised, gets an end id, and is cut into pieces of at most
``width`` ids; full pieces are sequences of their own.  The plan is made on the
histogram of the other lengths (at most ``width`` - 1 counts, whatever the
corpus): take the longest length left, look up in the index of available lengths
a single, a pair or a triple that fills the gap exactly, and use that
combination as often as the counts allow; if there is none, put the longest
fitting length into the gap (best fit) and look again.

A plan is a list of patterns (lengths, how often).  Pieces of one length are
interchangeable: the piece of rank r among them takes the r-th place planned for
its length.  Ranks come from counts per (length, bucket) and a window inside a
bucket, so a length that a third of all pieces share is still dealt to many
tasks.  The places are a table of at most a few rows per pattern.

Defined results: a null text is the empty text, one piece with the end id alone.
Documents repeated under one id are packed as documents of their own.  An empty
table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

WIDTH, END = 4096, 1
TOKENIZER = "word_bpe_49k.json"
BUCKETS = 256
MOST_WORDS = 300_000  # entries of a worker's cache of word -> ids
# Texts of these characters only: lower-casing and Unicode normalisation are the
# same in Python as in the tokenizer.  Other texts go through the tokenizer whole.
PLAIN = r"[\t\n\r\x20-\x7e¡-¬®-ÿŒœŸ–—‘-„…€]*"
# How the tokenizer cuts words (its published configuration).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a visible byte as itself and number the
    others from 256 on: PLAIN's non-ASCII characters in that writing."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    letter = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x80, 0x3000)}


class Encoder:
    """Text -> little-endian 32-bit ids, with a bounded cache of words.

    The tokenizer never merges across white space, so a plain text's ids are
    those of its white-space words in turn, and a word needs its merges once."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.merge, self.letters = self.tokenizer.model.tokenize, byte_letters()
        self.plain, self.parts = re.compile(PLAIN).fullmatch, regex.compile(WORDS).findall
        self.raw = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def part(self, part: str) -> bytes:
        part = part if part.isascii() else part.translate(self.letters)
        raw = self.raw
        return b"".join([raw[t.id] for t in self.merge(part)])

    def word(self, word: str) -> bytes:
        if word.isalpha():
            return self.part(word)
        # Most others are letters and one mark, which the tokenizer cuts in two.
        parts = (word[:-1], word[-1]) if word[:-1].isalpha() and word[-1] in ".,;:!?|" else self.parts(word)
        out, cache = [], self.cache
        for p in parts:
            ids = cache.get(p) or self.older.get(p)
            if ids is None:
                ids = self.part(p)
            cache[p] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if "<|" in text or not self.plain(text):
            return self.whole(text)
        words, cache, older = text.lower().split(), self.cache, self.older
        for w in set(words).difference(cache):
            cache[w] = older[w] if w in older else self.word(w)
        if 2 * len(cache) > MOST_WORDS:  # words in use move over from the older half, the rest goes with it
            self.cache, self.older = {}, cache
        return b"".join(map(cache.__getitem__, words))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str) -> Encoder:
    """One per worker process."""
    if name not in _ENCODERS:
        import os

        import public_tokenizers
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[name] = Encoder(public_tokenizers.path(name))
    return _ENCODERS[name]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, end: int = END,
           tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids as binary])."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    tail = np.array([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            rows: list[list] = [[] for _ in range(5 + with_ids)]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + tail
                for n, at in enumerate(range(0, len(ids), 4 * width)):
                    own = ids[at: at + 4 * width]
                    for column, value in zip(rows, (doc, n, at // 4, len(own) // 4, zlib.crc32(own), own)):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names[: len(rows)])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, schema)


def plan(counts: dict[int, int], width: int = WIDTH) -> list[tuple[tuple[int, ...], int]]:
    """counts of pieces by length (1 to width) -> [(lengths of a sequence, how often)].

    The available lengths are the bits of a number, and mirrored those of a second
    one: the pairs that sum to a gap are the bits that one shift and one "and" leave."""
    left = [0] * (width + 1)
    there = mirror = 0  # bit n, and bit width - n, for an available length n

    def add(length: int, n: int) -> None:
        nonlocal there, mirror
        before, left[length] = left[length], left[length] + n
        if (before > 0) != (left[length] > 0):
            there ^= 1 << length
            mirror ^= 1 << (width - length)

    for length, n in counts.items():
        add(length, n)
    out: list[tuple[tuple[int, ...], int]] = []

    def single(gap: int) -> tuple[int, ...] | None:
        return (gap,) if left[gap] else None

    def pair(gap: int) -> tuple[int, ...] | None:
        """The most unequal two available lengths that sum to the gap."""
        half = gap // 2
        hits = there & mirror >> (width - gap) & (2 << half) - 2
        if not hits:
            return None
        a = (hits & -hits).bit_length() - 1
        return (gap - a, a) if 2 * a != gap or left[a] >= 2 else None  # two halves are the last hit

    def triple(gap: int) -> tuple[int, ...] | None:
        lengths = there & (1 << (gap - 1)) - 1
        while lengths:
            a = lengths.bit_length() - 1
            lengths ^= 1 << a
            add(a, -1)
            rest = pair(gap - a)
            add(a, 1)
            if rest:
                return (a, *rest)
        return None

    for first in range(width, 0, -1):
        while left[first]:
            add(first, -1)
            used, gap = [first], width - first
            while gap:
                fit = single(gap) or (pair(gap) if gap > 1 else None) or (triple(gap) if gap > 2 else None)
                if not fit:
                    longest = (there & (2 << gap) - 1).bit_length() - 1
                    if longest < 0:
                        break
                    fit = (longest,)
                for length in fit:
                    add(length, -1)
                used += fit
                gap -= sum(fit)
            for length in used:
                add(length, 1)
            need = Counter(used)
            times = min(left[length] // n for length, n in need.items())
            for length, n in need.items():
                add(length, -n * times)
            out.append((tuple(used), times))
    return out


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """length -> (first rank, first sequence, offset) of its runs of places, by rank."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for lengths, times in patterns:
        for length, at in zip(lengths, itertools.accumulate((0, *lengths))):
            runs.setdefault(length, []).append((taken.get(length, 0), sequence, at))
            taken[length] = taken.get(length, 0) + times
        sequence += times
    return {k: tuple(np.array(v, dtype=np.int64).T) for k, v in runs.items()}


def pack(parts: DataFrame, width: int = WIDTH, id_col: str = "doc_id") -> DataFrame:
    """pieces (a written table) -> with sequence_id and offset."""
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}  # at most ``width`` rows
    where = places(plan(counts, width))
    keyed = parts.withColumn("_b", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int"))
    per = keyed.groupBy("length", "_b").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    per = written(per.select(F.col("length").alias("_l"), F.col("_b").alias("_c"), F.coalesce(before, F.lit(0)).alias("_before")), "pack-ranks")
    inside = F.row_number().over(Window.partitionBy("length", "_b").orderBy(id_col, "piece", "ids_crc32"))
    ranked = keyed.withColumn("_r", inside).join(per, (F.col("length") == F.col("_l")) & (F.col("_b") == F.col("_c")))
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_r") - 1).drop("_l", "_c", "_b", "_before", "_r")
    keep = parts.columns
    table = parts.sparkSession.sparkContext.broadcast(where)  # a few rows per pattern; patterns are bounded by the width

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = np.empty(len(length), dtype=np.int64), np.empty(len(length), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                first, start, at = table.value[int(length[own[0]])]
                run = np.searchsorted(first, rank[own], side="right") - 1
                sequence[own] = start[run] + rank[own] - first[run]
                offset[own] = at[run]
            arrays = [batch.column(c) for c in keep] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "sequence_id", "offset"])

    from pyspark.sql.types import LongType, StructType
    schema = StructType([*parts.schema.fields]).add("sequence_id", LongType()).add("offset", LongType())
    return ranked.mapInArrow(deal, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, end: int = END,
                   tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """Tokenise once (written), plan on the histogram, deal out the places."""
    return pack(written(pieces(docs, id_col, text_col, width, end, tokenizer, with_ids), "pieces"), width)
