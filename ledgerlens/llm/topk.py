"""Exact top-k inner-product search on a bit-sliced index.

Vectors are turned into integers (``floor(scale * x)``).  Rows are dealt into
blocks; a block keeps, for every dimension, one bitmap per bit of the shifted
(non-negative) value.  A query's score of all rows of a block is the sum of
shifted slices, built with bitmap full adders only: a negative weight uses the
complemented slices plus a constant.  The k best rows are read off the sum from
the most significant slice downward; rows left equal at the boundary are
resolved by the smaller id.  The blocks' winners are merged by a window.

Every query meets every row: the quantised rows are written once, row blocks are
repeated per query block of thousands (whose queries a task works off one by one)
and queries per row block, so a task holds one block of each and nothing else.

Defined results: a vector that is null, or holds a null, NaN or infinite
component, takes no part; so does a row without an id.  Vectors of different
length are padded with zeros.  Rows repeated under one id are candidates of their
own, for every other id; repeated under a query's id, they are one query, whose
scores are those of all its rows.  Fewer than k candidates give fewer rows; an empty table gives
no rows.  Equal scores rank the smaller id first.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

OUT = "query_id long, vec_id long, score long"


def quantise(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    ok = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & F.forall(
        vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    q = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale))
    return vectors.filter(ok).select(F.col(id_col).cast("long").alias("vec_id"), q.alias("q"))


def _matrix(col: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(col), width), dtype=np.int64)
    for i, v in enumerate(col):
        out[i, : len(v)] = v
    return out


def _pack(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    pad = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, pad)])).view(np.uint64)


def _add(total: list[np.ndarray], slices: np.ndarray, at: int) -> None:
    """total += slices << at, as a ripple of bitmap full adders."""
    carry = None
    for b, x in enumerate(slices):
        i = at + b
        while i >= len(total):
            total.append(np.zeros_like(x))
        t = total[i]
        half = t ^ x
        if carry is None:
            carry = t & x
            total[i] = half
        else:
            total[i] = half ^ carry
            carry = (t & x) | (carry & half)
    i = at + len(slices)
    while carry is not None and carry.any():
        if i >= len(total):
            total.append(np.zeros_like(carry))
        total[i], carry = total[i] ^ carry, total[i] & carry
        i += 1


def _best(total: list[np.ndarray], alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows surely among the k best, rows tied at the boundary)."""
    sure, tied = np.zeros_like(alive), alive
    for s in reversed(total):
        hit = sure | (tied & s)
        n = int(np.bitwise_count(hit).sum())
        if n > k:
            tied = tied & s
        else:
            sure, tied = hit, tied & ~s
            if n == k:
                return sure, np.zeros_like(alive)
    return sure, tied


def _rows(words: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little")[:n])


def search_block(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The k best rows of one block for each query, exact."""
    order = np.argsort(ids, kind="stable")  # ties: the smaller id first
    ids, x = ids[order], x[order]
    n, dims = x.shape
    u = x - x.min(initial=0)
    bits = max(1, int(u.max(initial=0)).bit_length())
    plain = np.stack([_pack(((u >> b) & 1).T.astype(bool)) for b in range(bits)], axis=1) if dims else None
    flipped = ~plain if dims else None
    everyone = _pack(np.ones((1, n), dtype=bool))[0]
    out = []
    for qid, w in zip(qids.tolist(), q):
        total: list[np.ndarray] = []
        for d in range(dims):
            weight = abs(int(w[d]))
            slices = (flipped if w[d] < 0 else plain)[d]
            at = 0
            while weight:
                if weight & 1:
                    _add(total, slices, at)
                weight >>= 1
                at += 1
        alive = everyone.copy()
        own = np.flatnonzero(ids == qid)
        for i in own:
            alive[i >> 6] &= ~np.uint64(1 << int(i & 63))
        sure, tied = _best(total, alive, k)
        rows = _rows(sure, n)
        rest = _rows(tied, n)[: max(0, k - len(rows))]  # rows are in id order
        for r in np.concatenate([rows, rest]):
            out.append((qid, int(ids[r]), int(x[r] @ w)))
    return out


def top_k(vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024,
          every: int = 100, block_rows: int = 16384, block_queries: int = 8192) -> DataFrame:
    """For every row whose id is divisible by ``every``: its k best other rows.

    Returns query_id, rank, vec_id, score."""
    v = quantise(vectors, id_col, vec_col, scale).withColumn("row", F.monotonically_increasing_id())
    v = written(v, "quantised")  # a row keeps its number, by which it is dealt
    n, m, width = v.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0), F.max(F.size("q"))).first()
    row_blocks, query_blocks = max(1, math.ceil(n / block_rows)), max(1, math.ceil(m / block_queries))
    width = max(0, width or 0)

    def block(c: str, blocks: int):
        return F.pmod(F.xxhash64(c), F.lit(blocks))  # rows, not ids: an id may be repeated

    def each(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))

    rows = v.select("vec_id", "q", block("row", row_blocks).alias("rb"), each(query_blocks).alias("qb"))
    queries = v.filter(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), "q", block("row", query_blocks).alias("qb"), each(row_blocks).alias("rb"))

    def search(r: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        found = [] if r.empty or s.empty else search_block(
            r["vec_id"].to_numpy(), _matrix(r["q"], width), s["query_id"].to_numpy(), _matrix(s["q"], width), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"], dtype="int64")

    found = rows.groupBy("rb", "qb").cogroup(queries.groupBy("rb", "qb")).applyInPandas(search, OUT)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
