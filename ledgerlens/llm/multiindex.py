"""Approximate nearest neighbours on an inverted multi-index.

Vectors of length one are cut into two halves, each quantised by its own codebook
(k-means on a bounded sample); a pair of centroids is a cell.  A query walks over
the cells by the sum of its two distances, nearest first, with a heap (a pair is
followed by its neighbours in either half's order), until the cells it has met
hold a given share of the rows; their rows are reranked by exact cosine in double
precision.

The share is calibrated: on the sample, whose true neighbours are known, it is
what the queries of the sample need to meet ``goal`` of them.  Clustered vectors
need a small share, unstructured ones a large one.

Codebooks grow with the square root of the rows, up to ``most_centroids``; the
table of cells (rows of each) is bounded by their square.  Rows are dealt into
blocks of about ``block_rows``: cells next to each other share one, a large cell
is split over several.  A query is sent once to every block it has a cell in, with
its cells there; blocks are repeated only per ``block_queries`` queries.  Of rows with
equal vectors, which tie everywhere, those with the k + 1 smallest ids are enough
and only those are indexed, so a large group of copies costs a few rows.

Defined results: a vector that is null, zero or holds a null, NaN or infinite
component takes no part; so does a row without an id.  Vectors of different
length are padded with zeros.  Rows repeated under one id are candidates of their
own for other ids and never for their own; a query id with several vectors is one
query, a row's score being the best for any of them.  Equal scores rank the
smaller id first.  Fewer than k candidates are all returned; an empty table gives no
rows.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.llm.common import written

SAMPLE, TRIALS = 8192, 512  # rows that codebooks and the share are fitted on, and queries among them
ROUNDS, CELL_ROWS = 15, 64
CLOSE = 1e-9  # scores this close to the k-th best are computed again, row by row


def matrix(col: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows, padded with zeros."""
    out = np.zeros((len(col), width))
    sizes = np.diff(col.offsets.to_numpy())
    values = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(col)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two: exact, and no square over- or underflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0, keepdims=True))[1]) if len(x) else x


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(axis=1)


def codebook(x: np.ndarray, n: int) -> np.ndarray:
    """k-means; centroids without rows stay where they are."""
    found = x[np.linspace(0, len(x) - 1, n).astype(int)].copy()
    for _ in range(ROUNDS):
        own = distances(x, found).argmin(axis=1)
        size = np.bincount(own, minlength=n)
        total = np.zeros_like(found)
        np.add.at(total, own, x)
        found[size > 0] = total[size > 0] / size[size > 0, None]
    return found


class Index:
    """Two codebooks, the rows of each cell, and how many rows a query is to meet."""

    def __init__(self, sample: np.ndarray, centroids: int, k: int, goal: float):
        half = (sample.shape[1] + 1) // 2
        self.half = half
        self.books = codebook(sample[:, :half], centroids), codebook(sample[:, half:], centroids)
        self.n = centroids
        self.rows = np.bincount(self.cells(sample), minlength=centroids**2)
        self.share = self._share(sample, k, goal)

    def apart(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distances(x[:, : self.half], self.books[0]), distances(x[:, self.half:], self.books[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        first, second = self.apart(x)
        return first.argmin(axis=1) * self.n + second.argmin(axis=1)

    def walk(self, first: np.ndarray, second: np.ndarray) -> Iterator[int]:
        """Cells by the sum of a query's two distances, nearest first."""
        one, two = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
        d1, d2, n = first[one].tolist(), second[two].tolist(), self.n
        heap, done = [(d1[0] + d2[0], 0, 0)], [0] * n  # done[i]: how many cells of the i-th row have been met
        while heap:
            _, i, j = heapq.heappop(heap)
            yield one[i] * n + two[j]
            done[i] = j + 1
            if i + 1 < n and done[i + 1] == j:
                heapq.heappush(heap, (d1[i + 1] + d2[j], i + 1, j))
            if j + 1 < n and (i == 0 or done[i - 1] > j + 1):
                heapq.heappush(heap, (d1[i] + d2[j + 1], i, j + 1))

    def met(self, first: np.ndarray, second: np.ndarray, least: float) -> list[int]:
        """The cells with rows that a query meets until they hold ``least`` rows."""
        out, held, rows = [], 0, self.rows
        for cell in self.walk(first, second):
            if rows[cell]:
                out.append(cell)
                held += int(rows[cell])
                if held >= least:
                    break
        return out

    def _share(self, sample: np.ndarray, k: int, goal: float) -> float:
        """What part of the sample its queries meet until ``goal`` of their neighbours are among it."""
        if len(sample) < 2:
            return 1.0
        own = np.unique(np.linspace(0, len(sample) - 1, min(TRIALS, len(sample))).astype(int))
        score = sample[own] @ sample.T
        score[np.arange(len(own)), own] = -2
        k = min(k, len(sample) - 1)
        best = np.argpartition(-score, k - 1, axis=1)[:, :k]
        cell, need = self.cells(sample), []
        first, second = self.apart(sample[own])
        for i in range(len(own)):
            held, at = 0, np.zeros(self.n**2)
            for c in self.met(first[i], second[i], len(sample)):
                held += int(self.rows[c])
                at[c] = held
            need.extend(at[cell[best[i]]])
        return float(np.quantile(need, goal)) / len(sample)


def blocks(rows: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, number of blocks) of every cell."""
    parts = np.maximum(1, -(-rows // block_rows))
    first = np.zeros(len(rows), dtype=np.int64)
    block = held = 0  # the block being filled, and its rows
    for cell, (n, several) in enumerate(zip(rows.tolist(), parts.tolist())):
        if held and held + n > block_rows:
            block, held = block + 1, 0
        first[cell] = block
        if several > 1:
            block += several
        else:
            held += n
    return first, parts


def rerank(x: np.ndarray, cell: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray, met: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, cosine): the k best rows of a block for each query among the rows of the
    cells it meets, and what may tie with the last of them."""
    found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
    x, q = scaled(x), scaled(q)
    ux, uq = unit(x), unit(q)
    names, place = np.unique(cell, return_inverse=True)
    for at in range(0, len(q), 128):
        rows = range(at, min(at + 128, len(q)))
        open_ = np.zeros((len(rows), len(names)), dtype=bool)
        for r, i in enumerate(rows):
            open_[r, np.searchsorted(names, met[i])] = True
        score = np.where(open_[:, place] & (ids != qids[at: at + len(rows), None]), uq[at: at + len(rows)] @ ux.T, -np.inf)
        last = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k] if k <= len(ids) else np.full(len(rows), -np.inf)
        a, b = np.nonzero((score >= (last - CLOSE)[:, None]) & (score > -np.inf))
        for whole, part in zip(found, (a + at, b, cosine(q[a + at], x[b]))):
            whole.append(part)
    return tuple(np.concatenate(f) for f in found)


def _and(df: DataFrame, more: str) -> StructType:
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def nearest(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, goal: float = 0.95,
            most_centroids: int = 256, block_rows: int = 4096, block_queries: int = 4096) -> DataFrame:
    """For every row whose id is divisible by ``every``: its k nearest other rows found.

    Returns query_id, rank, vec_id, score."""
    v = F.col(f"`{vec_col}`")
    ok = F.col(f"`{id_col}`").isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    held = vectors.filter(F.coalesce(ok, F.lit(False))).groupBy(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).agg(
        F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"))
    held = written(held.withColumn("uid", F.monotonically_increasing_id()).withColumn("h", F.xxhash64("v")), "vectors")
    same = F.dense_rank().over(Window.partitionBy("h", "v").orderBy("id"))
    entries = written(held.withColumn("nth", same).filter(F.col("nth") <= k + 1).select("id", "v", "copies", "uid", "h"), "entries")
    n, width = entries.agg(F.count("*"), F.max(F.size("v"))).first()
    asked = held.filter(F.col("id") % every == 0)
    own = asked.groupBy("id").count().agg(F.max("count")).first()[0] or 0
    width = width or 1
    drawn = entries.orderBy("h", "uid").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    sample = unit(matrix(drawn, width)) if len(drawn) else np.eye(1, width)
    centroids = int(max(1, min(most_centroids, len(sample), np.ceil(np.sqrt(n / CELL_ROWS)))))
    index = Index(sample, centroids, k, goal)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = index.cells(unit(matrix(b.column("v"), width))) if len(b) else []
            yield b.append_column("cell", pa.array(cell, pa.int32()))

    placed = written(entries.drop("h").mapInArrow(celled, _and(entries.drop("h"), "cell int")), "cells")
    rows = np.zeros(centroids**2, dtype=np.int64)
    for cell, count in placed.groupBy("cell").count().collect():  # at most most_centroids ** 2 rows
        rows[cell] = count
    index.rows = rows
    least = max(index.share * n, k + own)  # whatever the share, k rows of other ids are met
    first, parts = blocks(rows, block_rows)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = b.column("cell").to_numpy()
            block = first[cell] + b.column("uid").to_numpy() % parts[cell]
            yield b.append_column("block", pa.array(block, pa.int64()))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                b = whole.slice(at, 256)
                one, two = index.apart(unit(matrix(b.column("v"), width)))
                row, block, met = [], [], []
                for i in range(len(b)):
                    cells = np.array(index.met(one[i], two[i], least), dtype=np.int64)
                    which = np.repeat(np.arange(len(cells)), parts[cells])
                    into = first[cells][which] + np.arange(len(which)) - np.repeat(np.cumsum(parts[cells]) - parts[cells], parts[cells])
                    order = np.lexsort((cells[which], into))
                    names, begins = np.unique(into[order], return_index=True)
                    row.extend([i] * len(names))
                    block.extend(names.tolist())
                    met.extend(np.split(cells[which][order], begins[1:]))
                taken = b.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(block, pa.int64()), pa.array(met, pa.list_(pa.int32()))], [*b.schema.names, "block", "met"])

    indexed = placed.mapInArrow(dealt, _and(placed, "block long"))
    parts_of = asked.select("id", "v", "uid").withColumn("qb", F.pmod(F.xxhash64("uid"), F.lit(1 + (asked.count() - 1) // block_queries)))
    queries = parts_of.mapInArrow(walked, _and(parts_of, "block long, met array<int>"))
    return _best(indexed, queries, k, width)


def _best(indexed: DataFrame, queries: DataFrame, k: int, width: int) -> DataFrame:
    queries = written(queries, "walks")
    wanted = queries.select("block", "qb").distinct().select(F.col("block").alias("_block"), F.col("qb").alias("_qb"))
    repeated = indexed.join(wanted, F.col("block") == F.col("_block")).drop("_block")

    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if rows.num_rows and asked.num_rows:
            rows, asked = rows.combine_chunks(), asked.combine_chunks()

            def flat(t: pa.Table, c: str) -> pa.Array:
                return t[c].chunk(0)
            ids, qids = flat(rows, "id").to_numpy(), flat(asked, "id").to_numpy()
            met = [np.asarray(m) for m in flat(asked, "met").to_pylist()]
            a, b, score = rerank(matrix(flat(rows, "v"), width), flat(rows, "cell").to_numpy(), ids, matrix(flat(asked, "v"), width), qids, met, k)
            columns = [qids[a], flat(rows, "uid").to_numpy()[b], ids[b], flat(rows, "copies").to_numpy()[b], score]
        else:
            columns = [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "uid", "vec_id", "copies", "score"])

    found = repeated.groupBy("block", "_qb").cogroup(queries.groupBy("block", "qb")).applyInArrow(
        search, "query_id long, uid long, vec_id long, copies int, score double")
    once = found.groupBy("query_id", "uid", "vec_id", "copies").agg(F.max("score").alias("score"))
    each = once.select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
