"""Texts as numpy arrays of code points, for the operators that score every word
inside Arrow tasks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CHUNK = 500_000  # characters turned into arrays at a time, and
ROWS = 2_000  # texts turned into Python strings at a time: bounds a task's memory
POINTS = 0x110000
_SPACE = re.compile(r"\s")
ASCII_SPACE = re.compile(r"[\x20\x09-\x0D]")


def table(of: Callable[[int], int], kind: type) -> np.ndarray:
    """A value for every code point."""
    return np.fromiter((of(i) for i in range(POINTS)), dtype=kind, count=POINTS)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _parts(texts: list[str | None], limit: int, space: re.Pattern = _SPACE) -> Iterator[tuple[list[int], list[str]]]:
    """Rows and texts in order, in groups of about ``limit`` characters.  A text
    beyond the limit is cut after white space (``space``) into several parts (at the limit if
    it has none there)."""
    rows: list[int] = []
    parts: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        text = text or ""
        at = 0
        while True:
            end = len(text)
            if end - at > limit:
                end = at + limit
                gap = space.search(text[at: end][::-1])
                end = end - gap.start() if gap and gap.start() < limit else end
            if size and size + end - at > limit:
                yield rows, parts
                rows, parts, size = [], [], 0
            rows.append(row)
            parts.append(text[at: end])
            size += end - at + 1
            at = end
            if at >= len(text):
                break
    if rows:
        yield rows, parts


def _starts(parts: list) -> np.ndarray:
    return np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])


def chunks(texts: list[str | None], limit: int = CHUNK) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(row of each part, code points of the parts each followed by a line break,
    start of each part)."""
    for rows, parts in _parts(texts, limit):
        yield rows, codes("\n".join(parts) + "\n"), _starts(parts)


def byte_chunks(texts: list[str | None], limit: int = CHUNK, space: re.Pattern = _SPACE) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """The same in UTF-8 bytes."""
    for rows, parts in _parts(texts, limit, space):
        raw = [p.encode("utf-8", "surrogatepass") for p in parts]
        yield rows, np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8), _starts(raw)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ROWS rows."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def map_texts(docs: DataFrame, text_col: str, keep: list[str], fn: Callable[[list[str | None]], list[pa.Array]], fields: StructType) -> DataFrame:
    """``keep`` columns as the struct ``doc``, followed by ``fn``'s columns for
    each row's whole text.  The struct keeps names of extra columns apart."""
    doc = docs.select(*(F.col(f"`{c}`") for c in keep)).schema
    inside = text_col in keep and isinstance(docs.schema[text_col].dataType, StringType)  # then it is sent once
    text = [] if inside else [F.col(text_col).cast("string").alias("text")]
    slim = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("doc"), *text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column("doc").field(keep.index(text_col)) if inside else batch.column("text")
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *fn(texts.to_pylist())], names=["doc", *fields.names])

    return slim.mapInArrow(run, StructType([StructField("doc", doc), *fields.fields]))
