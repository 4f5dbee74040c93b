"""Language identification of mixed-language text.

A word is a run of letters of one script.  Its script narrows the languages to
those that use it in the training texts; among them it is scored by hashed
letter 3-grams and 5-grams (naive Bayes).  Viterbi over a text's words, with a
penalty for changing the language, labels every word; runs of equal labels are
the spans.  A text's language is the one with the most letters, its score the
share of letters labelled so.

Training counts n-grams inside Spark over at most about ``per_language`` texts of
each language (a documented bound: texts are drawn by a hash of the id at a rate
from the exact counts); what reaches the driver is the model, whose size depends
on the number of languages only.

Defined results: ``und`` with score 0 for a null text, a text without letters, or
if no language was learned.  A text whose scripts no learned language uses gets
the first learned language with score 0.  Ties go to the smaller language name.
Repeated rows and extra columns are kept as they are; an empty table gives no
rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructType

from ledgerlens.llm import chars

UNKNOWN = "und"
BUCKETS = 1 << 16
PER_LANGUAGE = 1500
PENALTY = 12.0
WEIGHT = 0.5  # the n-grams of a word overlap
MINOR = 0.01  # a language uses a script if so many of its training letters are in it
GROUP = 16_000_000  # characters whose words are labelled together

# First and last code point of the scripts told apart.
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F),
    ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F),
    ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF), ("han", 0x20000, 0x3134F),
)
NAMES = ["", "other", *dict.fromkeys(s for s, _, _ in SCRIPTS)]  # by number; 0: no letter

_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(script number, lower-cased code point) of every code point."""
    if not _TABLES:
        script = np.zeros(chars.POINTS, dtype=np.uint8)
        for i in range(chars.POINTS):
            if unicodedata.category(chr(i))[0] in "LM":
                script[i] = 1
        for name, first, last in SCRIPTS:
            part = script[first: last + 1]
            part[part > 0] = NAMES.index(name)
        lower = np.arange(chars.POINTS, dtype=np.uint32)
        for i in np.flatnonzero(script):
            low = chr(i).lower()
            if len(low) == 1:
                lower[i] = ord(low)
        _TABLES["script"], _TABLES["lower"] = script, lower
    return _TABLES["script"], _TABLES["lower"]


@dataclass
class Words:
    at: np.ndarray  # start in the chunk
    end: np.ndarray
    script: np.ndarray
    grams: np.ndarray  # (letters, 2) buckets
    first: np.ndarray  # a word's first letter


def words_of(codes: np.ndarray) -> Words:
    script_of, lower = _tables()
    script = script_of[codes]
    edge = np.flatnonzero(np.diff(script, prepend=np.uint8(0), append=np.uint8(0)))
    at, end = edge[:-1], edge[1:]
    kept = script[at] > 0 if len(at) else np.zeros(0, dtype=bool)
    at, end = at[kept], end[kept]
    letter = script > 0
    c = np.where(letter, lower[codes], np.uint32(0))
    # A letter's neighbours inside its word: a change of script ends the word too.
    same = np.zeros(len(c) + 1, dtype=bool)
    same[1:-1] = (script[1:] == script[:-1]) & letter[1:]
    before = np.where(same[:-1], np.roll(c, 1), 0).astype(np.uint32)
    after = np.where(same[1:], np.roll(c, -1), 0).astype(np.uint32)
    before2 = np.where(before > 0, np.roll(before, 1), 0).astype(np.uint32)
    after2 = np.where(after > 0, np.roll(after, -1), 0).astype(np.uint32)
    i = np.flatnonzero(letter)
    h = c[i] * np.uint32(0x9E3779B1) ^ before[i] * np.uint32(0x85EBCA77) ^ after[i] * np.uint32(0xC2B2AE3D)
    g = h ^ before2[i] * np.uint32(0x27D4EB2F) ^ after2[i] * np.uint32(0x165667B1)
    buckets = [((x ^ x >> np.uint32(15)) * np.uint32(0x2C1B3C6D)) >> np.uint32(16) for x in (h, g)]
    length = end - at
    return Words(at, end, script[at], np.stack(buckets, axis=1), np.cumsum(length) - length)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (2, buckets, languages)
    uses: np.ndarray  # (scripts, languages): 0 if used, else a large negative number

    def scores(self, w: Words) -> np.ndarray:
        """(words, languages)"""
        if not len(w.at):
            return np.zeros((0, len(self.languages)), dtype=np.float32)
        per = self.weights[0].take(w.grams[:, 0], axis=0)
        per += self.weights[1].take(w.grams[:, 1], axis=0)
        s = np.add.reduceat(per, w.first, axis=0) + self.uses[w.script]
        known = (self.uses[w.script] == 0).any(axis=1)
        return np.where(known[:, None], s, 0).astype(np.float32)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Best label of every word, for many texts at once: ``scores`` holds the
    texts' words one after the other, ``lengths`` their numbers of words.

    Step t handles the t-th word of all texts that have one.  Leaving a label
    costs the penalty whatever the next one is, so a label's best predecessor is
    itself or the best of all."""
    n, labels = scores.shape
    if labels > np.iinfo(np.uint16).max:
        raise ValueError(f"{labels} languages are more than a label can name")
    out = np.zeros(n, dtype=np.uint16)
    if not n or labels < 2:
        return out
    order = np.argsort(-lengths, kind="stable")
    order = order[: int((lengths > 0).sum())]
    start = (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths[order[0]])
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")  # texts with more than t words
    base = np.cumsum(active) - active
    value = np.zeros((len(order), labels), dtype=np.float32)
    stays = np.empty((n, labels), dtype=bool)
    came = np.empty(n, dtype=np.uint16)
    for t in range(longest):
        a, b = int(active[t]), int(base[t])
        v = value[:a]
        best = v.argmax(axis=1)
        leave = v[np.arange(a), best] - penalty
        stays[b: b + a] = v >= leave[:, None]
        came[b: b + a] = best
        np.maximum(v, leave[:, None], out=v)
        v += scores[start[:a] + t]
        v -= v.max(axis=1, keepdims=True)
    label = value.argmax(axis=1).astype(np.uint16)
    for t in range(longest - 1, -1, -1):
        a, b = int(active[t]), int(base[t])
        now = label[:a]
        out[start[:a] + t] = now
        label[:a] = np.where(stays[b + np.arange(a), now], now, came[b: b + a])
    return out


def _counted(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, feature, n): buckets of 3-grams, of 5-grams, then letters by script."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in chars.sliced(batches):
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name in sorted(set(names)):
                mine = total.setdefault(name, np.zeros(2 * BUCKETS + len(NAMES), dtype=np.int64))
                for _, codes, _ in chars.chunks([t for t, n in zip(texts, names) if n == name]):
                    w = words_of(codes)
                    for k in (0, 1):
                        mine[k * BUCKETS: (k + 1) * BUCKETS] += np.bincount(w.grams[:, k], minlength=BUCKETS)
                    mine[2 * BUCKETS:] += np.bincount(w.script, weights=w.end - w.at, minlength=len(NAMES)).astype(np.int64)
        for name, mine in total.items():
            f = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(f), pa.string()), pa.array(f, pa.int64()), pa.array(mine[f], pa.int64())], names=["lang", "feature", "n"])

    rows = docs.select(F.col(lang), F.col(text)).mapInArrow(count, "lang string, feature long, n long")
    return rows.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    usable = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in usable.groupBy(lang_col).count().collect()}  # one row per language
    draw = F.pmod(F.xxhash64(id_col, F.lit("lang")), F.lit(1_000_000))
    rate = F.coalesce(*(F.when(F.col(lang_col) == k, F.lit(per_language * 1_000_000 // n)) for k, n in sizes.items()), F.lit(0))
    rows = _counted(usable.filter(draw < rate), lang_col, text_col).collect() if sizes else []
    languages = sorted({r["lang"] for r in rows})
    counts = np.zeros((len(languages), 2 * BUCKETS + len(NAMES)))
    for r in rows:
        counts[languages.index(r["lang"]), r["feature"]] = r["n"]
    grams = counts[:, : 2 * BUCKETS].reshape(len(languages), 2, BUCKETS) + 0.5
    weights = np.log(grams / grams.sum(axis=2, keepdims=True)) * WEIGHT / 2
    letters = counts[:, 2 * BUCKETS:]
    share = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
    uses = np.where(share >= MINOR, 0.0, -1e4).T
    return Model(languages, np.ascontiguousarray(weights.transpose(1, 2, 0), dtype=np.float32), uses.astype(np.float32))


def label_texts(model: Model, texts: list[str | None], spans: bool) -> list[pa.Array]:
    n, labels = len(texts), len(model.languages)
    letters = np.zeros((n, max(1, labels)), dtype=np.int64)
    known = np.zeros(n, dtype=bool)
    found: list[list] = [[] for _ in range(n)]
    group: list[tuple] = []

    def finish() -> None:
        """Label the words gathered so far (whole texts only)."""
        if not group or not labels:
            group.clear()
            return
        row, at, end, scores, fits = (np.concatenate(x) for x in zip(*group))
        group.clear()
        names, lengths = np.unique(row, return_counts=True)
        label = viterbi(scores, lengths)
        np.add.at(letters, (row, label), end - at)
        known[row[fits]] = True
        if spans:
            cut = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(label.astype(np.int32), prepend=-1) != 0))
            last = np.append(cut[1:], len(row)) - 1
            for r, s, e, k in zip(row[cut].tolist(), at[cut].tolist(), end[last].tolist(), label[cut].tolist()):
                found[r].append({"start": s, "end": e, "lang": model.languages[k]})

    size, previous, shift = 0, -1, 0
    for rows, codes, starts in chars.chunks(texts):
        if size > GROUP and rows[0] != previous:
            finish()
            size = 0
        w = words_of(codes)
        part = np.searchsorted(starts, w.at, side="right") - 1
        ends = np.append(starts[1:], len(codes)) - 1
        before = np.zeros(len(rows), dtype=np.int64)  # characters of a row's earlier parts
        for i, r in enumerate(rows):
            before[i] = shift if r == previous else 0
            shift = int(before[i] + ends[i] - starts[i])
            previous = r
        move = before[part] - starts[part]
        fits = (model.uses[w.script] == 0).any(axis=1) if labels else np.zeros(len(w.at), dtype=bool)
        group.append((np.array(rows)[part], w.at + move, w.end + move, model.scores(w), fits))
        size += len(codes)
    finish()
    total = letters.sum(axis=1)
    best = letters.argmax(axis=1)
    score = np.where(known, letters[np.arange(n), best] / np.maximum(total, 1), 0.0)
    names = [model.languages[b] if labels and t else UNKNOWN for b, t in zip(best.tolist(), total.tolist())]
    out = [pa.array(names, pa.string()), pa.array(score, pa.float64())]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
    return out + [pa.array(found, kind)] if spans else out


def identify(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", spans: bool = True) -> DataFrame:
    """doc (struct of ``keep``), lang_pred, score[, spans of words in one language]."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size: languages x 2 x BUCKETS floats
    fields = StructType().add("lang_pred", StringType()).add("score", DoubleType())
    if spans:
        span = StructType().add("start", IntegerType()).add("end", IntegerType()).add("lang", StringType())
        fields = fields.add("spans", ArrayType(span))
    return chars.map_texts(docs, text_col, keep, lambda texts: label_texts(shared.value, texts, spans), fields)
