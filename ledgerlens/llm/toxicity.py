"""Toxicity: a support vector machine over a gap-weighted subsequence kernel.

Two strings are alike as far as they share subsequences of 3 letters, each
occurrence weighted by DECAY to the power of its span (at most SPAN letters).  A
letter put into a word, or a gap in it, only stretches some spans, so a mangled
insult stays near the insult.  Punctuation inside a white-space word is skipped,
digits that look like letters count as such, and single letters in a row form
one word ("i d i o t").

Nystroem: a string is described by its normalised kernel values with a set of
landmark words, whitened by the landmarks' own kernel matrix; a linear
squared-hinge SVM is trained on that.  Labels belong to documents, so training
goes over their sentences' words as a multiple-instance problem: a toxic
document is represented by its worst word, a clean one by all of its words, and
the worst words are chosen anew a few times.  A document's score is a logistic
calibration of its worst word's decision value and of the positive ones' sum,
fitted on training documents that the SVM has not seen, with the labels' true
proportion restored.

Because the kernel is an inner product over 3-letter features, the decision of a
word is exactly (sum over its subsequences of one table of 32**3 weights) / its
norm: scoring a text is linear in its length.  Ignoring repeated subsequences in
the norm gives an upper bound; only words whose bound reaches FLOOR get the
exact norm, and decisions below FLOOR count as FLOOR.

Training reads at most about 2 * ``per_label`` labelled documents (a documented
bound; drawn by a hash of the id at a rate from exact counts), on the driver.  Of
their words it learns from at most POSITIVES of toxic and NEGATIVES of clean
documents, takes landmarks from the first 20 * LANDMARKS of each kind, and counts a
word at most 20 times as evidence; these bound the model's training only, scores
read every word of every text.

Defined results: a null or empty text, or one without three letters in a word,
has the score of FLOOR.  Without labelled documents of both kinds the score is
the share of toxic labels (0 if there are none).  Documents labelled more than
once count as toxic if any label says so.  Repeated rows are scored alike; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from ledgerlens.llm import chars

DECAY, SPAN = 0.7, 6
LETTERS = 32  # a-z are 1 to 26, other letters share 27 to 31; 0 ends a word
SKIP = 255
FLOOR = 0.25
LANDMARKS = 160  # of each kind: insults, their look-alikes in clean texts, common words
PER_LABEL = 1500
ROUNDS = 4
ALIKE = 0.92  # kernel value beyond which a second landmark is left out
EVIDENCE = 10.0  # that a word needs to start as an insult: one chance word in e**10
POSITIVES, NEGATIVES = 3000, 6000
STEM = 5
LIKELY = 0.6  # decision value that makes the worst word of a toxic document an insult
RIDGE = 0.5
# Characters read as letters.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_SYMBOLS: list[np.ndarray] = []


def symbols() -> np.ndarray:
    """Symbol of every code point: 0 white space, SKIP neither space nor letter."""
    if not _SYMBOLS:
        def of(i: int) -> int:
            c = LOOKALIKE.get(chr(i), chr(i)).lower()
            if len(c) == 1 and "a" <= c <= "z":
                return ord(c) - 96
            return 0 if c.isspace() else 27 + i % 5 if c.isalpha() else SKIP
        _SYMBOLS.append(chars.table(of, np.uint8))
    return _SYMBOLS[0]


@dataclass
class Words:
    """Words of a chunk: letters one after the other, and where words begin."""
    letters: np.ndarray
    first: np.ndarray
    length: np.ndarray
    row: np.ndarray  # of the text
    place: np.ndarray  # of the first letter in the chunk


def words_of(rows: list[int], codes: np.ndarray, starts: np.ndarray) -> Words:
    s = symbols()[codes]
    at = np.flatnonzero(s != SKIP)
    s = s[at]
    is_letter = s > 0
    edge = np.diff(is_letter.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row = np.array(rows)[np.searchsorted(starts, at[begin], side="right") - 1] if len(begin) else np.zeros(0, dtype=np.int64)
    alone = (end - begin) == 1
    joins = np.zeros(len(begin), dtype=bool)
    joins[1:] = alone[1:] & alone[:-1] & (row[1:] == row[:-1])
    word = np.flatnonzero(~joins)
    length = end - begin
    offset = np.cumsum(length) - length
    return Words(s[is_letter], offset[word], np.add.reduceat(length, word) if len(word) else length[:0], row[word], at[begin[word]])


def norm_bounds(most: int) -> np.ndarray:
    """Squared norm, were all subsequences different, by word length."""
    n = np.arange(most + 1)
    return sum(np.maximum(n - d, 0) * (d - 1) * DECAY ** (2 * (d + 1)) for d in range(2, SPAN)) + 0.0


def table_sums(w: Words, weights: np.ndarray) -> np.ndarray:
    """Per word: the sum of decayed weights over its subsequences."""
    a = w.letters.astype(np.int32)
    total = np.zeros(len(a), dtype=np.float32)
    word = np.repeat(np.arange(len(w.first), dtype=np.int32), w.length)
    for d2 in range(2, SPAN):
        if len(a) <= d2:
            break
        inside = np.flatnonzero(word[:-d2] == word[d2:])
        ends = (a[inside] << 10) | a[inside + d2]
        part = weights.take(ends | a[inside + 1] << 5)
        for d1 in range(2, d2):
            part += weights.take(ends | a[inside + d1] << 5)
        total[inside] += part * np.float32(DECAY ** (d2 + 1))
    return np.add.reduceat(total, w.first) if len(w.first) else total


def features(word: bytes) -> dict[int, float]:
    """Subsequence -> weight of a word given as symbols."""
    out: dict[int, float] = {}
    for i in range(len(word) - 2):
        for d2 in range(2, min(SPAN, len(word) - i)):
            for d1 in range(1, d2):
                k = word[i] << 10 | word[i + d1] << 5 | word[i + d2]
                out[k] = out.get(k, 0.0) + DECAY ** (d2 + 1)
    return out


def unit(word: bytes) -> np.ndarray:
    """Normalised feature vector of a word (zero if it has no subsequence)."""
    v = np.zeros(LETTERS ** 3, dtype=np.float32)
    for k, x in features(word).items():
        v[k] = x
    n = float(np.sqrt((v * v).sum()))
    return v / np.float32(n) if n else v


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(LETTERS ** 3, dtype=np.float32))
    bias: float = -1.0
    slopes: np.ndarray = field(default_factory=lambda: np.array([0.0, 0.0, -20.0]))  # of the evidence, and 1

    def decide(self, w: Words) -> np.ndarray:
        """Decision value of every word, not below FLOOR."""
        out = np.full(len(w.first), FLOOR)
        if not len(out):
            return out
        norm = np.sqrt(norm_bounds(int(w.length.max())))[w.length]
        bound = table_sums(w, self.weights) / np.where(norm > 0, norm, 1) + self.bias
        for i in np.flatnonzero(bound >= FLOOR):
            word = w.letters[w.first[i]: w.first[i] + w.length[i]].tobytes()
            f = features(word)
            if f:
                dot, size = sum(float(self.weights[k]) * x for k, x in f.items()), sum(x * x for x in f.values())
                out[i] = max(FLOOR, dot / size ** 0.5 + self.bias)
        return out

    def judge(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(evidence, where the worst word starts or -1) per text."""
        n = len(texts)
        value, place = np.full(n, FLOOR), np.full(n, -1)
        excess, words = np.zeros(n), np.zeros(n)
        done = np.zeros(n, dtype=np.int64)  # characters of a text's earlier parts
        for rows, codes, starts in chars.chunks(texts):
            w = words_of(rows, codes, starts)
            d = self.decide(w)
            words += np.bincount(w.row, minlength=n)
            excess += np.bincount(w.row, weights=d - FLOOR, minlength=n)
            for i in np.flatnonzero(d > FLOOR):
                r = w.row[i]
                if d[i] > value[r]:
                    part = int(np.searchsorted(starts, w.place[i], side="right")) - 1
                    value[r], place[r] = d[i], done[r] + w.place[i] - starts[part]
            for r, size in zip(rows, np.diff(np.append(starts, len(codes))) - 1):
                done[r] += size
        return evidence(value, excess, words), place

    def worst_of(self, words: list[bytes]) -> tuple[float, bytes]:
        """The worst of given words, and its decision value."""
        words = [w for w in words if w]
        if not words:
            return FLOOR, b""
        length = np.array([len(w) for w in words])
        w = Words(np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum(length) - length, length, length, length)
        d = self.decide(w)
        i = int(d.argmax())
        return float(d[i]), words[i]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.slopes[:-1] + self.slopes[-1], -50, 50)))


def evidence(value: np.ndarray, excess: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What a document is judged by: its worst word, and how far decision values
    pass FLOOR per word (a long text has some doubtful word by chance).  The first
    has the wider range, so where both tell documents apart one word suffices."""
    return np.stack([12 * (np.minimum(value, 1) - FLOOR), np.log1p(1000 * excess / (words + 20))], axis=1)


def hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Squared-hinge SVM in the primal by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x.shape[1]) * RIDGE
    ridge[-1, -1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        on = y * (x @ beta) < 1
        new = np.linalg.solve(ridge + (x[on] * cost[on, None]).T @ x[on], (x[on] * cost[on, None]).T @ y[on])
        if np.allclose(new, beta, atol=1e-6):
            break
        beta = new
    return beta


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slopes and, last, the intercept by Newton steps, kept finite by a small
    ridge.  More evidence never lowers the score: a negative slope becomes 0."""
    use = np.ones(x.shape[1] + 1, dtype=bool)
    z = np.hstack([x, np.ones((len(x), 1))])
    while True:
        own = z[:, use]
        b, ridge = np.zeros(own.shape[1]), 1e-1 * np.eye(own.shape[1])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(own @ b, -50, 50)))
            step = np.linalg.solve((own * (p * (1 - p))[:, None]).T @ own + ridge, own.T @ (y - p) - ridge @ b)
            b = b + step
            if np.abs(step).max() < 1e-8:
                break
        if (b[:-1] >= 0).all():
            out = np.zeros(len(use))
            out[use] = b
            return out
        use[np.flatnonzero(use)[int(b[:-1].argmin())]] = False


def apart(words: list[bytes]) -> list[bytes]:
    """The first LANDMARKS words that are not all too much like an earlier one."""
    chosen: list[bytes] = []
    rows = np.zeros((0, LETTERS ** 3), dtype=np.float32)
    for w in words[: 20 * LANDMARKS]:
        u = unit(w)
        if u.any() and (not chosen or (rows @ u).max() < ALIKE):
            chosen.append(w)
            rows = np.vstack([rows, u])
            if len(chosen) == LANDMARKS:
                break
    return chosen


def originals(bags: list[list[bytes]], alike: float = 0.6) -> list[int]:
    """Documents without those that share most words with an earlier one (found
    by equal smallest hashes, confirmed on the words)."""
    earlier: dict[tuple[int, int], list[int]] = {}
    out = []
    for i, bag in enumerate(bags):
        keys = [(k, min((zlib.crc32(w, k) for w in bag), default=0)) for k in range(6)] if bag else []
        words = set(bag)
        if any(len(words & set(bags[j])) >= alike * len(words | set(bags[j])) for j in {j for k in keys for j in earlier.get(k, [])}):
            continue
        out.append(i)
        for k in keys:
            earlier.setdefault(k, []).append(i)
    return out


def surely(seen: list[int], toxic: int, clean: int) -> float:
    """How surely counts (clean, toxic) of something are not chance, given the
    totals: the Chernoff bound, as minus a logarithm."""
    n, p, base = sum(seen), seen[1] / sum(seen), toxic / (toxic + clean)
    return n * (p * np.log(p / base) + (1 - p) * np.log(max(1 - p, 1e-12) / (1 - base))) if p > base else 0.0


def nystroem(marks: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(description of each word, the map from subsequences to descriptions):
    kernel values with the landmarks, whitened by the landmarks' kernel matrix."""
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    kept = value > 1e-6 * value.max()
    plain = (marks.T @ (vector[:, kept] / np.sqrt(value[kept]))).astype(np.float64)
    out = np.empty((len(words), plain.shape[1]))
    for i, w in enumerate(words):
        f = features(w)
        v = np.array(list(f.values()))
        out[i] = v @ plain[list(f)] / np.sqrt((v * v).sum())
    return out, plain


def fit(texts: list[str], toxic: np.ndarray, prior: float) -> Model:
    """Train on two thirds of the documents, calibrate on the rest.  ``prior``: the
    share of toxic documents among all labelled ones."""
    bags: list[list[bytes]] = [[] for _ in texts]
    for rows, codes, starts in chars.chunks(texts):
        w = words_of(rows, codes, starts)
        raw, first = w.letters.tobytes(), w.first.tolist()
        for r, a, n in zip(w.row.tolist(), first, w.length.tolist()):
            if n >= 3:
                bags[r].append(raw[a: a + n])
    bags = [sorted(set(b)) for b in bags]
    kept = originals(bags)  # copies of a document would count its chance words as insults
    texts, toxic, bags = [texts[i] for i in kept], toxic[kept], [bags[i] for i in kept]
    train = np.arange(len(texts)) % 3 != 0
    seen: dict[bytes, list[int]] = {}
    for i in np.flatnonzero(train):
        for word in bags[i]:
            seen.setdefault(word, [0, 0])[int(toxic[i])] += 1
    n_clean, n_toxic = (max(1, int((train & (toxic == k)).sum())) for k in (0, 1))

    bad = sorted((w for w in seen if surely(seen[w], n_toxic, n_clean) > EVIDENCE), key=lambda w: (-surely(seen[w], n_toxic, n_clean), w))
    # Beginnings that toxic documents vary: words of theirs start as insults too.
    stems: dict[bytes, list[int]] = {}
    for i in np.flatnonzero(train):
        for stem, n in Counter(w[:STEM] for w in bags[i] if len(w) > STEM).items():
            stems.setdefault(stem, [0, 0])[int(toxic[i])] += min(n, 3)
    n_words = [sum(v[k] for v in stems.values()) + 1 for k in (0, 1)]
    varied = {k for k, v in stems.items() if surely(v, n_words[1], n_words[0]) > 2 * EVIDENCE and v[1] >= 15}
    known = set(bad)
    bad += sorted((w for w in seen if w[:STEM] in varied and w not in known and seen[w][1] > seen[w][0]), key=lambda w: (-seen[w][1], w))
    common = sorted((w for w in seen if seen[w][0] >= 1), key=lambda w: (-seen[w][0], w))
    if not bad or not common:
        return Model(slopes=np.array([0.0, 0.0, np.log(max(prior, 1e-9) / max(1 - prior, 1e-9))]))
    witness = set(bad[:POSITIVES])
    sure, clean_words, hard = set(witness), common[:NEGATIVES], set()
    model = Model()
    for _ in range(ROUNDS):
        positive = sorted(witness)
        negative = [w for w in dict.fromkeys([*clean_words, *sorted(hard)]) if w not in witness]
        hardest = sorted(hard - witness, key=lambda w: (-seen[w][0], w))
        marks = [unit(w) for words in (bad, hardest, [w for w in common if w not in witness]) for w in apart(words)]
        x, plain = nystroem(np.stack(marks), positive + negative)
        y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
        times = np.array([min(seen[w][1], 20) for w in positive] + [min(seen[w][0], 20) for w in negative], dtype=float)
        cost = times / np.where(y > 0, times[y > 0].sum(), times[y < 0].sum()) * len(y) / 2
        beta = hinge(x, y, cost)
        model = Model((plain @ beta[:-1]).astype(np.float32), float(beta[-1]))
        worst = [model.worst_of(bags[i]) if train[i] else (FLOOR, b"") for i in range(len(bags))]
        witness = sure | {w for i, (v, w) in enumerate(worst) if toxic[i] and v > LIKELY and seen[w][1] > seen[w][0]}
        hard |= {w for i, (v, w) in enumerate(worst) if not toxic[i] and v > FLOOR}
    held = np.flatnonzero(~train)
    slopes = logistic(model.judge([texts[i] for i in held])[0], toxic[held].astype(float))
    share = max(1e-6, min(1 - 1e-6, float(toxic[held].mean())))
    slopes[-1] += np.log(max(prior, 1e-9) / max(1 - prior, 1e-9)) - np.log(share / (1 - share))
    model.slopes = slopes
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", per_label: int = PER_LABEL) -> Model:
    known = (labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
             .agg(F.max((F.col(label_col) > 0).cast("int")).alias("_toxic")))
    rows = docs.filter(learn).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # Counts and choice over all labelled documents, without their texts.
    marked = rows.select("_id").join(known, "_id").distinct()
    sizes = {r["_toxic"]: r["count"] for r in marked.groupBy("_toxic").count().collect()}
    if len(sizes) < 2:
        return Model(slopes=np.array([0.0, 0.0, 20.0 if sizes.get(1) else -20.0]))
    draw = F.pmod(F.xxhash64("_id", F.lit("toxic")), F.lit(1_000_000))
    rate = F.when(F.col("_toxic") == 1, per_label * 1_000_000 // sizes[1]).otherwise(per_label * 1_000_000 // sizes[0])
    chosen = marked.filter(draw < rate)  # about 2 * per_label ids, so the texts need not be shuffled
    sample = rows.join(F.broadcast(chosen), "_id").orderBy("_id", "_text").collect()
    return fit([r["_text"] or "" for r in sample], np.array([r["_toxic"] for r in sample]), sizes[1] / (sizes[0] + sizes[1]))


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """doc (struct of ``keep``), score, and the worst word found (null if none)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 32**3 weights

    def run(texts: list[str | None]) -> list[pa.Array]:
        x, place = shared.value.judge(texts)
        words = [(texts[i] or "")[p:].split(maxsplit=1)[0] if p >= 0 else None for i, p in enumerate(place.tolist())]
        return [pa.array(shared.value.probability(x), pa.float64()), pa.array(words, pa.string())]

    return chars.map_texts(docs, text_col, keep, run, StructType().add("score", DoubleType()).add("worst", StringType()))
