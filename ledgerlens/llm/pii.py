"""Personal data: base patterns, and a skip-chain conditional random field.

Base spans (email, ip, card, phone) are leftmost non-overlapping matches per kind
that pass their check; a failing match is dropped and not retried.

The field's nodes are a document's white-space words with a digit or an ``@``,
and words that repeat a found address's local part.  A node's label is one of the
kinds or none.  Potentials: a log-linear node model (shape, length, neighbours;
never the base match itself), transitions between adjacent words, and skip edges
between repeated or similar words of the document (same text, same digits, same
last digits, same local part), whose shared potential rewards equal labels.  Words
inside base spans are clamped to their kind.  Loopy sum-product message passing
runs on all documents of an Arrow batch at once; words whose marginal for a kind
reaches SURE become added spans (adjacent ones of a kind are one span), so a
number that is written differently the second time, or a handle, is found through
its first occurrence.  Skip edges join an occurrence to the next one and to the first
one inside a base span, so evidence does not pass hop by hop and the work is
linear in the text.

All weights are learned from the corpus with the base spans as labels (a word
outside them that is joined to one has no label and is not counted), on the
driver, from at most about ``sample`` documents (a documented bound; drawn by a
hash of the id at a rate from an exact count).

Defined results: a null text is the empty text, without spans.  Without training
documents nothing is added to the base spans.  Repeated rows give equal spans,
an empty table no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructType

from ledgerlens.llm import chars

KINDS = ("email", "ip", "card", "phone")  # in the order they are listed
NONE = len(KINDS)
LABELS = NONE + 1
SAMPLE = 4000
SURE = 0.9
SWEEPS, SETTLED, DAMPING = 200, 1e-5, 0.3  # sweeps at most, unless no message changes by more
FEATURES = 1 << 12
STRONGEST = 5.0  # limit of a skip edge's log-odds

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGIT = re.compile(r"[0-9]")
CHARS = 1_000_000  # characters of the texts whose nodes a task holds at a time
LONGEST = 50_000  # characters of a text to learn from
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9.]+")
WORD = re.compile(r"\S+")
EDGE = "\"'()[]{}<>.,;:!?*#$&|"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match goes from the start of the run of local characters before an ``@`` (or
    from the end of the match before): if it fails there, the domain fails, and so
    does every later start.  One attempt per ``@`` keeps long runs linear."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m.span()
        end = m.end() if m else at + 1
        at = text.find("@", end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    if DIGIT.search(text):
        for run in DOTTED.finditer(text):
            if run[0].count(".") >= 3:
                for m in IP.finditer(text, run.start(), run.end()):
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                        out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


@dataclass
class Node:
    start: int
    end: int
    text: str  # without punctuation around it
    label: int  # of the base span it lies in, or NONE
    clamped: bool
    before: str
    after: str
    adjacent: bool  # the previous node is the previous word


def nodes_of(text: str, spans: list[tuple[int, int, int]]) -> list[Node]:
    handles = {text[s:e].split("@")[0].lower() for s, k, e in spans if k == 0}
    if not spans and "@" not in text and not DIGIT.search(text):
        return []
    words = list(WORD.finditer(text))
    starts = np.array([w.start() for w in words])
    holds = {i for i, w in enumerate(words) if "@" in w[0] or DIGIT.search(w[0]) or (handles and w[0].strip(EDGE).lower() in handles)}
    owner: dict[int, int] = {}
    for s, k, e in reversed(spans):  # an earlier span, or an earlier kind, wins
        first = max(0, int(np.searchsorted(starts, s, side="right")) - 1)
        for i in range(first, int(np.searchsorted(starts, e))):
            if words[i].end() > s:
                owner[i] = k
    out, previous = [], -2
    for i in sorted(holds | owner.keys()):
        w = words[i]
        left = len(w[0]) - len(w[0].lstrip(EDGE))
        core = w[0].strip(EDGE) or w[0]
        start = w.start() + (left if w[0].strip(EDGE) else 0)
        out.append(Node(start, start + len(core), core, owner.get(i, NONE), i in owner,
                        words[i - 1][0] if i else "", words[i + 1][0] if i + 1 < len(words) else "", previous == i - 1))
        previous = i
    return out


def _shape(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1+", re.sub(r"[0-9]", "9", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", word[:60]))))


def node_features(n: Node) -> list[int]:
    digits = sum(c.isdigit() for c in n.text)
    said = ["bias", f"shape={_shape(n.text)}", f"digits={min(digits, 20)}", f"dots={min(n.text.count('.'), 5)}", f"at={'@' in n.text}",
            f"length={min(len(n.text), 40) // 2}", f"before={_shape(n.before)}", f"after={_shape(n.after)}", f"said={n.before.lower()[-12:]}"]
    return [zlib.crc32(s.encode()) % FEATURES for s in said]


def keys_of(n: Node) -> list[tuple[str, str]]:
    """(type, key): nodes of a document with an equal key are joined."""
    digits = "".join(c for c in n.text if c.isdigit())
    out = [("text", n.text.lower())]
    if len(digits) >= 6:
        out.append(("digits", digits))
    if len(digits) >= 7:
        out.append(("tail", digits[-7:]))
    if "@" in n.text or any(c.isalpha() for c in n.text):
        out.append(("handle", n.text.lower().split("@")[0]))
    return out


TYPES = ("text", "digits", "tail", "handle")


def edges_of(nodes: list[Node]) -> list[tuple[int, int, int]]:
    """(node, other node, edge type): skip edges by TYPES to the previous node with
    the key and to its hub, the first one inside a base span; then adjacency."""
    out, last, hub = [], {}, {}
    keys = [keys_of(n) for n in nodes]
    for i, n in enumerate(nodes):
        if n.clamped:
            for k in keys[i]:
                hub.setdefault(k, i)
    for i, n in enumerate(nodes):
        joined = {i}
        for k in keys[i]:
            for j in (last.get(k), None if n.clamped else hub.get(k)):
                if j is not None and j not in joined:
                    joined.add(j)
                    out.append((j, i, TYPES.index(k[0])))
            last[k] = i
        if n.adjacent and i:
            out.append((i - 1, i, len(TYPES)))
    return out


@dataclass
class Field:
    weights: np.ndarray  # (features, labels)
    skip: np.ndarray  # log-odds of equal labels by skip type
    follow: np.ndarray  # (labels, labels)

    def pairwise(self) -> np.ndarray:
        """(edge types, labels, labels) log potentials."""
        return np.stack([*(w * np.eye(LABELS) for w in self.skip), self.follow])

    def marginals(self, unary: np.ndarray, edges: np.ndarray, owner: np.ndarray | None = None) -> np.ndarray:
        """Loopy sum-product in logarithms: (nodes, labels) probabilities.  ``owner``:
        the document of every node; a document's messages stop when its own have
        settled, whatever others are in the batch."""
        n = len(unary)
        if len(edges):
            a, b, kind = edges.T
            source, target = np.concatenate([a, b]), np.concatenate([b, a])
            pair = self.pairwise()[kind]
            pair = np.concatenate([pair, pair.transpose(0, 2, 1)])  # [message, source label, target label]
            back = np.concatenate([np.arange(len(a), 2 * len(a)), np.arange(len(a))])
            message = np.zeros((len(source), LABELS))
            of = np.unique(owner[source], return_inverse=True)[1] if owner is not None else np.zeros(len(source), dtype=int)
            going = np.ones(of.max() + 1, dtype=bool)
            for _ in range(SWEEPS):
                belief = unary.copy()
                np.add.at(belief, target, message)
                out = belief[source] - message[back]
                new = _logsum(out[:, :, None] + pair, 1)
                new -= _logsum(new, 1)[:, None]
                new = DAMPING * message + (1 - DAMPING) * new
                moved = np.zeros(len(going))
                np.maximum.at(moved, of, np.abs(new - message).max(axis=1))
                message = np.where(going[of][:, None], new, message)
                going &= moved >= SETTLED
                if not going.any():
                    break
            unary = unary.copy()
            np.add.at(unary, target, message)
        return np.exp(unary - _logsum(unary, 1)[:, None]) if n else unary


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def learn(texts: list[str]) -> Field | None:
    """Node model by gradient steps on the log-likelihood, edge potentials from
    counts of equal and of following labels."""
    rows, labels = [], []
    same, apart = np.ones(len(TYPES)), np.ones(len(TYPES))
    follow = np.ones((LABELS, LABELS))
    for text in texts:
        nodes = nodes_of(text, base_spans(text))
        seen = {k for n in nodes if n.clamped for k in keys_of(n)}
        known = [n.clamped or seen.isdisjoint(keys_of(n)) for n in nodes]
        rows += [node_features(n) for n, sure in zip(nodes, known) if sure]
        labels += [n.label for n, sure in zip(nodes, known) if sure]
        for i, j, kind in edges_of(nodes):
            if not (known[i] and known[j]):
                continue
            if kind < len(TYPES):
                equal = nodes[i].label == nodes[j].label
                for of, _ in set(keys_of(nodes[i])) & set(keys_of(nodes[j])):  # every key they share tells of its type
                    same[TYPES.index(of)] += equal
                    apart[TYPES.index(of)] += not equal
            else:
                follow[nodes[i].label, nodes[j].label] += 1
    if not rows:
        return None
    x, y = np.array(rows), np.eye(LABELS)[labels]
    w, step = np.zeros((FEATURES, LABELS)), np.zeros((FEATURES, LABELS))
    for _ in range(150):  # adaptive steps: rare shapes learn as well as common ones
        z = w[x].sum(axis=1)
        p = np.exp(z - _logsum(z, 1)[:, None])
        grad = np.zeros_like(w)
        np.add.at(grad, x.ravel(), np.repeat(y - p, x.shape[1], axis=0))
        grad -= 0.1 * w
        step += grad * grad
        w += 0.5 * grad / np.sqrt(step + 1e-8)
    share = follow / follow.sum(axis=1, keepdims=True)
    base = follow.sum(axis=0) / follow.sum()
    return Field(w, np.clip(np.log(same / apart), 0, STRONGEST), np.log(share / base))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, longest: int = LONGEST) -> Field | None:
    """Weights learned from about ``sample`` texts of at most ``longest`` characters, drawn by hash."""
    usable = docs.filter(F.col(text_col).rlike("[0-9@]") & (F.char_length(text_col) <= longest))
    total = docs.filter(F.col(text_col).isNotNull()).count()
    draw = F.pmod(F.xxhash64(id_col, F.lit("pii")), F.lit(1_000_000))
    rows = usable.filter(draw < sample * 1_000_000 // max(total, 1)).select(id_col, text_col)
    return learn([r[1] for r in sorted(rows.collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1]))])


def find(field: Field | None, texts: list[str | None]) -> list[list[tuple[int, int, int, bool]]]:
    """(start, kind number, end, base) spans of every text, sorted."""
    found: list[list[tuple[int, int, int, bool]]] = []
    nodes: list[Node] = []
    owner: list[int] = []
    edges: list[tuple[int, int, int]] = []
    for row, text in enumerate(texts):
        spans = base_spans(text or "")
        found.append([(*s, True) for s in spans])
        if field is not None:
            own = nodes_of(text or "", spans)
            if any(not n.clamped for n in own):
                at = len(nodes)
                edges += [(i + at, j + at, kind) for i, j, kind in edges_of(own)]
                nodes += own
                owner += [row] * len(own)
    if not nodes:
        return found
    unary = field.weights[np.array([node_features(n) for n in nodes])].sum(axis=1)
    unary -= _logsum(unary, 1)[:, None]
    held = np.array([n.clamped for n in nodes])
    truth = np.array([n.label for n in nodes])
    unary[held] = -1e6  # whatever number of nodes a hub has
    unary[held, truth[held]] = 0.0
    p = field.marginals(unary, np.array(edges, dtype=np.int64).reshape(-1, 3), np.array(owner))
    kind, sure = p[:, :NONE].argmax(axis=1), p[:, :NONE].max(axis=1) >= SURE
    open_row, open_kind = -1, -1  # of the added span that may go on
    for i, n in enumerate(nodes):
        row, base = owner[i], found[owner[i]]
        if not sure[i] or n.clamped or any(s < n.end and n.start < e and b for s, _, e, b in base):
            open_row = -1
            continue
        if n.adjacent and (open_row, open_kind) == (row, kind[i]):
            s, k, _, b = base.pop()
            base.append((s, k, n.end, b))
        else:
            base.append((n.start, int(kind[i]), n.end, False))
        open_row, open_kind = row, kind[i]
    return [sorted(f) for f in found]


def with_spans(docs: DataFrame, field: Field | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """doc (struct of ``keep``), spans: array<struct<start, end, kind, base>>."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # FEATURES x LABELS weights
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())]))

    def parts(texts: list[str | None]) -> Iterator[list[str | None]]:
        first = size = 0
        for i, t in enumerate(texts):
            if i > first and size + len(t or "") > CHARS:
                yield texts[first:i]
                first, size = i, 0
            size += len(t or "")
        yield texts[first:]

    def run(texts: list[str | None]) -> list[pa.Array]:
        rows = [[{"start": s, "end": e, "kind": KINDS[k], "base": b} for s, k, e, b in spans]
                for part in parts(texts) for spans in find(shared.value, part)]
        return [pa.array(rows, kind)]

    span = StructType().add("start", IntegerType()).add("end", IntegerType()).add("kind", StringType()).add("base", BooleanType())
    return chars.map_texts(docs, text_col, keep, run, StructType().add("spans", ArrayType(span)))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    rows = with_spans(docs, train(docs, id_col, text_col, sample), [id_col], text_col)
    rows = rows.withColumn("base", F.filter("spans", lambda s: s["base"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(F.col("doc")[id_col].alias("doc_id"), *map(count, KINDS), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                       listed(F.col("spans")).alias("spans"))

