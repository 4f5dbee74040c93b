"""Secret scan over a trigram inverted index.

Every rule is a regular expression.  From its parse tree comes a Boolean query
over trigrams (lower-cased): the trigrams that any match must contain, as an AND
of ORs of ANDs.  The index holds postings only for trigrams that some query
asks for.  Intersecting a rule's postings leaves its candidate documents, and
only those are searched with the regular expression.  A rule without mandatory
trigrams (``hex``) is searched in every document.

The index is a table of (trigram, document) postings.  Postings go by document
key, so documents repeated under one id share theirs: candidates are then a
superset, and the search decides.

Spans are leftmost non-overlapping matches per kind, in code points, end
exclusive; a match that fails its rule's condition is dropped and not retried.
Positions come from the pieces between matches, so a text is cut once per rule.

Defined results: a null text is the empty text, without spans; documents without
an id are searched without the index.  Repeated rows give repeated rows, an
empty table none; extra columns are ignored (``mask`` keeps them).
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # the group whose length counts
    least: int = 0
    base: bool = False


# The base rules first, in the order kinds are listed.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
    Rule("bearer", r"(?i)bearer\x20+([A-Za-z0-9+/_.=-]+)", 1, 16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 30),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
MOST_TEXTS = 64  # alternatives spelled out before a part counts as unknown

# A query is a set of alternatives, each a set of trigrams that must all occur.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset({frozenset()})


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _both(a: Query, b: Query) -> Query:
    return frozenset(x | y for x, y in product(a, b)) if len(a) * len(b) <= MOST_TEXTS else min(a, b, key=len)


def _texts(node) -> set[str] | None:
    """All texts a parsed node matches, if they are few; else None."""
    op, arg = node
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= 8:
        return {chr(v).lower() for _, v in arg}
    if op is C.SUBPATTERN:
        return _joined(arg[-1])
    if op is C.BRANCH:
        parts = [_joined(b) for b in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op is C.MAX_REPEAT and arg[1] is not C.MAXREPEAT and arg[1] <= 2:
        inner = _joined(arg[2])
        return None if inner is None else {"".join(t) for n in range(arg[0], arg[1] + 1) for t in product(inner, repeat=n)}
    return None


def _joined(nodes) -> set[str] | None:
    out = {""}
    for n in nodes:
        t = _texts(n)
        if t is None or len(out) * len(t) > MOST_TEXTS:
            return None
        out = {a + b for a in out for b in t}
    return out


def _query(nodes) -> Query:
    """Trigrams that every match of a sequence of nodes contains."""
    found, run = ANY, {""}

    def close(query: Query, texts: set[str]) -> Query:
        return _both(query, frozenset(map(trigrams, texts)))

    for n in nodes:
        t = _texts(n)
        if t is not None and len(run) * len(t) <= MOST_TEXTS:
            run = {a + b for a in run for b in t}
            continue
        found, run = close(found, run), {""}
        op, arg = n
        if t is not None:
            run = t
        elif op is C.SUBPATTERN:
            found = _both(found, _query(arg[-1]))
        elif op is C.BRANCH:
            found = _both(found, frozenset().union(*map(_query, arg[1])))
        elif op is C.MAX_REPEAT and arg[0] > 0:
            found = _both(found, _query(arg[2]))
    found = close(found, run)
    return ANY if frozenset() in found else frozenset(q for q in found if not any(p < q for p in found))


def trigram_query(pattern: str) -> Query:
    return _query(list(parser.parse(pattern)))


def candidates(docs: DataFrame, key: str, text: str, rules=RULES) -> DataFrame:
    """(_k, kinds): for every key with a candidate, the kinds to search it for.

    The postings table is written; a rule's alternatives are intersected by
    counting, per document, how many of their trigrams have it in their list."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) != ANY}
    needed = sorted(set().union(*(t for q in queries.values() for t in q)))
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    present = F.filter(F.array(*(F.when(F.contains(F.col("_low"), F.lit(t)), F.lit(t)) for t in needed)), lambda t: t.isNotNull())
    postings = (docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("_k"), low.alias("_low"))
                .select("_k", F.explode(present).alias("trigram")))
    postings = written(postings, "postings")
    terms = [(kind, alt) for kind, q in queries.items() for alt in sorted(q, key=sorted)]
    counts = postings.groupBy("_k").agg(*(F.bool_or(F.col("trigram") == t).alias(f"t{i}") for i, t in enumerate(needed)))
    has = {t: F.col(f"t{i}") for i, t in enumerate(needed)}

    def met(kind: str) -> Column:
        out = F.lit(False)
        for k, alt in terms:
            if k == kind:
                every = F.lit(True)
                for t in sorted(alt):
                    every = every & has[t]
                out = out | every
        return out

    kinds = F.filter(F.array(*(F.when(met(k), F.lit(k)) for k in queries)), lambda k: k.isNotNull())
    return counts.select("_k", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def _spans(rule: Rule, rank: int, text: Column) -> Column:
    """array<struct<start, rank, end, kind>> of one rule's matches."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    gaps = F.split(text, rule.pattern, -1)
    found = F.zip_with(F.slice(gaps, F.lit(1), F.size(whole)), F.arrays_zip(whole.alias("m"), counted.alias("c")), lambda g, m: F.struct(
        F.char_length(g).alias("gap"), F.char_length(m["m"]).alias("len"), F.char_length(m["c"]).alias("counted")))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>").alias("out"))

    def step(s: Column, m: Column) -> Column:
        start = s["at"] + m["gap"]
        end = start + m["len"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        keep = F.when(m["counted"] >= rule.least, F.concat(s["out"], F.array(span))).otherwise(s["out"])
        return F.struct(end.alias("at"), keep.alias("out"))

    return F.aggregate(found, state, step, lambda s: s["out"])


def _searchable(rule: Rule) -> Rule:
    """A lone class repeated: its shortest kept run is mandatory, so short runs
    never become matches at all (greedy runs are maximal: same spans)."""
    tree = list(parser.parse(rule.pattern))
    alone = len(tree) == 1 and tree[0][0] is C.MAX_REPEAT and tree[0][1][1] is C.MAXREPEAT and tree[0][1][2][0][0] is C.IN
    return Rule(rule.kind, f"{rule.pattern[:-1]}{{{rule.least},}}", 0, 0, rule.base) if alone and rule.least else rule


def with_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc`` with ``spans``:
    array<struct<start, rank, end, kind>>, sorted by start, then kind as listed.

    ``docs`` must be read from files: the index and the search read it once each."""
    found = candidates(docs, id_col, text_col, rules)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(id_col).alias("_key"))
    rows = rows.join(found, F.col("_key") == F.col("_k"), "left")
    text, spans = F.coalesce(F.col("doc")[text_col], F.lit("")), []
    for rank, rule in enumerate(rules):
        every = trigram_query(rule.pattern) == ANY
        asked = F.lit(True) if every else F.col("_key").isNull() | F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        rule = _searchable(rule)
        hit = asked & text.rlike(rule.pattern)
        spans.append(F.when(hit, _spans(rule, rank, text)).otherwise(
            F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")))
    return rows.select("doc", F.sort_array(F.concat(*spans)).alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    base = [r.kind for r in rules if r.base]
    rows = with_spans(docs.select(id_col, text_col), id_col, text_col, rules).withColumn(
        "base", F.filter("spans", lambda s: s["kind"].isin(base)))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(F.col("doc")[id_col].alias("doc_id"), *map(count, base),
                       F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, by: str = "[SECRET]") -> DataFrame:
    """docs with every span in ``text_col`` replaced (overlapping spans once);
    (documents, all columns unchanged otherwise)."""
    rows = with_spans(docs, id_col, text_col, rules)
    text = F.col("doc")[text_col]
    # Walk the sorted spans: copy what lies before a span that starts past the covered end, then the mark.
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, p: Column) -> Column:
        piece = F.concat(F.substring(text, s["at"] + 1, p["start"] - s["at"]), F.lit(by))
        return F.struct(F.greatest(s["at"], p["end"]).alias("at"),
                        F.when(p["start"] >= s["at"], F.concat(s["out"], F.array(piece))).otherwise(s["out"]).alias("out"))

    masked = F.aggregate("spans", state, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.char_length(text))))
    new = F.when(F.size("spans") > 0, masked).otherwise(text)
    return rows.select(*(new.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns))
