"""Source-system detection and column mapping.

Headers are schema metadata: Spark keeps them on the driver (``df.columns``),
so scoring a header against the mapping is a small DataFrame job over the
header names (one row per file and column), and renaming is a projection.  No
data row goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens import config as C

SYSTEMS = tuple(C.ERP_MAPPINGS)


def mapping_frame(spark: SparkSession, entity: str = "sales_transactions") -> DataFrame:
    """(system, system_order, entry_order, universal, source) for every mapping entry."""
    rows = [(sys_name, i, j, uni, src)
            for i, (sys_name, m) in enumerate(C.ERP_MAPPINGS.items())
            for j, (uni, src) in enumerate(m.get(entity, {}).items())]
    return spark.createDataFrame(
        rows, "system string, system_order int, entry_order int, universal string, source string")


def header_frame(spark: SparkSession, headers: Mapping[str, Iterable[str]]) -> DataFrame:
    """(file, column) for each file's header."""
    rows = [(f, i, c) for f, cols in headers.items() for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "file string, position int, column string")


def detect_source(headers: DataFrame, mapping: DataFrame) -> DataFrame:
    """Best-matching source system per file.

    Score = number of mapping entries (repeats counted) whose source column is
    in the header; ties go to the earlier system; no match at all still picks
    the first system.  Confidence = score / entries, low below 0.5."""
    cols = headers.select("file", "column").distinct()
    hits = (mapping.join(cols, mapping.source == cols.column)
                   .groupBy("file", "system").agg(F.count(F.lit(1)).alias("matches")))
    entries = mapping.groupBy("system", "system_order").agg(F.count(F.lit(1)).alias("entries"))
    # every (file, system) pair: the systems are a fixed list, exploded per file
    systems = F.explode(F.array(*[F.lit(x) for x in C.ERP_MAPPINGS])).alias("system")
    scored = (headers.select("file").distinct().select("file", systems)
                     .join(F.broadcast(entries), "system")
                     .join(hits, ["file", "system"], "left")
                     .withColumn("matches", F.coalesce("matches", F.lit(0)).cast("bigint")))
    w = Window.partitionBy("file").orderBy(F.col("matches").desc(), F.col("system_order"))
    best = scored.withColumn("rk", F.row_number().over(w)).where("rk = 1")
    conf = F.col("matches") / F.col("entries")
    return best.select("file", "system", "matches", F.col("entries").cast("bigint").alias("entries"),
                       F.round(conf, 4).alias("confidence"),
                       (conf < C.LOW_CONFIDENCE).alias("low_confidence"))


def detect_system(columns: Iterable[str]) -> tuple[str, float]:
    """The same rule for one header already on the driver (schema metadata)."""
    present = set(columns)
    best, best_score = next(iter(C.ERP_MAPPINGS)), -1
    for name in C.ERP_MAPPINGS:
        m = C.ERP_MAPPINGS[name].get("sales_transactions", {})
        score = sum(1 for src in m.values() if src in present)
        if score > best_score:
            best, best_score = name, score
    return best, best_score / len(C.ERP_MAPPINGS[best]["sales_transactions"])


# -- fuzzy header matching: token-sort ratio (indel similarity) ---------------

def _process(s: str) -> str:
    """ASCII letters, digits and underscores in lower case; other ASCII characters
    count as blanks, the rest is left out; outer blanks are trimmed."""
    return "".join(c if c.isalnum() or c == "_" else " " for c in s if c.isascii()).lower().strip()


def _lcs(a: str, b: str) -> int:
    if not a or not b:
        return 0
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def token_sort_ratio(a: str, b: str) -> int:
    """100 * 2 * LCS / (len a + len b) on lower-cased, de-punctuated, token-sorted text."""
    sa = " ".join(sorted(_process(a).split()))
    sb = " ".join(sorted(_process(b).split()))
    if not sa or not sb:
        return 0
    return int(round(100 * 2 * _lcs(sa, sb) / (len(sa) + len(sb))))


def plan_columns(columns: list[str], system: str, entity: str = "sales_transactions",
                 cutoff: int = C.FUZZY_CUTOFF, collapse: bool = True,
                 exclude_exact: bool = False) -> tuple[dict[str, list[str]], list[dict], list[str]]:
    """Match each universal field of ``system`` to a header column.

    Returns (source -> [universal names], match rows, unmatched universal names).
    ``collapse=True`` keeps only the last universal name per source column (the
    reference's dict behaviour: GoFrugal's BillNo ends as invoice_number only);
    ``collapse=False`` copies the column to every universal name it matched.
    ``exclude_exact`` stops a column already matched exactly from being taken
    again by a fuzzy match (e.g. a missing GSTAmount stealing Amount)."""
    expected = C.ERP_MAPPINGS[system].get(entity, {})
    exact_taken = {src for src in expected.values() if src in columns}
    targets: dict[str, list[str]] = {}
    rows, unmatched = [], []
    for uni, src in expected.items():
        if src in columns:
            hit, score = src, 100
        else:
            pool = [c for c in columns if not (exclude_exact and c in exact_taken)]
            scored = [(c, token_sort_ratio(src, c)) for c in pool]
            scored = [x for x in scored if x[1] >= cutoff]
            hit, score = max(scored, key=lambda x: x[1]) if scored else (None, None)
        rows.append({"universal": uni, "expected": src, "matched": hit, "score": score})
        if hit is None:
            unmatched.append(uni)
            continue
        if collapse:
            # a dict keyed by source: a later universal name replaces the earlier one
            targets[hit] = [uni]
        else:
            targets.setdefault(hit, []).append(uni)
    return targets, rows, unmatched


def apply_columns(df: DataFrame, targets: Mapping[str, list[str]]) -> DataFrame:
    """Rename (or copy, when one column feeds several names) in one projection.
    Columns not in the plan keep their names."""
    out, taken = [], set()
    for c in df.columns:
        names = targets.get(c)
        if not names:
            out.append((c, F.col(f"`{c}`")))
            continue
        for n in names:
            out.append((n, F.col(f"`{c}`")))
    # a later duplicate name wins, as a rename over an existing column does
    final: dict[str, object] = {}
    for n, e in out:
        final[n] = e
        taken.add(n)
    return df.select(*[e.alias(n) for n, e in final.items()])


def missing_fields(spark: SparkSession, present: Iterable[str],
                   required: Iterable[str] = C.CLEANER_REQUIRED) -> DataFrame:
    """Required fields absent after mapping (reported, not fatal)."""
    req = spark.createDataFrame([(i, f) for i, f in enumerate(required)], "ord int, field string")
    have = spark.createDataFrame([(f,) for f in set(present)], "field string")
    return req.join(have, "field", "left_anti").select("ord", "field")
