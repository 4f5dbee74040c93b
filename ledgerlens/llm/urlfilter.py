"""URL filter: host/path rules, and a character language-model ratio for the rest.

The urls that a rule decides train two smoothed variable-order Markov models
over characters, one of accepted and one of rejected urls (orders 0 to 4,
Witten-Bell interpolation: an unseen context falls back to the next shorter
one).  A url's score is the difference of its two log-likelihoods divided by
its length; the decision threshold is calibrated on ruled urls kept out of the
training (the cut with the best balanced accuracy).

All of it is DataFrame work: n-grams are exploded, counted and smoothed per
distinct n-gram, and joined back to the urls' positions on the n-gram (one
sort-merge join, whose hot n-grams adaptive execution splits).

Defined results: a null url, or one without ``://``, has empty host and path and
is scored as text (null as the empty text, which has one position, the end).
Without ruled urls of both kinds on the calibration side the threshold is 0, and
a score equal to the threshold is allowed.  Repeated rows are kept, extra
columns ignored, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import ascii_lower, written

# Fixed values: (action, host, path prefix).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 4
START, END = "\u0002", "\u0003"
BIN = 100  # calibration bins per unit of score
REACH = 20  # scores beyond this share the outermost bin


def host_path(url: str) -> tuple[Column, Column]:
    u = F.col(url)
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(raw), path


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text or null, verdict of the longest fitting rule or null)."""
    rule = action = F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest last, so it wins
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def positions(urls: DataFrame, text: str, order: int) -> DataFrame:
    """One row per character (and the end) with its ``order`` predecessors."""
    chars = F.split(F.concat(F.lit(START * order), F.col(text), F.lit(END)), "")
    cut = F.filter(chars, lambda c: c != "")
    grams = F.transform(F.sequence(F.lit(1), F.size("cs") - order), lambda i: F.array_join(F.slice("cs", i, order + 1), ""))
    return urls.withColumn("cs", cut).withColumn("g", F.explode(grams)).drop("cs", text)


def model(counts: DataFrame, order: int) -> DataFrame:
    """counts(g, n_a, n_r) of (order+1)-grams -> (g, d): log P_accept - log P_reject."""
    def by_suffix(size: int) -> DataFrame:
        return counts.groupBy(F.right(F.col("g"), F.lit(size)).alias("g")).agg(F.sum("n_a").alias("n_a"), F.sum("n_r").alias("n_r"))

    below = None
    for size in range(1, order + 2):
        level = by_suffix(size) if size <= order else counts
        ctx = Window.partitionBy(F.left(F.col("g"), F.lit(size - 1)))
        for k in "ar":
            level = (level.withColumn(f"all_{k}", F.sum(f"n_{k}").over(ctx))
                     .withColumn(f"kinds_{k}", F.count_if(F.col(f"n_{k}") > 0).over(ctx)))
        if below is None:  # before any context: every character seen anywhere, and one more, alike
            level = level.withColumn("kinds", F.count("*").over(ctx))
            level = level.withColumn("b_a", 1 / (F.col("kinds") + 1)).withColumn("b_r", 1 / (F.col("kinds") + 1))
        else:
            level = level.join(below.select(F.col("g").alias("s"), F.col("p_a").alias("b_a"), F.col("p_r").alias("b_r")),
                               F.right(F.col("g"), F.lit(size - 1)) == F.col("s"))
        for k in "ar":
            mass = F.col(f"all_{k}") + F.col(f"kinds_{k}")
            level = level.withColumn(f"p_{k}", F.when(mass > 0, (F.col(f"n_{k}") + F.col(f"kinds_{k}") * F.col(f"b_{k}")) / mass)
                                     .otherwise(F.col(f"b_{k}")))
        below = level.select("g", "p_a", "p_r")
    return below.select("g", (F.log("p_a") - F.log("p_r")).alias("d"))


def threshold(scored: DataFrame) -> float:
    """The score that separates calibration urls best, midway between the occupied
    bins on its two sides."""
    b = F.floor(F.greatest(F.least(F.col("score"), F.lit(REACH)), F.lit(-REACH)) * BIN)
    bins = scored.groupBy(b.alias("b")).agg(F.count_if(F.col("label") == "allow").alias("a"), F.count_if(F.col("label") == "block").alias("r"))
    up, whole = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()  # at most 2 * REACH * BIN + 1 rows
    below = bins.select("b", F.coalesce(F.lag("b").over(Window.orderBy("b")) + 1, "b").alias("last"), F.coalesce(F.sum("a").over(up), F.lit(0)).alias("a_lost"), F.coalesce(F.sum("r").over(up), F.lit(0)).alias("r_cut"),
                        F.sum("a").over(whole).alias("a"), F.sum("r").over(whole).alias("r"))
    best = (below.filter("a > 0 AND r > 0").select("b", "last", (F.col("r_cut") / F.col("r") - F.col("a_lost") / F.col("a")).alias("gain"))
            .orderBy(F.desc("gain"), F.abs("b"), "b").first())
    return (best["b"] + best["last"]) / 2 / BIN if best else 0.0


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, order: int = ORDER, folds: int = 5) -> DataFrame:
    """Return id, host, path, rule, verdict and the score (positive: accepted-like)."""
    host, path = host_path("url")
    slim = pages.select(F.col(id_col).alias(id_col), F.col(url_col).cast("string").alias("url")).withColumn("host", host).withColumn("path", path)
    rule, action = rule_columns(F.col("host"), F.col("path"), rules)
    slim = slim.withColumn("rule", rule).withColumn("label", action).withColumn("rid", F.monotonically_increasing_id())
    slim = written(slim, "urls")  # the ids stay as they are, and the wide pages are read once
    text = ascii_lower(F.coalesce("url", F.lit(""))).alias("t")
    kept_out = F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(folds)) == 0
    teach = F.when(~kept_out, F.col("label"))
    grams = positions(slim.select("rid", teach.alias("teach"), text), "t", order)
    counts = written(grams.groupBy("g").agg(F.count_if(F.col("teach") == "allow").alias("n_a"), F.count_if(F.col("teach") == "block").alias("n_r")), "url-grams")
    weights = written(model(counts, order), "url-model")
    scores = grams.join(weights, "g").groupBy("rid").agg(F.round(F.avg("d"), 9).alias("score"))
    scored = written(slim.join(scores, "rid").withColumn("kept_out", F.coalesce(kept_out, F.lit(False))), "url-scores")
    cut = threshold(scored.filter("kept_out"))
    by_model = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return scored.select(id_col, "host", "path", "rule", F.coalesce("label", by_model).alias("verdict"), "score")
