"""Mixing sources to target weights by entropy balancing.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and
share all words; a target stops at ``most`` times its source's words, and the
excess is reshared by weight until none is above.  That fixed point is a water
level L: target = min(most * size, L * weight).

Rates: the document rates w closest to 1 in relative entropy under "the words
taken from a source equal its target" and 0 <= w <= most are exponential tilts
w = min(most, exp(t * size)), one multiplier t per source.  Newton steps on the
convex dual find t: every step is one distributed aggregation over the table of
distinct (source, size) pairs, which is all the dual depends on.  A bracket
keeps the steps safe, so convergence does not depend on the data.

Copies: a rate becomes its integer part, plus one copy for the documents whose
hash-driven priority comes first, as long as they stay within the source's
target (a prefix sum over priorities, found bin by bin), and for the document
whose size comes nearest to what is then left.  The
rates of one source differ only by size, and the draw only by id: reruns agree.

Defined results: a null text has size 0 and is taken as 0 words.  A source
without words has target 0.  Repeated rows are documents of their own
with one priority: all of them or none take one copy more.  An empty table gives
no rows.  All columns of the documents come back in a struct, so names of extra
columns cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, written

WEIGHTS = (5, 2, 1)
BINS = 4096
STEPS = 60
FIXED = "decimal(32,6)"  # words of the Newton sums
NEAR = 1e-9  # of the target


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, most: float = 3.0) -> DataFrame:
    """sizes(source, source_size), one row per source -> with target.

    The windows run over one row per source, never over documents."""
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(rank) - 1) % len(weights) + 1).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * float(most))
    # By rising cap per weight: sources before the level are stopped at their cap.
    up = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    # The candidate levels rise until the first that no later cap stops, then fall: the largest is the level.
    w = w.withColumn("water", F.max(left / F.sum("weight").over(after)).over(Window.partitionBy()))
    return w.select("source", "source_size", F.least("cap", F.col("water") * F.col("weight")).alias("target"))


def tilts(pairs: DataFrame, goals: DataFrame, most: float = 3.0, steps: int = STEPS) -> DataFrame:
    """pairs(source, size, n), goals(source, source_size, target) -> (source, tilt).

    Newton on log(words taken) = log(target), inside a bracket."""
    top = math.log(most)
    ends = pairs.filter("size > 0").groupBy("source").agg(F.min("size").alias("short"))
    goal = goals.join(ends, goals["source"].eqNullSafe(ends["source"]), "inner").drop(ends["source"])
    ratio = F.col("target") / F.col("source_size")
    state = goal.filter("target > 0").select(
        "source", "target", "short", (F.col("source_size") * (most - 1e-9)).alias("ceiling"), F.when(ratio < 1, F.log(ratio) / F.col("short")).otherwise(0.0).alias("lo"),
        F.when(ratio < 1, F.lit(0.0)).otherwise(top / F.col("short")).alias("hi"))
    # Start where the rates are 1, or at the cap if every document must reach it.
    full = F.col("hi") * F.col("short") * (F.col("target") >= F.col("ceiling")).cast("int") > 0
    state = state.withColumn("tilt", F.when((F.col("lo") < 0) | full, F.col("hi")).otherwise(F.col("lo"))).withColumn("done", F.lit(False))
    state = state.drop("short", "ceiling")
    state = written(state, "tilts")
    for _ in range(steps):
        exponent = F.col("tilt") * F.col("size")
        rate = F.exp(F.least(exponent, F.lit(top)))
        words = F.col("n") * F.col("size")
        p = pairs.filter("size > 0").withColumnRenamed("source", "s")
        moments = (p.join(state, F.col("s").eqNullSafe(F.col("source"))).groupBy("s")
                   .agg(F.sum((words * rate).cast(FIXED)).cast("double").alias("g"),  # fixed point: the same in whatever order it is added
                        F.sum(F.when(exponent < top, words * rate * F.col("size")).otherwise(0.0).cast(FIXED)).cast("double").alias("h")))
        now = state.join(moments, F.col("s").eqNullSafe(F.col("source"))).drop("s")
        now = (now.withColumn("lo", F.when(F.col("g") <= F.col("target"), F.col("tilt")).otherwise(F.col("lo")))
               .withColumn("hi", F.when(F.col("g") >= F.col("target"), F.col("tilt")).otherwise(F.col("hi"))))
        newton = F.when(F.col("h") > 0, F.col("tilt") + F.log(F.col("target") / F.col("g")) * F.col("g") / F.col("h"))
        half = (F.col("lo") + F.col("hi")) / 2
        done = (F.abs(F.col("g") - F.col("target")) <= NEAR * F.col("target")) | (F.col("lo") >= F.col("hi"))
        step = F.when(done, F.col("tilt")).when((newton > F.col("lo")) & (newton < F.col("hi")), newton).otherwise(half)
        state = written(now.select("source", "target", "lo", "hi", step.alias("tilt"), done.alias("done")), "tilts")
        if state.filter("NOT done").isEmpty():
            break
    else:
        raise ArithmeticError(f"sources without a tilt after {steps} steps: the mix would miss its targets")
    return state.select("source", "tilt")


def _rate(most: float) -> Column:
    """Rate of a row with size, target and its source's tilt."""
    tilt = F.exp(F.least(F.coalesce("tilt", F.lit(0.0)) * F.col("size"), F.lit(math.log(most))))
    return F.when(F.col("target") > 0, F.least(tilt, F.lit(float(most)))).otherwise(0.0)


def _wishes(df: DataFrame, most: float) -> DataFrame:
    """Add whole (copies for sure), and for one copy more: key (the sooner the
    smaller: the draw less the rest of the rate) and its bin."""
    df = df.withColumn("rate", _rate(most)).withColumn("whole", F.floor(F.col("rate") + 1e-9).cast("int"))
    rest = F.col("rate") - F.col("whole")
    wants = (F.col("whole") < most) & (F.col("size") > 0) & (rest > 1e-9)
    return (df.withColumn("key", F.when(wants, F.col("draw") - rest))
            .withColumn("bin", F.floor((F.col("key") + 1) / 2 * BINS).cast("int")))


def draw_of(id_col: str) -> Column:
    """A repeatable draw in [0, 1) from the id."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)


def plan(slim: DataFrame, weights=WEIGHTS, most: float = 3.0) -> DataFrame:
    """slim(source, size, draw), a written table -> one row per source: _s,
    source_size, target, tilt, and the bin and keys that decide on one copy more."""
    pairs = written(slim.groupBy("source", "size").agg(F.count("*").alias("n")), "size-pairs")
    sizes = pairs.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).cast("long").alias("source_size"))
    goals = written(targets(sizes, weights, most), "targets")
    tilt = tilts(pairs, goals, most).withColumnRenamed("source", "s")
    per = goals.join(tilt, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "_s")
    per = written(per, "source-tilts")
    rows = _wishes(slim.join(per, F.col("source").eqNullSafe(F.col("_s"))), most)
    # Words of the whole copies, and of the wishes by bin; then the bin in which the target is met.
    bins = rows.groupBy("source", "target", "bin").agg(
        F.sum(F.col("whole") * F.col("size")).alias("base"), F.sum(F.when(F.col("bin").isNotNull(), F.col("size"))).alias("wish"))
    of = Window.partitionBy("source")
    bins = bins.withColumn("room", F.col("target") - F.sum("base").over(of)).filter("bin IS NOT NULL")
    bins = bins.withColumn("used", F.sum("wish").over(of.orderBy("bin")) - F.col("wish"))
    edges = written(bins.filter("used <= room AND used + wish > room").select(
        F.col("source").alias("e"), F.col("bin").alias("edge"), (F.col("room") - F.col("used")).alias("gap")), "edges")
    # Inside that bin: the last key up to which copies stay within the target.
    inside = rows.join(edges, F.col("source").eqNullSafe(F.col("e")) & (F.col("bin") == F.col("edge")))
    sums = inside.groupBy("source", "gap", "key").agg(F.sum("size").alias("size"))
    sums = sums.withColumn("sum", F.sum("size").over(of.orderBy("key")))
    fits = F.col("sum") <= F.col("gap")
    last = sums.groupBy("source", "gap").agg(F.max(F.when(fits, F.col("key"))).alias("last"), F.max(F.when(fits, F.col("sum"))).alias("got"))
    cut = edges.select("e", "edge").join(last, F.col("e").eqNullSafe(F.col("source"))).select(
        "e", "edge", F.coalesce("last", F.lit(-2.0)).alias("last"), (F.col("gap") - F.coalesce("got", F.lit(0))).alias("left"))
    cut = written(cut, "cuts")
    # Of the documents still without that copy, the one whose size comes nearest to what is left.
    free = rows.join(cut, F.col("source").eqNullSafe(F.col("e")) & (
        (F.col("bin") > F.col("edge")) | ((F.col("bin") == F.col("edge")) & (F.col("key") > F.col("last")))))
    miss = F.abs(F.col("size") - F.col("left"))
    nearest = free.filter(miss < F.col("left")).groupBy(F.col("source").alias("f")).agg(F.min_by("key", miss + F.col("draw") / 2).alias("fill"))
    per = per.join(cut.select("e", "edge", "last"), F.col("_s").eqNullSafe(F.col("e")), "left").drop("e")
    return written(per.join(nearest, F.col("_s").eqNullSafe(F.col("f")), "left").drop("f"), "mix-plan")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, most: float = 3.0) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc``, with size, source_size,
    target, rate and copies (0 to ``most``).

    ``docs`` must be read from files (it is read twice).  Its rows meet the plan
    on the source: one row per source, broadcast only if Spark measures it
    small, otherwise a join whose hot sources adaptive execution splits."""
    def keyed(*more: Column) -> DataFrame:
        return docs.select(*more, F.col(source_col).alias("source"), size_of(text_col).alias("size"), draw_of(id_col).alias("draw"))

    per = plan(written(keyed(), "sizes"), weights, most)
    whole = keyed(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    out = _wishes(whole.join(per, F.col("source").eqNullSafe(F.col("_s"))), most)
    more = (F.col("edge").isNull() | (F.col("bin") < F.col("edge")) | (F.col("key") == F.col("fill"))
            | ((F.col("bin") == F.col("edge")) & (F.col("key") <= F.col("last"))))
    copies = F.col("whole") + F.when(F.col("bin").isNotNull() & F.coalesce(more, F.lit(False)), 1).otherwise(0)
    return out.select("doc", "size", "source_size", "target", "rate", copies.alias("copies"))
