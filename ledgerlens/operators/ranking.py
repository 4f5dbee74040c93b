"""Row numbers and running sums over a whole table or over large groups, without a
window that holds either in one task.

Rows are range-partitioned and sorted by (group, order) and written once; what
every partition holds of a group is counted, the counts (one row per partition and
group in it) get a prefix sum, and a row's number is its place in its partition
plus the prefix.  The only windows run over those counts and inside one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.sources.tables import written


def _dealt(df: DataFrame, order: Sequence[Column], group: Sequence[str]) -> DataFrame:
    keys = [*(F.col(f"`{g}`") for g in group), *order]
    df = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_rk_row", F.monotonically_increasing_id())
    return written(df, "sorted").withColumn("_rk_part", F.shiftright("_rk_row", 33))


def _with_prefix(dealt: DataFrame, group: Sequence[str], weight: Column) -> DataFrame:
    """Adds ``_rk_first`` (lowest row id of the group in the partition) and ``_rk_before``
    (weight of the group in earlier partitions)."""
    names = [f"_rk_g{i}" for i in range(len(group))]
    counts = dealt.groupBy(*(F.col(f"`{g}`").alias(n) for g, n in zip(group, names)), F.col("_rk_part").alias("_rk_p")).agg(
        F.min("_rk_row").alias("_rk_first"), F.sum(weight).alias("_rk_n"))
    earlier = Window.partitionBy(*names).orderBy("_rk_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(counts.withColumn("_rk_before", F.coalesce(F.sum("_rk_n").over(earlier), F.lit(0))).drop("_rk_n"), "starts")
    on = F.col("_rk_part") == F.col("_rk_p")
    for g, n in zip(group, names):
        on = on & F.col(f"`{g}`").eqNullSafe(F.col(n))
    return dealt.join(starts, on).drop("_rk_p", *names)


def numbered(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), name: str = "row_number") -> DataFrame:
    """``name``: the row's number in ``order`` (from 1), in its group if there is one."""
    placed = _with_prefix(_dealt(df, order, group), group, F.lit(1))
    return placed.withColumn(name, F.col("_rk_row") - F.col("_rk_first") + F.col("_rk_before") + 1).drop("_rk_row", "_rk_part", "_rk_first", "_rk_before")


def weight_before(df: DataFrame, weight: str, order: Sequence[Column], group: Sequence[str] = (), name: str = "weight_before") -> DataFrame:
    """``name``: the sum of ``weight`` over the rows before this one in ``order``."""
    placed = _with_prefix(_dealt(df, order, group), group, F.col(weight))
    here = Window.partitionBy("_rk_part", *(F.col(f"`{g}`") for g in group)).orderBy("_rk_row").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn(name, F.coalesce(F.sum(weight).over(here), F.lit(0)) + F.col("_rk_before")).drop("_rk_row", "_rk_part", "_rk_first", "_rk_before")
