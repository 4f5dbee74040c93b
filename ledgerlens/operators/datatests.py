"""Declarative data tests (not_null, unique, required fields, primary keys,
allowed values).  Each test over one table is a single aggregate: all null
counts in one pass, unpivoted with ``stack``; uniqueness is a group-by-key
count (partial + final, so a hot key is one row per task)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import ws_trim


def not_null(df: DataFrame, model: str, columns: Iterable[str]) -> DataFrame:
    """(model, column_name, test, failures); a column the table lacks is
    reported with null failures (the test cannot run)."""
    cols = list(columns)
    present = [c for c in cols if c in df.columns]
    spark = df.sparkSession
    parts = []
    if present:
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
        args = ", ".join(f"'{c}', CAST(`{c}` AS BIGINT)" for c in present)
        parts.append(agg.selectExpr(f"stack({len(present)}, {args}) AS (column_name, failures)"))
    missing = [c for c in cols if c not in df.columns]
    if missing:
        parts.append(spark.createDataFrame([(c, None) for c in missing], "column_name string, failures bigint"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"), "failures")


def unique(df: DataFrame, model: str, keys: Sequence[str]) -> DataFrame:
    """(model, key, duplicated_values, duplicated_rows): how many key values
    occur more than once, and how many rows carry them."""
    name = ",".join(keys)
    if not all(k in df.columns for k in keys):
        return df.sparkSession.createDataFrame(
            [(model, name, None, None)], "model string, key string, duplicated_values bigint, duplicated_rows bigint")
    counts = df.where(F.coalesce(*[F.col(k).isNotNull() for k in keys])) \
        if len(keys) == 1 else df
    counts = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counts.agg(F.count(F.lit(1)).alias("duplicated_values"),
                      F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("duplicated_rows")) \
        .select(F.lit(model).alias("model"), F.lit(name).alias("key"), "duplicated_values", "duplicated_rows")


def allowed_values(df: DataFrame, entity: str, field: str, allowed: Iterable[str]) -> DataFrame:
    """Values outside ``allowed`` (compared trimmed and case-insensitively;
    null is allowed): (entity, field, value, rows)."""
    if field not in df.columns:
        return df.sparkSession.createDataFrame([], "entity string, field string, value string, rows bigint")
    norm = F.lower(ws_trim(F.col(field).cast("string")))
    ok = [a.lower() for a in allowed]
    bad = df.where(F.col(field).isNotNull() & ~norm.isin(*ok))
    return (bad.groupBy(F.col(field).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
               .select(F.lit(entity).alias("entity"), F.lit(field).alias("field"), "value", "rows"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

