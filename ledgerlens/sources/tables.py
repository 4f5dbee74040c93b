"""Catalog tables: load with replace or append, preview, existence test."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import shared_path, shuffles_dropped

LOG = logging.getLogger(__name__)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back: computed
    once, and not again when executors are lost."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A folder of Parquet files, or None if there is none (yet)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """The folder ``staged`` takes the place of ``path`` (a rename in its file system)."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged), target):
        raise OSError(f"{staged} could not be renamed to {path}")


def load_table(df: DataFrame, name: str, if_exists: str = "replace",
               partition_by: list[str] | None = None, path: str | None = None) -> bool:
    """Write ``df`` as table ``name``; 'replace' overwrites, anything else appends.
    ``path`` places the table's files (a shared folder on a cluster).
    Returns False instead of raising, as a loader step reports its status."""
    try:
        if partition_by:
            df = df.hint("rebalance", *partition_by)   # few files per partition value
        w = df.write.mode("overwrite" if if_exists == "replace" else "append").option("compression", "zstd")
        if path:
            w = w.option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
        with shuffles_dropped(df.sparkSession):
            w.saveAsTable(name)
        return True
    except Exception:  # noqa: BLE001 - a failed load is reported as False
        LOG.exception("table %s could not be loaded", name)
        return False


def preview(spark: SparkSession, name: str, limit: int = 5) -> DataFrame:
    """First ``limit`` rows (no order), or an empty frame when the table cannot be read."""
    try:
        df = spark.table(name)
        df.schema
        return df.limit(limit)
    except Exception:  # noqa: BLE001 - no preview is an empty one
        LOG.warning("table %s could not be read", name, exc_info=True)
        return spark.createDataFrame([], "value string")


def rows_like(df: DataFrame, few: DataFrame) -> DataFrame:
    """The rows of ``df`` that equal one of a ``few`` rows (nulls equal each other),
    found in one pass: the few go to every task, the rows are not shuffled."""
    few = few.distinct().toDF(*(f"_few{i}" for i in range(len(few.columns))))
    same = [df[f"`{c}`"].eqNullSafe(F.col(n)) for c, n in zip(df.columns, few.columns)]
    return df.join(F.broadcast(few), same, "left_semi")
