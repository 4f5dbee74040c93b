"""The model DAG as plain function composition:
raw -> staging -> (metrics, marts) -> alerts -> digest.

``build_marts`` shares one staging result between the marts.  On a cluster it
is written once to the shared checkpoint folder (lineage cut, survives lost
executors); ``materialize="persist"`` keeps it in memory/disk instead.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ledgerlens.config import DEFAULT, Params
from ledgerlens.operators import alerts as A
from ledgerlens.operators import marts as M
from ledgerlens.operators import metrics as X
from ledgerlens.operators.staging import narrowed, stage_sales, widened
from ledgerlens.session import session_key, shared_path, shuffles_dropped
from ledgerlens.sources import fixture, tables


@dataclass
class Marts:
    staging: DataFrame
    dead_stock: DataFrame
    low_margin: DataFrame
    credit_risk: DataFrame


def staging_from_fixture(spark: SparkSession, sf_dir: str, p: Params = DEFAULT,
                         with_loaded_at: bool = False, by_month: bool = False) -> DataFrame:
    return stage_sales(fixture.raw_sales(spark, sf_dir), p, with_loaded_at=with_loaded_at, by_month=by_month)


STAGING_PARTITIONS = ("transaction_year", "transaction_month")


def share(spark: SparkSession, df: DataFrame, materialize: str | None,
          partition_by: tuple[str, ...] = (), together: bool = False) -> DataFrame:
    """Materialize a DataFrame that several plans read.

    ``"table"``: write parquet under ``spark.checkpoint.dir`` and read it back
    (reliable, lineage cut); ``partition_by`` lays it out by those columns so
    date-windowed readers prune partitions (``together``: the rows of a value are
    together already).  ``"persist"``: MEMORY_AND_DISK
    columnar cache, deserialized as Dataset.cache keeps it (lost blocks are
    recomputed from lineage).  ``None``: leave it lazy."""
    if materialize == "table":
        path = shared_path(spark, "staging")
        if partition_by and not together:
            # one shuffle so each partition value lands in a few files, not one
            # per task; AQE sizes the tasks and splits a hot value
            df = df.hint("rebalance", *partition_by)
        w = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        with shuffles_dropped(spark):
            w.parquet(path)
        return spark.read.schema(df.schema).parquet(path).select(*df.columns)
    if materialize == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    return df


_STAGED: dict[tuple, DataFrame] = {}
STAGED_TABLES = ("lineitem", "orders", "customer", "part")


def file_state(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = STAGED_TABLES) -> tuple[int, int | None]:
    """(files, one number that changes with any file's path, size or time) of the
    tables; the listing is read, not the files, and one row reaches the driver."""
    files = spark.read.format("binaryFile").load([f"{sf_dir.rstrip('/')}/{t}.parquet" for t in names])
    one = F.xxhash64("path", "modificationTime", "length")
    return tuple(files.select(one.alias("h")).agg(F.count("h"), F.bit_xor("h")).first())


def shared_staging(spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    """Staging of the test tables, written once per application, state of the table
    files and parameters, partitioned by month; every query after the first reads
    it until a file is added, removed or changed."""
    key = session_key(spark, sf_dir.rstrip("/"), file_state(spark, sf_dir), p)
    if key not in _STAGED:
        _STAGED[key] = share(spark, staging_from_fixture(spark, sf_dir, p, by_month=True), "table", STAGING_PARTITIONS, together=True)
    return _STAGED[key]


ENRICHED_PARTS = 4


def enriched(spark: SparkSession, stg: DataFrame, p: Params = DEFAULT, parts: int = ENRICHED_PARTS) -> DataFrame:
    """``X.enrich_sales`` of the written staging table ``stg``, one part of its files after the other.

    Both joins shuffle every line, which for all files at once takes several times the
    disk of the lines.  The facts of customers and products are made of all lines
    and written; then the files' lines, without the columns that follow from the others,
    are enriched in ``parts`` turns, each of which drops its shuffles before the next
    begins.  What follows from the others is made when the rows are read."""
    with shuffles_dropped(spark):
        customers = tables.written(X.customer_facts(stg, p), "customer-facts")
        products = tables.written(X.product_facts(stg, p), "product-facts")
        out = shared_path(spark, "enriched")
        part = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(parts))
        for i in range(parts):  # the filter is on the path alone: files of other parts are not read
            rows = X.enrich_sales(narrowed(stg.where(part == i)), p, customers, products)
            rows.write.mode("append").option("compression", "zstd").parquet(out)
    return widened(spark.read.schema(rows.schema).parquet(out), p)


def build_marts(spark: SparkSession, raw: DataFrame, p: Params = DEFAULT,
                materialize: str | None = "table", with_created_at: bool = True) -> Marts:
    by_month = materialize == "table"
    stg = share(spark, stage_sales(raw, p, with_loaded_at=False, by_month=by_month), materialize, STAGING_PARTITIONS, together=by_month)
    return Marts(
        staging=stg,
        dead_stock=M.dead_stock(stg, p, with_created_at),
        low_margin=M.low_margin(stg, p, with_created_at),
        credit_risk=M.credit_risk(stg, p, with_created_at),
    )


def alerts_from_marts(spark: SparkSession, m: Marts, p: Params = DEFAULT,
                      with_timestamp: bool = True) -> DataFrame:
    credit = A.safe_alerts(lambda: A.credit_risk_alerts(m.credit_risk, p, with_timestamp), spark, with_timestamp)
    dead = A.safe_alerts(lambda: A.dead_stock_alerts(m.dead_stock, p, with_timestamp), spark, with_timestamp)
    low = A.safe_alerts(lambda: A.low_margin_alerts(m.low_margin, p, with_timestamp), spark, with_timestamp)
    return A.all_alerts(credit, dead, low)


def alerts_from_tables(spark: SparkSession, p: Params = DEFAULT, prefix: str = "mart_",
                       with_timestamp: bool = True) -> DataFrame:
    """Alerts read from saved mart tables; a missing table gives no alerts of its type."""
    credit = A.safe_alerts(lambda: A.credit_risk_alerts(spark.table(prefix + "credit_risk"), p, with_timestamp),
                           spark, with_timestamp)
    dead = A.safe_alerts(lambda: A.dead_stock_alerts(spark.table(prefix + "dead_stock"), p, with_timestamp),
                         spark, with_timestamp)
    low = A.safe_alerts(lambda: A.low_margin_alerts(spark.table(prefix + "low_margin_sales"), p, with_timestamp),
                        spark, with_timestamp)
    return A.all_alerts(credit, dead, low)


def clean_csv(spark: SparkSession, input_path: str, output_path: str, system: str | None = None,
              p: Params = DEFAULT, encoding: str | None = None, collapse: bool = True):
    """Raw export files -> cleaned CSV files + quality report (the cleaning entry point).

    Encoding probed unless given, source system detected unless given, columns
    mapped, typed and checked; ``loaded_at`` and ``source_file`` added; the
    clean rows are written as a CSV directory.  The report's counts are observed in
    the pass that writes the rows, so cleaning is evaluated once.  The rows go to a
    folder beside ``output_path`` first, which takes its place only if there are
    any; else this raises and ``output_path`` is as it was.
    Returns (system, report DataFrame, cleaned DataFrame read back)."""
    from ledgerlens.operators import cleaning as CL
    from ledgerlens.sources import files
    cleaned = CL.clean_export(files.read_csv(spark, input_path, encoding, with_lineage=True), system, p,
                              collapse=collapse)
    seen, observed = CL.observed(cleaned)
    staged = f"{output_path.rstrip('/')}-staged-{uuid.uuid4().hex[:12]}"
    files.write_csv(observed.rows, staged)
    report = CL.report_from(spark, cleaned, seen.get)
    CL.require_rows(seen.get["final_rows"])
    tables.publish(spark, staged, output_path)
    return cleaned.system, report, files.read_csv(spark, output_path, "UTF-8")


def clean_folder(spark: SparkSession, input_path: str, p: Params = DEFAULT, collapse: bool = True,
                 store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A landing folder with files of several systems, headers and encodings ->
    (report, clean rows).  ``store``: where the folder's manifest is kept from run to
    run (a new one without it).  Every layout is mapped and checked on its own
    (duplicates are judged among its files), then the rows are put together by name
    with their ``system``."""
    from ledgerlens.operators import cleaning as CL
    from ledgerlens.sources import landing
    listed = landing.manifest(spark, input_path, store or shared_path(spark, "landing"))
    rows, reports = [], []
    for n, (system, df) in enumerate(landing.layouts(spark, input_path, listed)):
        cleaned = CL.clean_export(df, system, p, collapse=collapse, landed=True)
        rows.append(cleaned.rows.withColumn("system", F.lit(cleaned.system)))
        reports.append(CL.quality_report(cleaned).withColumns({"system": F.lit(cleaned.system), "kind": F.lit(n)}))
    if not rows:
        raise ValueError(f"no file with a header under {input_path}")
    report, clean = reports[0], rows[0]
    for r, c in zip(reports[1:], rows[1:]):
        report, clean = report.unionByName(r), clean.unionByName(c, allowMissingColumns=True)
    return report, clean


def run(spark: SparkSession, raw: DataFrame, p: Params = DEFAULT, materialize: str | None = "table") -> DataFrame:
    """Raw sales -> one-row digest table."""
    m = build_marts(spark, raw, p, materialize)
    balanced = A.balanced_alerts(alerts_from_marts(spark, m, p), p)
    return A.daily_digest(spark, balanced, p)
