"""What a query leaves on disk: shuffle files, and rows shuffled that need not be."""

import time

from pyspark.sql import functions as F

from ledgerlens.session import SHUFFLE_CLEANUP, shuffles_dropped
from ledgerlens.sources import exports, tables


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (blocks.apply(i).getName() for i in range(blocks.size())) if n.startswith("shuffle_")}


def left_after(spark, write):
    """Shuffle files that ``write`` made and that are still there some time after it."""
    before, until = shuffle_files(spark), time.time() + 10
    write()
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def shuffled(spark, n=1000):
    return spark.range(n).withColumn("x", F.xxhash64("id")).repartition(4, "x")


def test_shuffles_of_a_write_are_dropped_with_it(spark, tmp_path):
    was = spark.conf.get(SHUFFLE_CLEANUP)

    def write():
        with shuffles_dropped(spark):
            shuffled(spark).write.parquet(str(tmp_path / "a"))
    assert not left_after(spark, write) and spark.read.parquet(str(tmp_path / "a")).count() == 1000
    assert spark.conf.get(SHUFFLE_CLEANUP) == was


def test_exports_and_tables_leave_no_shuffle_files(spark, sf, tmp_path):
    exports._CACHE.pop((spark.sparkContext.applicationId, "gofrugal-utf-8", sf, "gzip"), None)
    assert not left_after(spark, lambda: exports.export_path(spark, sf))
    assert not left_after(spark, lambda: tables.load_table(shuffled(spark), "ll_no_shuffles", path=str(tmp_path / "t")))
    assert spark.table("ll_no_shuffles").count() == 1000


def test_persisted_rows_are_read_after_a_write_that_drops_its_shuffles(spark, tmp_path):
    kept = shuffled(spark).persist()
    with shuffles_dropped(spark):
        for i in range(2):
            kept.groupBy(F.col("x") % 7).count().write.parquet(str(tmp_path / f"p{i}"))
    assert kept.count() == 1000
    kept.unpersist()


def test_rows_like_a_few_are_found_without_a_shuffle_of_the_rows(spark, tmp_path):
    nan = float("nan")
    rows = [(1, "a", 1.0), (1, "a", 1.0), (2, None, nan), (None, "c", -0.0), (None, None, None), (3, "d", 2.0), (3, None, 2.0)] * 3
    spark.createDataFrame(rows, "id long, `t x` string, v double").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    few = spark.createDataFrame([(1, "a", 1.0), (2, None, nan), (2, None, nan), (None, "c", 0.0), (None, None, None), (9, "x", 1.0)], table.schema)
    like = tables.rows_like(table, few)
    assert sorted(map(str, like.collect())) == sorted(str(r) for r in table.collect() if (r[0], r[1]) in {(1, "a"), (2, None), (None, "c"), (None, None)})
    assert few.exceptAll(like).collect() == few.exceptAll(table).collect() and few.exceptAll(like).count() == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = like._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    scan = plan.index("FileScan parquet")
    assert "Exchange hashpartitioning" not in plan[:scan] and "BroadcastHashJoin" in plan


def test_preview_of_rows_the_table_does_not_hold(spark, sf, monkeypatch):
    """The check compares the rows shown with the rows like them, and still tells rows that are not held."""
    from ledgerlens.plans import catalog_ingest as I
    compared = []
    like = tables.rows_like
    monkeypatch.setattr(tables, "rows_like", lambda df, few: compared.append(1) or like(df, few))
    assert I.table_preview(spark, sf).collect() == [(5, True)]
    shown = tables.preview
    monkeypatch.setattr(tables, "preview", lambda s, name, n: shown(s, name, n).withColumn("invoice_number", F.lit("none such")))
    assert I.table_preview(spark, sf).collect() == [(5, False)] and compared == [1, 1]


def test_enriched_in_parts_equals_enriched_at_once(spark, sf):
    """Every line once, its facts from all lines, whatever file it is in; no shuffle is left when the rows are there."""
    from ledgerlens.operators import metrics as X
    from ledgerlens.plans import jobs
    stg = jobs.shared_staging(spark, sf)
    made = []
    assert not left_after(spark, lambda: made.append(jobs.enriched(spark, stg)))
    whole = X.enrich_sales(stg)
    assert made[0].dtypes == whole.dtypes and made[0].count() == whole.count() > 0
    assert made[0].exceptAll(whole).isEmpty()
    assert "Join" not in made[0]._jdf.queryExecution().optimizedPlan().toString()


def test_enriched_in_parts_keeps_null_ids_and_lines_that_come_twice(spark):
    from ledgerlens.operators import metrics as X
    from ledgerlens.operators.staging import stage_sales
    from ledgerlens.plans import jobs
    raw = spark.createDataFrame([("1", "2001-01-05", None, "p", 2, 10, 4, 20, "Paid", None), ("1", "2001-01-05", None, "p", 2, 10, 4, 20, "Paid", None),
                                 ("2", "2001-02-28", " a ", None, 1, 0, None, 5, None, "no date"), ("3", "2001-03-01", " a ", "p", 1, 3, 5, 3, "Unpaid", "2001-01-01")],
                                "invoice_number string, transaction_date string, customer_name string, product_name string, quantity int, unit_price int, "
                                "cost_price int, total_amount int, payment_status string, payment_due_date string")
    stg = jobs.share(spark, stage_sales(raw, with_loaded_at=False).repartition(4), "table", jobs.STAGING_PARTITIONS)
    for parts in (1, 3):
        assert sorted(map(str, jobs.enriched(spark, stg, parts=parts).collect())) == sorted(map(str, X.enrich_sales(stg).collect()))
