"""Real-time critical alerts (declared in the configuration, switched off there).

New sale lines arrive as files.  Each micro-batch joins its lines, and those that
earlier batches left waiting, to the order, customer and part tables as they are
at that moment, stages them with the same projection as the batch pipeline, and
writes the lines selling below cost (low-margin CRITICAL, which needs no other
row).  Lines whose order, customer or part is not there yet wait in a pending
folder for the next batch; none is dropped for its age or its sale date.  Lines
without an order or part key, which nothing can ever match, go to a folder of
rejected lines.

A line is identified by its order, line number and values.  The checkpoint reads
every file once; a line sent again in another file is dropped if it arrives within
``horizon`` of its first arrival (the only state kept; arrival time is the
processing time, so nothing is ever late for the watermark).

A batch writes its alerts and its pending lines to folders of its own in
overwrite mode, so a batch run again after a failure replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.config import DEFAULT, Params
from ledgerlens.operators.staging import stage_sales
from ledgerlens.session import shared_path
from ledgerlens.sources import fixture
from ledgerlens.sources.tables import read_if_there
from ledgerlens.streaming import entities

ALERT_COLUMNS = ("transaction_id", "transaction_date", "customer_id", "customer_name", "product_id",
                 "quantity", "unit_price", "cost_price", "margin_percentage", "alert_severity",
                 "recommended_action")
# what a batch's alerts, and its customers and products (``entities``), are made of
STAGED_COLUMNS = (*ALERT_COLUMNS[:-2], "total_amount", "payment_status", "payment_due_date")
# what makes two lines the same line: the source numbers lines by hand, so a
# number alone may stand on several lines of one order
LINE_KEY = LINE_COLUMNS = (*fixture.LINE_COLUMNS, "l_linenumber")


def line_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 64,
                lines_dir: str | None = None, horizon: str = "7 days") -> DataFrame:
    """Order lines as a file stream over the lineitem parquet files (in
    ``lines_dir``, default the tables' folder), each line once."""
    schema = fixture.table(spark, sf_dir, "lineitem").schema
    lines = (spark.readStream.schema(schema)
                  .option("pathGlobFilter", "lineitem*.parquet")
                  .option("maxFilesPerTrigger", max_files_per_trigger)
                  .parquet(lines_dir or sf_dir).select(*LINE_COLUMNS))
    return (lines.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", horizon)
                 .dropDuplicatesWithinWatermark(list(LINE_KEY)).drop("arrived"))


def staged_lines(lines: DataFrame, spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    """Lines of a batch whose order, customer and part are there, staged as in the batch pipeline."""
    return stage_sales(fixture.raw_sales_from(lines, *fixture.dimensions(spark, sf_dir)), p, with_loaded_at=False)


def critical_alerts(lines: DataFrame, spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    """Lines of a batch -> critical low-margin alert rows."""
    return critical_of(staged_lines(lines, spark, sf_dir, p))


def critical_of(staged: DataFrame) -> DataFrame:
    """Staged lines -> critical low-margin alert rows."""
    crit = staged.where((F.col("margin_percentage") < 0) & F.col("cost_price").isNotNull())
    return crit.select(
        *[c for c in ALERT_COLUMNS if c not in ("alert_severity", "recommended_action")],
        F.lit("CRITICAL").alias("alert_severity"),
        F.lit(C.MARGIN_ACTION_CRITICAL).alias("recommended_action"))


def waiting_lines(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose order, customer or part is missing from the tables: one join per key
    with its distinct known values, the lines go through each once."""
    o, c, p = fixture.dimensions(spark, sf_dir)
    known = o.join(c.select("c_custkey"), o.o_custkey == c.c_custkey, "left_semi")
    orders = known.select(F.col("o_orderkey").alias("_order")).distinct()
    parts = p.select(F.col("p_partkey").alias("_part")).distinct()
    found = lines.join(orders, lines.l_orderkey == F.col("_order"), "left").join(parts, lines.l_partkey == F.col("_part"), "left")
    return found.where(F.col("_order").isNull() | F.col("_part").isNull()).select(*lines.columns)


def _claim(spark: SparkSession, out_path: str, checkpoint: str) -> None:
    """Batch numbers belong to one checkpoint: refuse a folder of another one."""
    owner = read_if_there(spark, f"{out_path}/_owner")
    if owner is None:
        if read_if_there(spark, out_path) is not None:
            raise ValueError(f"{out_path} holds alerts of an unknown checkpoint")
        spark.createDataFrame([(checkpoint,)], "checkpoint string").coalesce(1).write.parquet(f"{out_path}/_owner")
    elif owner.first()["checkpoint"] != checkpoint:
        raise ValueError(f"{out_path} holds alerts of checkpoint {owner.first()['checkpoint']}")


def _writer(spark: SparkSession, sf_dir: str, out_path: str, checkpoint: str, p: Params,
            max_files_per_trigger: int = 64, lines_dir: str | None = None, horizon: str = "7 days",
            entities_path: str | None = None, today=None):
    _claim(spark, out_path, checkpoint)
    pending, rejected = f"{checkpoint.rstrip('/')}-pending", f"{checkpoint.rstrip('/')}-rejected"
    no_key = F.col("l_orderkey").isNull() | F.col("l_partkey").isNull()  # no order or part will ever match

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        left = read_if_there(spark, f"{pending}/batch_id={batch_id - 1}") if batch_id else None
        batch = batch.persist()  # the stream's own plan runs once, whatever waits beside it
        lines = batch if left is None else batch.unionByName(left)
        staged = staged_lines(lines, spark, sf_dir, p).select(*STAGED_COLUMNS)
        if entities_path:
            staged = staged.persist()
        try:
            batch.where(no_key).write.mode("overwrite").parquet(f"{rejected}/batch_id={batch_id}")
            waiting_lines(lines.where(~no_key), spark, sf_dir).write.mode("overwrite").parquet(f"{pending}/batch_id={batch_id}")
            critical_of(staged).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
            if entities_path:
                entities.update(spark, staged, batch_id, f"{checkpoint.rstrip('/')}-state", entities_path, p, today)
        finally:
            staged.unpersist()
            batch.unpersist()

    return (line_stream(spark, sf_dir, max_files_per_trigger, lines_dir, horizon)
            .writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint))


def run_available_now(spark: SparkSession, sf_dir: str, p: Params = DEFAULT,
                      out_path: str | None = None, checkpoint: str | None = None,
                      lines_dir: str | None = None, max_files_per_trigger: int = 64,
                      entities_path: str | None = None, today=None) -> str:
    """Process every line file present now, then stop.  Returns the output folder.
    ``entities_path``: also raise the alerts of customers and products there
    (``entities``); ``today`` gives the day of a batch (default ``as_of``)."""
    out_path = out_path or shared_path(spark, "critical-alerts")
    checkpoint = checkpoint or shared_path(spark, "critical-alerts-ckpt")
    q = (_writer(spark, sf_dir, out_path, checkpoint, p, max_files_per_trigger, lines_dir, entities_path=entities_path, today=today)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def start(spark: SparkSession, sf_dir: str, out_path: str, checkpoint: str, p: Params = DEFAULT,
          every: str = "1 minute", lines_dir: str | None = None, entities_path: str | None = None, today=None):
    """Keep running: a micro-batch every ``every`` over newly arrived line
    files.  Returns the StreamingQuery (stop it with ``.stop()``)."""
    return _writer(spark, sf_dir, out_path, checkpoint, p, lines_dir=lines_dir, entities_path=entities_path, today=today).trigger(processingTime=every).start()


def read_alerts(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path).drop("batch_id")
