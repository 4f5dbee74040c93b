"""Critical alerts of customers and products in real time.

A customer is critical by the sum and age of all overdue lines, a product by the
day of its last sale: neither follows from one line, so batches keep state.  The
state is a table of partial aggregates per kind:

* credit: unpaid amount and first sale date per (customer, due date),
* dead stock: last sale date and quantity per product.

Each batch adds its own aggregates as a delta (partial + final, so a hot customer
is one row per task); every ``COMPACT`` batches snapshot and deltas are merged into
a new snapshot, so a batch reads one snapshot and at most ``COMPACT`` deltas.
Amounts per due date are what time needs: an amount becomes overdue, a product
dead, on a later day without any new line.  So when the day has changed since the
batch before, all keys are judged again (the timer); otherwise only the keys that
the batch has touched.

Every batch writes events: ``raised`` (critical now, not before), ``changed``
(critical before and now, with other figures) and ``cleared``.  The alerts that
stand are the last event per key, and equal the CRITICAL rows of the batch marts
over all lines so far, however these were split into batches.

State, events and the day of a batch are folders per batch, written in overwrite
mode: a batch that is run again, with the day it had, replaces its own output.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.config import DEFAULT, Params
from ledgerlens.functions.columns import days_between
from ledgerlens.operators import marts as M
from ledgerlens.operators.metrics import SUM_MONEY
from ledgerlens.operators.staging import customer_name_of, product_name_of
from ledgerlens.sources.tables import read_if_there

COMPACT = 16
FIGURES = ("entity_name", "amount", "days", "first_date", "recommended_action")
EVENT_SCHEMA = ("alert_type string, entity_id string, entity_name string, amount decimal(38,4), days bigint, "
                "first_date date, recommended_action string, event string, as_of date")


@dataclass(frozen=True)
class Kind:
    alert_type: str
    key: str                                        # whose alert it is
    state_key: tuple[str, ...]                      # a row of the state
    schema: str
    partial: Callable[[DataFrame], DataFrame]       # staged lines -> state rows
    merge: tuple                                    # aggregate, column, ...: state rows of one state key -> one
    critical: Callable[[DataFrame, dt.date, Params], DataFrame]  # state -> critical keys with FIGURES


def _credit_partial(stg: DataFrame) -> DataFrame:
    return (stg.where((F.col("payment_status") != "PAID") & F.col("payment_due_date").isNotNull())
            .groupBy("customer_id", "payment_due_date")
            .agg(F.sum("total_amount").cast(SUM_MONEY).alias("amount"), F.min("transaction_date").alias("first_date")))


def _credit_critical(state: DataFrame, as_of: dt.date, p: Params) -> DataFrame:
    late = state.withColumn("days", days_between(F.lit(as_of), F.col("payment_due_date"))).where(F.col("days") >= p.credit_risk_days)
    per = late.groupBy(F.col("customer_id").alias("entity_id")).agg(
        F.sum("amount").cast(SUM_MONEY).alias("amount"), F.max("days").alias("days"), F.min("first_date").alias("first_date"))
    return per.where(M.credit_severity(F.col("amount"), F.col("days"), p) == "CRITICAL").select(
        "entity_id", customer_name_of(F.col("entity_id")).alias("entity_name"), "amount", "days", "first_date",
        M.credit_action(F.col("days")).alias("recommended_action"))


def _dead_partial(stg: DataFrame) -> DataFrame:
    return stg.groupBy("product_id").agg(F.max("transaction_date").alias("last_date"), F.sum("quantity").cast(SUM_MONEY).alias("amount"))


def _dead_critical(state: DataFrame, as_of: dt.date, p: Params) -> DataFrame:
    per = state.groupBy(F.col("product_id").alias("entity_id")).agg(
        F.max("last_date").alias("first_date"), F.sum("amount").cast(SUM_MONEY).alias("amount"))
    per = per.withColumn("days", days_between(F.lit(as_of), F.col("first_date"))).where(F.col("days") >= p.dead_stock_days)
    return per.where(M.dead_severity(F.col("days"), p) == "CRITICAL").select(
        "entity_id", product_name_of(F.col("entity_id")).alias("entity_name"), "amount", "days", "first_date",
        M.dead_action(F.col("days")).alias("recommended_action"))


KINDS = (
    Kind(C.CREDIT_RISK, "customer_id", ("customer_id", "payment_due_date"),
         "customer_id string, payment_due_date date, amount decimal(38,4), first_date date", _credit_partial,
         (F.sum, "amount", F.min, "first_date"), _credit_critical),
    Kind(C.DEAD_STOCK, "product_id", ("product_id",), "product_id string, last_date date, amount decimal(38,4)", _dead_partial,
         (F.max, "last_date", F.sum, "amount"), _dead_critical),
)


def _merged(kind: Kind, parts: list[DataFrame]) -> DataFrame:
    calls = [f(c).alias(c) for f, c in zip(kind.merge[::2], kind.merge[1::2])]
    out = reduce(DataFrame.unionByName, parts).groupBy(*kind.state_key).agg(*calls)
    return out.select(*(F.col(f.split()[0]).cast(f.split(" ", 1)[1]) for f in kind.schema.split(", ")))


def _parts(spark: SparkSession, kind: Kind, store: str, before: int) -> list[DataFrame]:
    """Snapshot and deltas that hold the state of the batches before ``before``."""
    base = (before - 1) // COMPACT * COMPACT if before > COMPACT else 0
    paths = [f"{store}/{kind.alert_type}/snapshot/{base}"] if base else []
    paths += [f"{store}/{kind.alert_type}/delta/{n}" for n in range(base, before)]
    return [spark.read.schema(kind.schema).parquet(path) for path in paths]


def _day(spark: SparkSession, store: str, batch: int) -> dt.date | None:
    seen = read_if_there(spark, f"{store}/day/{batch}")
    return seen.first()[0] if seen is not None else None


def update(spark: SparkSession, staged: DataFrame, batch: int, store: str, out_path: str, p: Params = DEFAULT,
           today: Callable[[], dt.date] | None = None) -> None:
    """One batch: its staged lines into the state, what they and the day change into events."""
    day = _day(spark, store, batch) or (today() if today else p.as_of)
    spark.createDataFrame([(day,)], "day date").coalesce(1).write.mode("overwrite").parquet(f"{store}/day/{batch}")
    last_day = (_day(spark, store, batch - 1) if batch else None) or day
    events = []
    for kind in KINDS:
        here = f"{store}/{kind.alert_type}/delta/{batch}"
        kind.partial(staged).write.mode("overwrite").parquet(here)
        delta = spark.read.schema(kind.schema).parquet(here)
        old = _parts(spark, kind, store, batch)
        if batch and batch % COMPACT == 0:  # the batches before this one
            snapshot = f"{store}/{kind.alert_type}/snapshot/{batch}"
            _merged(kind, old).write.mode("overwrite").parquet(snapshot)
            old = [spark.read.schema(kind.schema).parquet(snapshot)]
        new = [*old, delta]
        if day == last_day:
            touched = delta.select(F.col(kind.key).alias("_touched")).distinct()
            old, new = ([x.join(touched, F.col(kind.key).eqNullSafe(F.col("_touched")), "left_semi") for x in parts] for parts in (old, new))
        was = kind.critical(reduce(DataFrame.unionByName, old or [delta.limit(0)]), last_day, p)
        now = kind.critical(reduce(DataFrame.unionByName, new), day, p)
        events.append(_events(kind, was, now, day))
    reduce(DataFrame.unionByName, events).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch}")


def _events(kind: Kind, was: DataFrame, now: DataFrame, day: dt.date) -> DataFrame:
    was = was.select(F.col("entity_id").alias("_id"), F.struct(*FIGURES).alias("_was"))
    now = now.select("entity_id", F.struct(*FIGURES).alias("_now"))
    both = now.join(was, F.col("entity_id").eqNullSafe(F.col("_id")), "full")
    event = (F.when(F.col("_was").isNull(), "raised").when(F.col("_now").isNull(), "cleared")
              .when(~F.col("_now").eqNullSafe(F.col("_was")), "changed"))
    shown = F.coalesce("_now", "_was")
    out = both.select(F.lit(kind.alert_type).alias("alert_type"), F.coalesce("entity_id", "_id").alias("entity_id"),
                      *(shown[c].alias(c) for c in FIGURES), event.alias("event"), F.lit(day).alias("as_of"))
    return out.where(F.col("event").isNotNull()).select(
        *(F.col(f.split()[0]).cast(f.split(" ", 1)[1]) for f in EVENT_SCHEMA.split(", ")))


def read_events(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA + ", batch_id int").parquet(out_path)


def standing_alerts(spark: SparkSession, out_path: str) -> DataFrame:
    """The critical alerts that hold now: the last event of every key, unless it was cleared."""
    last = F.row_number().over(Window.partitionBy("alert_type", "entity_id").orderBy(F.desc("batch_id")))
    events = read_events(spark, out_path)
    return events.withColumn("_n", last).where("_n = 1 AND event != 'cleared'").drop("_n", "event", "batch_id")
