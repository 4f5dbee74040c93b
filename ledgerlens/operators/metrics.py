"""Customer and product metrics, and the enriched sale lines.

Metrics group by the id alone: the display name is a function of the id, so
it is derived from the key after the aggregate.  The aggregate output is then hash-partitioned on
the join key, which the enriched join can reuse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import DEFAULT, Params
from ledgerlens.functions.columns import MARGIN_TYPE, days_between
from ledgerlens.operators.staging import customer_name_of, product_name_of

SUM_MONEY = "decimal(38,4)"


def exact_avg(c: str | Column) -> Column:
    """Mean of a decimal column, exact sum / count rounded half-up to 9 digits."""
    col = F.col(c) if isinstance(c, str) else c
    # an all-null group has no mean (and would divide by zero under ANSI)
    return F.when(F.count(col) > 0, F.sum(col) / F.count(col)).cast(MARGIN_TYPE)


def customer_metrics(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return (stg.groupBy("customer_id").agg(
        F.count_distinct("transaction_id").alias("total_transactions"),
        F.sum("total_amount").cast(SUM_MONEY).alias("lifetime_value"),
        exact_avg("margin_percentage").alias("avg_customer_margin"),
        F.max("transaction_date").alias("last_purchase_date"),
        F.sum(F.when(F.col("payment_status") != "PAID", F.col("total_amount"))
               .otherwise(F.lit(0))).cast(SUM_MONEY).alias("total_outstanding"),
        F.count_if(F.col("days_overdue") > 0).alias("overdue_invoice_count"),
    ).withColumns({"customer_name": customer_name_of(F.col("customer_id")),
                   "days_since_last_purchase": days_between(F.lit(p.as_of), F.col("last_purchase_date"))})
     .select("customer_id", "customer_name", "total_transactions", "lifetime_value",
             "avg_customer_margin", "last_purchase_date", "days_since_last_purchase",
             "total_outstanding", "overdue_invoice_count"))


def product_metrics(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    recent = F.col("transaction_date") >= F.date_sub(F.lit(p.as_of), p.velocity_days)
    return (stg.groupBy("product_id").agg(
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("quantity").cast(SUM_MONEY).alias("total_quantity_sold"),
        exact_avg("margin_percentage").alias("avg_product_margin"),
        F.max("transaction_date").alias("last_sold_date"),
        F.sum(F.when(recent, F.col("quantity")).otherwise(F.lit(0))).cast(SUM_MONEY)
         .alias("quantity_sold_last_30d"),
    ).withColumns({"product_name": product_name_of(F.col("product_id")),
                   "days_since_last_sold": days_between(F.lit(p.as_of), F.col("last_sold_date"))})
     .select("product_id", "product_name", "unique_customers", "total_quantity_sold",
             "avg_product_margin", "last_sold_date", "days_since_last_sold", "quantity_sold_last_30d"))


def product_avg_margin(stg: DataFrame) -> DataFrame:
    """Only the column low-margin needs: a narrow aggregate, one partial sum per task."""
    return stg.groupBy("product_id").agg(exact_avg("margin_percentage").alias("avg_product_margin"))


def customer_lifetime_value(stg: DataFrame) -> DataFrame:
    return stg.groupBy("customer_id").agg(
        F.sum("total_amount").cast(SUM_MONEY).alias("customer_lifetime_value"))


def customer_facts(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """What an enriched line tells of its customer."""
    return customer_metrics(stg, p).select(
        "customer_id",
        F.col("lifetime_value").alias("customer_lifetime_value"),
        "days_since_last_purchase",
        "avg_customer_margin",
        F.col("total_outstanding").alias("customer_total_outstanding"),
        F.col("overdue_invoice_count").alias("customer_overdue_count"))


def product_facts(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """What an enriched line tells of its product."""
    return product_metrics(stg, p).select(
        "product_id",
        "avg_product_margin",
        F.col("last_sold_date").alias("product_last_sold_date"),
        F.col("days_since_last_sold").alias("product_days_since_last_sold"),
        F.col("quantity_sold_last_30d").alias("product_velocity_30d"))


def enrich_sales(stg: DataFrame, p: Params = DEFAULT, customers: DataFrame | None = None,
                 products: DataFrame | None = None) -> DataFrame:
    """Every staging line plus its customer and product metrics (left joins on
    the id alone; ids are unique on the right, so no row fans out).  Skewed
    customers are split by AQE's skew-join handling on the preserved side.
    ``customers`` and ``products``: the facts, where ``stg`` is only a part of the
    lines they are made of."""
    cm = customer_facts(stg, p) if customers is None else customers
    pm = product_facts(stg, p) if products is None else products
    base = stg.columns
    return (stg.join(cm, "customer_id", "left").join(pm, "product_id", "left")
               .select(*base, *[c for c in cm.columns if c != "customer_id"],
                       *[c for c in pm.columns if c != "product_id"]))
