"""The three alert marts: dead stock, low-margin sales, credit risk.

Each mart is built from staging plus the one metric it needs, aggregated
before it is joined (an aggregate-then-join plan shuffles per-key partials
instead of every sale line).  Marts are unordered tables; ordering happens in
the top-k fetch of ``alerts``.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.config import DEFAULT, Params
from ledgerlens.functions.columns import MARGIN_TYPE, days_between, exact_ratio, severity_rank
from ledgerlens.operators.metrics import SUM_MONEY, customer_lifetime_value, exact_avg, product_avg_margin
from ledgerlens.operators.ranking import numbered, weight_before
from ledgerlens.operators.staging import customer_name_of, product_name_of

DEAD_STOCK_COLUMNS = (
    "product_id", "product_name", "last_sale_date", "days_since_last_sale",
    "total_quantity_ever_sold", "avg_margin", "estimated_value_locked",
    "alert_severity", "recommended_action", "analysis_date",
)
LOW_MARGIN_COLUMNS = (
    "transaction_id", "transaction_date", "customer_id", "customer_name", "product_id",
    "product_name", "quantity", "unit_price", "cost_price", "margin_percentage", "total_amount",
    "total_margin_earned", "margin_gap_vs_target", "avg_product_margin", "margin_vs_product_avg",
    "alert_severity", "probable_cause", "recommended_action", "analysis_date",
)
CREDIT_RISK_COLUMNS = (
    "customer_id", "customer_name", "overdue_invoice_count", "total_overdue_amount",
    "max_days_overdue", "avg_days_overdue", "oldest_unpaid_date", "customer_lifetime_value",
    "overdue_invoice_ids", "payment_score", "risk_percentage_of_ltv", "alert_severity",
    "recommended_action", "analysis_date",
)


def _finish(df: DataFrame, cols, with_created_at: bool) -> DataFrame:
    out = df.select(*cols)
    return out.withColumn("created_at", F.current_timestamp()) if with_created_at else out


def dead_severity(days: Column, p: Params = DEFAULT) -> Column:
    return (F.when(days >= C.DEAD_CRITICAL_DAYS, "CRITICAL").when(days >= C.DEAD_HIGH_DAYS, "HIGH")
             .when(days >= p.dead_stock_days, "MEDIUM").otherwise("LOW"))


def dead_action(days: Column) -> Column:
    return (F.when(days >= C.DEAD_CRITICAL_DAYS, C.DEAD_ACTION_CRITICAL).when(days >= C.DEAD_HIGH_DAYS, C.DEAD_ACTION_HIGH)
             .when(days >= C.DEAD_ACTION_DAYS, C.DEAD_ACTION_MEDIUM).otherwise(C.DEAD_ACTION_NORMAL))


def credit_severity(amount: Column, most_days: Column, p: Params = DEFAULT) -> Column:
    return (F.when((amount > C.CREDIT_CRITICAL_AMOUNT) & (most_days > C.CREDIT_HIGH_DAYS), "CRITICAL")
             .when(most_days > C.CREDIT_CRITICAL_DAYS, "CRITICAL").when(most_days > C.CREDIT_HIGH_DAYS, "HIGH")
             .when(most_days > C.CREDIT_MEDIUM_DAYS, "MEDIUM").when(most_days > p.credit_risk_days, "LOW").otherwise("INFO"))


def credit_action(most_days: Column) -> Column:
    return (F.when(most_days > C.CREDIT_CRITICAL_DAYS, C.CREDIT_ACTION_CRITICAL).when(most_days > C.CREDIT_HIGH_DAYS, C.CREDIT_ACTION_HIGH)
             .when(most_days > C.CREDIT_MEDIUM_DAYS, C.CREDIT_ACTION_MEDIUM).otherwise(C.CREDIT_ACTION_LOW))


def dead_stock(stg: DataFrame, p: Params = DEFAULT, with_created_at: bool = True) -> DataFrame:
    """Products whose last sale is at least ``dead_stock_days`` before ``as_of``.

    Built straight from staging: none of the enriched columns is used, and the
    aggregate's partial sums make one hot product cost one row per task."""
    agg = stg.groupBy("product_id").agg(
        F.max("transaction_date").alias("last_sale_date"),
        F.sum("quantity").cast(SUM_MONEY).alias("total_quantity_ever_sold"),
        exact_avg("margin_percentage").alias("avg_margin"),
    )
    days = days_between(F.lit(p.as_of), F.col("last_sale_date"))
    df = (agg.withColumn("days_since_last_sale", days).where(F.col("days_since_last_sale") >= p.dead_stock_days)
             .withColumn("product_name", product_name_of(F.col("product_id"))))
    d = F.col("days_since_last_sale")
    df = df.withColumns({
        "estimated_value_locked": F.round(
            F.col("total_quantity_ever_sold") * F.lit(C.DEAD_VALUE_FACTOR) * F.lit(C.DEAD_VALUE_UNIT_PRICE), 2
        ).cast("decimal(38,2)"),
        "alert_severity": dead_severity(d, p),
        "recommended_action": dead_action(d),
        "analysis_date": F.lit(p.as_of),
    })
    return _finish(df, DEAD_STOCK_COLUMNS, with_created_at)


def low_margin(stg: DataFrame, p: Params = DEFAULT, with_created_at: bool = True,
               product_avg: DataFrame | None = None) -> DataFrame:
    """Recent sale lines below the margin target, with cost known.

    The product average is over *all* of the product's lines, so it comes from
    a narrow per-product aggregate (partial + final) joined to the filtered
    lines; AQE broadcasts it only if its measured size is under the threshold."""
    thr = F.lit(p.low_margin_threshold)
    gap_scale = 4 + max(2, -p.low_margin_threshold.as_tuple().exponent)
    m = F.col("margin_percentage")
    cutoff = p.as_of - _dt.timedelta(days=p.low_margin_lookback_days)
    # the same window on (year, month): redundant as a filter, but when staging
    # is stored partitioned by them it prunes every older partition at scan time
    month_key = F.col("transaction_year") * 100 + F.col("transaction_month")
    recent = stg.where((month_key >= cutoff.year * 100 + cutoff.month)
                       & (m < thr) & F.col("cost_price").isNotNull()
                       & (F.col("transaction_date") >= F.lit(cutoff)))
    pavg = product_avg if product_avg is not None else product_avg_margin(stg)
    df = recent.join(pavg, "product_id", "left")
    earned = F.col("unit_margin") * F.col("quantity")
    df = df.withColumns({
        "total_margin_earned": earned.cast("decimal(38,8)"),
        # (target unit margin - unit margin) * quantity, exact: operands narrowed so
        # the product stays under the 38-digit cap, with every digit of the target
        "margin_gap_vs_target": ((thr * F.col("unit_price") - F.col("unit_margin")).cast(f"decimal(20,{gap_scale})")
                                 * F.col("quantity").cast("decimal(17,4)")).cast(f"decimal(38,{gap_scale + 4})"),
        "margin_vs_product_avg": (m - F.col("avg_product_margin")).cast(MARGIN_TYPE),
        "alert_severity": F.when(m < 0, "CRITICAL").when(m < F.lit(C.LOW_MARGIN_HIGH), "HIGH")
                           .when(m < thr, "MEDIUM").otherwise("LOW"),
        "probable_cause": F.when(m < 0, C.CAUSE_BELOW_COST)
                           .when(F.col("cost_price").isNull(), C.CAUSE_MISSING_COST)
                           .when(m < F.col("avg_product_margin"), C.CAUSE_BELOW_AVG)
                           .otherwise(C.CAUSE_GENERAL),
        "recommended_action": F.when(m < 0, C.MARGIN_ACTION_CRITICAL)
                               .when(m < F.lit(C.LOW_MARGIN_HIGH), C.MARGIN_ACTION_HIGH)
                               .otherwise(C.MARGIN_ACTION_OTHER),
        "analysis_date": F.lit(p.as_of),
    })
    return _finish(df, LOW_MARGIN_COLUMNS, with_created_at)


def overdue_lines(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return stg.where((F.col("payment_status") != "PAID") & (F.col("days_overdue") >= p.credit_risk_days))


def overdue_invoices(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """One row per customer, sale date and overdue invoice: the list behind a
    customer's alert as a table of its own, which grows by rows where the mart's
    id text is one value per customer."""
    return overdue_lines(stg, p).groupBy("customer_id", "transaction_date", "transaction_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("total_amount").cast(SUM_MONEY).alias("amount"),
        F.max("days_overdue").alias("max_days"),
        F.sum("days_overdue").alias("sum_days"),
        F.count("days_overdue").alias("n_days"),
    )


def credit_risk(stg: DataFrame, p: Params = DEFAULT, with_created_at: bool = True,
                ltv: DataFrame | None = None) -> DataFrame:
    """Customers with unpaid lines at least ``credit_risk_days`` overdue.

    One aggregation chain, invoice -> customer-day -> customer, so that the
    ordered id list is built in pieces: per day the ids are joined in id order,
    per customer the day pieces in date order.  No task ever merges more than
    one customer's day pieces, and every level is a partial + final aggregate.
    An invoice counts once even if its lines carry two dates: the window that
    marks its first date is partitioned by (customer, invoice), so a partition
    holds one invoice's dates, never a whole customer."""
    tid = F.col("transaction_id")
    inv = overdue_invoices(stg, p)
    first_date = F.min("transaction_date").over(Window.partitionBy("customer_id", "transaction_id"))
    inv = inv.withColumns({
        # the id once per line (multi-line invoices repeat in the list)
        "piece": F.when(tid.isNotNull(), F.array_join(F.array_repeat(tid, F.col("n_lines").cast("int")), ", ")),
        "first_of_id": tid.isNotNull() & (F.col("transaction_date") == first_date),
    })
    day = inv.groupBy("customer_id", "transaction_date").agg(
        F.expr("listagg(piece, ', ') WITHIN GROUP (ORDER BY transaction_id)").alias("day_ids"),
        F.count_if("first_of_id").alias("ids"),
        F.sum("amount").alias("amount"), F.max("max_days").alias("max_days"),
        F.sum("sum_days").alias("sum_days"), F.sum("n_days").alias("n_days"))
    per_customer = day.groupBy("customer_id").agg(
        F.sum("ids").cast("bigint").alias("overdue_invoice_count"),
        F.sum("amount").cast(SUM_MONEY).alias("total_overdue_amount"),
        F.max("max_days").alias("max_days_overdue"),
        F.sum("sum_days").alias("sum_days"),
        F.sum("n_days").alias("n_days"),
        F.min("transaction_date").alias("oldest_unpaid_date"),
        F.expr("listagg(day_ids, ', ') WITHIN GROUP (ORDER BY transaction_date)").alias("overdue_invoice_ids"),
    ).withColumn("customer_name", customer_name_of(F.col("customer_id")))
    lt = ltv if ltv is not None else customer_lifetime_value(stg)
    df = per_customer.join(lt, "customer_id", "left")
    mx = F.col("max_days_overdue")
    amt = F.col("total_overdue_amount")
    score = F.lit(C.PAYMENT_SCORE_DEFAULT)
    for days, s in reversed(C.PAYMENT_SCORE_STEPS):
        score = F.when(mx > days, F.lit(s)).otherwise(score)
    clv = F.col("customer_lifetime_value")
    df = df.withColumns({
        "avg_days_overdue": F.round(F.col("sum_days") / F.col("n_days"), 0),
        "payment_score": score.cast("bigint"),
        "risk_percentage_of_ltv": F.round(
            exact_ratio(amt, F.when(clv != 0, clv)).cast("decimal(20,9)") * F.lit(Decimal(100)), 2)
            .cast("decimal(38,2)"),
        "alert_severity": credit_severity(amt, mx, p),
        "recommended_action": credit_action(mx),
        "analysis_date": F.lit(p.as_of),
    })
    return _finish(df, CREDIT_RISK_COLUMNS, with_created_at)


DISPLAY_METRICS = {"dead_stock": ("days_since_last_sale", ("product_id",)),
                   "low_margin": ("margin_gap_vs_target", LOW_MARGIN_COLUMNS),
                   "credit_risk": ("total_overdue_amount", ("customer_id",))}


def displayed(mart: DataFrame, name: str) -> DataFrame:
    """The mart with ``display_rank``: its rows by severity (by rank, not by text),
    then the mart's metric descending, then a unique key (the low-margin mart has
    none but the whole row, so only equal rows can change places)."""
    metric, key = DISPLAY_METRICS[name]
    order = [severity_rank("alert_severity"), F.col(metric).desc_nulls_last(), *(F.col(k).asc_nulls_first() for k in key if k != metric)]
    return numbered(mart, order, name="display_rank")


INVOICE_CHUNK = 4000  # characters


def overdue_invoice_chunks(stg: DataFrame, p: Params = DEFAULT, chars: int = INVOICE_CHUNK) -> DataFrame:
    """(customer_id, chunk, ids): the id list of a customer's alert in numbered
    chunks of at most about two times ``chars`` characters; joined by ', ' in order they are the
    mart's text.  A chunk is where the running length of the list falls, so a
    customer with any share of the lines is spread over tasks; an invoice with very
    many lines is cut too."""
    tid = F.col("transaction_id")
    inv = overdue_invoices(stg, p).where(tid.isNotNull())
    each = F.length(tid) + 2
    most = F.greatest(F.lit(1), F.floor(F.lit(chars) / each))  # lines of one invoice in a piece
    inv = inv.withColumn("most", most.cast("bigint")).withColumn(
        "cut", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_lines") - 1) / F.col("most")))))
    lines = F.least(F.col("most"), F.col("n_lines") - F.col("cut") * F.col("most"))
    pieces = inv.select("customer_id", "transaction_date", "transaction_id", "cut", lines.alias("n"), (lines * each).alias("chars"))
    order = [F.col("transaction_date"), F.col("transaction_id"), F.col("cut")]
    placed = weight_before(pieces, "chars", order, ("customer_id",), "before")
    piece = F.array_join(F.array_repeat(tid, F.col("n").cast("int")), ", ")
    placed = placed.withColumns({"chunk": F.floor(F.col("before") / chars), "piece": piece})
    return placed.groupBy("customer_id", "chunk").agg(
        F.expr("listagg(piece, ', ') WITHIN GROUP (ORDER BY before)").alias("ids"))
