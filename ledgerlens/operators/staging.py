"""Staging: typed, trimmed sale lines with margins and overdue days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import DEFAULT, Params
from ledgerlens.functions.columns import MARGIN_TYPE, days_between, exact_ratio, month_name, ws_trim

MONEY = "decimal(18,4)"

STAGING_COLUMNS = (
    "transaction_id", "transaction_date", "transaction_year", "transaction_month",
    "transaction_month_name", "transaction_quarter", "customer_id", "customer_name",
    "product_name", "product_id", "quantity", "unit_price", "cost_price", "total_amount",
    "unit_margin", "margin_percentage", "payment_status", "payment_due_date", "days_overdue",
)


# columns that follow from the others (see ``derived``)
DERIVED_COLUMNS = ("transaction_year", "transaction_month", "transaction_month_name", "transaction_quarter", "customer_name",
                   "product_name", "unit_margin", "margin_percentage", "days_overdue")


def customer_name_of(customer_id) -> Column:
    """Display name from the customer id (the raw name): trimmed upper case.
    Aggregates group by the id and derive the name afterwards, instead of
    carrying a string max through the shuffle."""
    return F.upper(ws_trim(customer_id))


def product_name_of(product_id) -> Column:
    return ws_trim(product_id)


def derived(p: Params, day: Column, customer_id: Column, product_id: Column, price: Column, cost: Column,
            status: Column, due: Column) -> dict[str, Column]:
    """The staging columns that follow from others."""
    margin = price - F.coalesce(cost, F.lit(0).cast(MONEY))
    return {
        "transaction_year": F.year(day).cast("bigint"),
        "transaction_month": F.month(day).cast("bigint"),
        "transaction_month_name": month_name(day),
        "transaction_quarter": F.quarter(day).cast("bigint"),
        "customer_name": customer_name_of(customer_id),
        "product_name": product_name_of(product_id),
        "unit_margin": margin,
        "margin_percentage": F.when(price > 0, exact_ratio(margin, price)).otherwise(F.lit(0).cast(MARGIN_TYPE)),
        "days_overdue": F.when(status == "PAID", F.lit(0).cast("bigint"))
                         .when(due.isNull(), F.lit(None).cast("bigint"))
                         .otherwise(days_between(F.lit(p.as_of), due)),
    }


def narrowed(stg: DataFrame) -> DataFrame:
    """Staging rows without the columns that follow from the others."""
    return stg.drop(*DERIVED_COLUMNS)


def widened(rows: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``narrowed`` staging rows with all staging columns again, other columns after them."""
    made = derived(p, *map(F.col, ("transaction_date", "customer_id", "product_id", "unit_price", "cost_price", "payment_status", "payment_due_date")))
    others = [c for c in rows.columns if c not in STAGING_COLUMNS]
    return rows.select(*(made[c].alias(c) if c in made else F.col(c) for c in STAGING_COLUMNS), *others)


def _with_missing(raw: DataFrame) -> DataFrame:
    """Exports from some systems lack cost, invoice, status or due date:
    add them as typed nulls so the projection below always resolves."""
    need = {"invoice_number": "string", "cost_price": MONEY, "payment_status": "string",
            "payment_due_date": "string"}
    missing = {k: F.lit(None).cast(t) for k, t in need.items() if k not in raw.columns}
    if "invoice_number" in missing and "transaction_id" in raw.columns:
        missing["invoice_number"] = F.col("transaction_id").cast("string")
    return raw.withColumns(missing) if missing else raw


def stage_sales(raw: DataFrame, p: Params = DEFAULT, with_loaded_at: bool = True, by_month: bool = False) -> DataFrame:
    """Raw sales export -> staging rows.  ``by_month`` brings the rows of a month
    together (to be written so) while they are the narrow raw rows: half of the
    staging columns follow from the others, and need no shuffle.

    The row filter reads the raw columns, as the warehouse model does; the
    date parse is strict (an unparseable date fails the job under ANSI)."""
    raw = _with_missing(raw)
    types = dict(raw.dtypes)

    def num(c: str) -> Column:
        # text columns (a CSV read as strings) are compared as numbers
        return F.col(c).cast(MONEY) if types.get(c) == "string" else F.col(c)

    kept = raw.where(F.col("transaction_date").isNotNull() & (num("quantity") > 0) & (num("total_amount") > 0))
    d = F.to_date(F.col("transaction_date"), "yyyy-MM-dd")
    if by_month:  # AQE sizes the tasks and splits a hot month
        kept = kept.withColumns({"_year": F.year(d), "_month": F.month(d)}).hint("rebalance", "_year", "_month")
    qty = F.col("quantity").cast(MONEY)
    price = F.col("unit_price").cast(MONEY)
    cost = F.col("cost_price").cast(MONEY)
    status = F.upper(ws_trim(F.coalesce(F.col("payment_status").cast("string"), F.lit("UNPAID"))))
    due = F.try_to_date(F.col("payment_due_date").cast("string"), "yyyy-MM-dd")
    values = derived(p, d, F.col("customer_name"), F.col("product_name"), price, cost, status, due) | {
        "transaction_id": F.col("invoice_number").cast("string"),
        "transaction_date": d,
        "customer_id": F.col("customer_name").cast("string"),
        "product_id": F.col("product_name").cast("string"),
        "quantity": qty,
        "unit_price": price,
        "cost_price": cost,
        "total_amount": F.col("total_amount").cast(MONEY),
        "payment_status": status,
        "payment_due_date": due,
    }
    cols = [values[c].alias(c) for c in STAGING_COLUMNS]
    if with_loaded_at:
        cols.append(F.current_timestamp().alias("loaded_at"))
    return kept.select(*cols)
