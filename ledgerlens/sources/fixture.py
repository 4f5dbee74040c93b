"""Raw sales, inventory and master tables derived from the TPC-H-style test tables.

The order lines play the raw sales export (one row per line).  Amounts are
built from whole cents so that exact decimals agree between engines.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.config import CATEGORY_MARGINS, DEFAULT, Params

# Fixed values of the fixture (FIXTURES.md section 2)
PAID_CUTOFF = _dt.date(2001, 3, 20)
MISMATCH_MOD = 53      # total_amount left as the raw extended price
UNPAID_MOD = 97        # keeps an old order unpaid
BAD_DUE_MOD = 101      # due date text that is not a date
DUE_DAYS = 30
NO_COST_SIZE = 50      # parts of this size export no cost
STOCK_MOD = 40
NO_ID_MOD = 211        # raw transaction id left empty (order key; other ids repeat per line)
NO_DATE_MOD = 1009     # no sale date
FUTURE_MOD = 307       # dated after as_of
NO_QUANTITY_MOD = 499  # quantity 0
NO_TOTAL_MOD = 601     # total 0
NO_PRICE_MOD = 701     # price 0
NEGATIVE_STOCK_MOD = 97
CATEGORY_MOD = 6       # part key modulo it below 4: a configured category, else the part type's first word
REORDER_LEVEL = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def product_key(p_name, p_partkey):
    return F.concat(p_name, F.lit(" #"), p_partkey.cast("string"))


LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")


def dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    return o, c, p


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw sale line per lineitem row, columns as a sales export has them."""
    return raw_sales_from(table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS), *dimensions(spark, sf_dir))


def raw_sales_from(li: DataFrame, o: DataFrame, c: DataFrame, p: DataFrame, extra=()) -> DataFrame:
    """The raw-sales projection over order lines joined to orders, customers and
    parts.

    Customers are joined to orders before the lines: where nothing is small
    enough to broadcast, that shuffles the order rows (about a quarter of the
    lines) by customer instead of the joined line rows."""
    oc = o.join(c, o.o_custkey == c.c_custkey)
    j = li.join(oc, li.l_orderkey == oc.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    ok = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    d = F.when(ok % FUTURE_MOD == 0, F.date_add(d, 400)).otherwise(d)
    cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint")
    cent = F.lit(Decimal("0.01"))
    line_total = (F.col("l_quantity").cast("bigint") * cents * cent).cast("decimal(18,4)")
    return j.select(
        F.col("o_orderkey").cast("string").alias("invoice_number"),
        F.when(ok % NO_ID_MOD != 0, ok.cast("string")).alias("transaction_id"),
        F.when(ok % NO_DATE_MOD != 0, d.cast("string")).alias("transaction_date"),
        F.col("c_name").alias("customer_name"),
        product_key(F.col("p_name"), F.col("p_partkey")).alias("product_name"),
        F.when(ok % NO_QUANTITY_MOD == 0, F.lit(0)).otherwise(F.col("l_quantity")).cast("decimal(18,4)").alias("quantity"),
        F.when(ok % NO_PRICE_MOD == 0, F.lit(0)).otherwise(cents * cent).cast("decimal(18,4)").alias("unit_price"),
        F.when(F.col("p_size") == NO_COST_SIZE, F.lit(None).cast("decimal(18,4)"))
         .otherwise(F.col("p_retailprice").cast("decimal(18,4)")).alias("cost_price"),
        F.when(ok % NO_TOTAL_MOD == 0, F.lit(0).cast("decimal(18,4)"))
         .when(ok % MISMATCH_MOD == 0, F.col("l_extendedprice").cast("decimal(18,4)"))
         .otherwise(line_total).alias("total_amount"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Paid"))
         .when((d < F.lit(PAID_CUTOFF)) & (F.col("o_orderkey") % UNPAID_MOD != 0), F.lit(" paid "))
         .when(F.col("o_orderstatus") == "P", F.lit("Partial"))
         .otherwise(F.lit(None).cast("string")).alias("payment_status"),
        F.when(F.col("o_orderkey") % BAD_DUE_MOD == 0, F.lit("not a date"))
         .otherwise(F.date_add(d, DUE_DAYS).cast("string")).alias("payment_due_date"),
        *extra,
    )


def sales_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two optional text fields of a sale line whose values the schema lists."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    mode = F.when(F.col("l_returnflag") == "A", "Cash").when(F.col("l_returnflag") == "N", " upi ").otherwise("Barter")
    kind = F.when(F.col("c_custkey") % 3 == 0, "Wholesaler").otherwise(F.col("c_mktsegment"))
    joined = li.join(o.join(c, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(F.col("l_orderkey").cast("string").alias("transaction_id"), kind.alias("customer_type"), mode.alias("payment_mode"))


def category():
    names = list(CATEGORY_MARGINS)
    of = F.split(F.col("p_type"), " ").getItem(0)
    for i, name in enumerate(names):
        of = F.when(F.col("p_partkey") % CATEGORY_MOD == i, F.lit(name)).otherwise(of)
    return of


def inventory_snapshot(spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    """One inventory row per part at ``as_of``."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    key = product_key(F.col("p_name"), F.col("p_partkey"))
    return part.select(
        key.alias("product_id"),
        key.alias("product_name"),
        F.lit(p.as_of).alias("snapshot_date"),
        F.when(F.col("p_partkey") % NEGATIVE_STOCK_MOD == 0, F.lit(-3)).otherwise(F.col("p_partkey") % STOCK_MOD)
         .cast("decimal(18,4)").alias("quantity_on_hand"),
        F.lit(Decimal(REORDER_LEVEL)).cast("decimal(18,4)").alias("reorder_level"),
        # a last-sale stamp spread over the year before the snapshot; a few land after it
        F.date_sub(F.lit(p.as_of), (F.col("p_partkey") % 365 - 3).cast("int")).alias("last_sale_date"),
        category().alias("product_category"),
    )


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_name").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_type"),
        F.floor(F.col("c_acctbal") * 100).cast("bigint").cast("decimal(18,0)")
         .__mul__(F.lit(Decimal("0.01"))).cast("decimal(18,4)").alias("credit_limit"),
        F.col("n_name").alias("territory"),
    )


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    key = product_key(F.col("p_name"), F.col("p_partkey"))
    return p.select(
        key.alias("product_id"),
        key.alias("product_name"),
        category().alias("product_category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("decimal(18,4)").alias("standard_cost"),
    )
