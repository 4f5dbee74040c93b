"""Sales exports in the three source systems' layouts, derived from the test
tables, written once per session as CSV under the shared checkpoint folder.

The rows are the raw sales lines (see ``fixture.raw_sales``) with some text
dirt derived from the keys: day-first dates, rupee signs and digit groups,
bad numbers, empty names and surrounding blanks.
"""

from __future__ import annotations

from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ledgerlens import config as C
from ledgerlens.session import session_key, shared_path, shuffles_dropped
from ledgerlens.sources import files, fixture
from ledgerlens.sources.fixture import product_key, table

# Fixed values of the export dirt (all keyed on order / customer / part keys)
DAY_FIRST_MOD = 11      # date written dd/MM/yyyy
NO_DATE_MOD = 211       # date left empty
BAD_DATE_MOD = 223      # date text that is not a date
TIMED_MOD = 17          # date written with a time of day
MONTH_FIRST_MOD = 23    # date written MM/dd/yyyy (where it cannot be read day first)
NAMED_MOD = 29          # date written dd-MMM-yyyy
QUOTED_MOD = 31         # product name with a quote and a comma (part key)
RUPEE_MOD = 7           # price written with rupee sign and digit groups
BAD_PRICE_MOD = 83      # price text that is not a number
ZERO_QTY_MOD = 89       # quantity written as 0
NO_NAME_MOD = 97        # customer name left empty (customer key)
PADDED_MOD = 13         # customer name with a tab and a no-break space around it
ACCENT_MOD = 19         # customer name with accented letters (non-ASCII text)
FUTURE_MOD = 307        # order dated after as_of

_CACHE: dict[tuple, str] = {}


ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order, customer and part, as the files have them: the
    lines of an order stand in one file in line order, so the files carry a known
    "first" row per id.  Orders are dealt by their key, as the join with them deals
    the lines (no further shuffle), and the narrow lines are sorted before their
    text is made."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o, c, p = fixture.dimensions(spark, sf_dir)
    oc = o.join(c, o.o_custkey == c.c_custkey)
    # orders last, so that this join's shuffle is the one by order
    j = li.join(p, li.l_partkey == p.p_partkey).join(oc, F.col("l_orderkey") == oc.o_orderkey)
    return j.repartition(F.col("l_orderkey")).sortWithinPartitions(*ORDER)


@contextmanager
def kept_lines(spark: SparkSession, sf_dir: str):
    """The lines joined once for several exports that are written in turn."""
    lines = _lines(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield lines
    finally:
        lines.unpersist()


def sales_export(spark: SparkSession, sf_dir: str, system: str = "gofrugal", currency: str = "₹",
                 lines: DataFrame | None = None) -> DataFrame:
    """All-text export rows with the header names of ``system``.  ``currency`` is
    the sign put before digit-grouped prices (none for single-byte encodings
    that cannot write the rupee sign)."""
    j = _lines(spark, sf_dir) if lines is None else lines
    ok = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    d = F.when(ok % FUTURE_MOD == 0, F.date_add(d, 400)).otherwise(d)
    date_txt = (F.when(ok % NO_DATE_MOD == 0, F.lit(None).cast("string"))
                 .when(ok % BAD_DATE_MOD == 0, F.lit("not a date"))
                 .when(ok % DAY_FIRST_MOD == 0, F.date_format(d, "dd/MM/yyyy"))
                 .when(ok % TIMED_MOD == 0, F.concat(d.cast("string"), F.lit(" 10:30:00")))
                 .when((ok % MONTH_FIRST_MOD == 0) & (F.dayofmonth(d) > 12), F.date_format(d, "MM/dd/yyyy"))
                 .when(ok % NAMED_MOD == 0, F.date_format(d, "dd-MMM-yyyy"))
                 .otherwise(d.cast("string")))
    cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint")
    price = (cents * F.lit(Decimal("0.01"))).cast("decimal(18,2)")
    price_txt = (F.when(ok % BAD_PRICE_MOD == 0, F.lit("abc"))
                  .when(ok % RUPEE_MOD == 0, F.concat(F.lit(currency), F.format_number(price.cast("double"), 2)))
                  .otherwise(price.cast("string")))
    qty_txt = F.when(ok % ZERO_QTY_MOD == 0, F.lit("0")).otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    total = (F.col("l_quantity").cast("bigint") * cents * F.lit(Decimal("0.01"))).cast("decimal(18,2)")
    ck = F.col("c_custkey")
    name = (F.when(ck % NO_NAME_MOD == 0, F.lit(None).cast("string"))
             .when(ck % PADDED_MOD == 0, F.concat(F.lit("\t"), F.col("c_name"), F.lit("\u00a0")))
             .when(ck % ACCENT_MOD == 0, F.concat(F.col("c_name"), F.lit(" Café Müller")))
             .otherwise(F.col("c_name")))
    cost = F.when(F.col("p_size") == 50, F.lit(None).cast("string")) \
            .otherwise(F.col("p_retailprice").cast("decimal(18,2)").cast("string"))
    status = (F.when(F.col("o_orderstatus") == "F", F.lit("Paid"))
               .when(F.col("o_orderstatus") == "P", F.lit("Partial")).otherwise(F.lit("Unpaid")))
    due = F.date_add(d, 30).cast("string")
    fields = {
        "transaction_id": ok.cast("string"),
        "invoice_number": ok.cast("string"),
        "transaction_date": date_txt,
        "customer_id": F.concat(F.lit("C"), ck.cast("string")),
        "customer_name": name,
        "product_id": F.concat(F.lit("P"), F.col("p_partkey").cast("string")),
        "product_name": F.when(F.col("p_partkey") % QUOTED_MOD == 0,
                               F.concat(product_key(F.col("p_name"), F.col("p_partkey")), F.lit(' 2" steel, long')))
                         .otherwise(product_key(F.col("p_name"), F.col("p_partkey"))),
        "quantity": qty_txt,
        "unit_price": price_txt,
        "cost_price": cost,
        "total_amount": total.cast("string"),
        "tax_amount": F.round(total * F.lit(Decimal("0.18")), 2).cast("decimal(18,2)").cast("string"),
        "payment_status": status,
        "payment_due_date": due,
    }
    mapping = C.ERP_MAPPINGS[system]["sales_transactions"]
    cols, seen = [], set()
    for uni, src in mapping.items():
        if src in seen:
            continue
        seen.add(src)
        cols.append(fields[uni].alias(src))
    return j.select(*cols)


def written_once(spark: SparkSession, key: tuple, write) -> str:
    """Path of a file set written once per session and key; ``write(path)`` writes it."""
    full = session_key(spark, *key)
    if full not in _CACHE:
        path = shared_path(spark, "-".join(str(k) for k in ("export",) + key[:1]))
        with shuffles_dropped(spark):
            write(path)
        _CACHE[full] = path
    return _CACHE[full]


def export_path(spark: SparkSession, sf_dir: str, system: str = "gofrugal", encoding: str = "UTF-8", compression: str = "gzip",
                lines: DataFrame | None = None) -> str:
    """Write the export once per (session, tables, system, encoding, compression); reuse the path."""
    cur = "₹" if encoding.upper().replace("-", "") == "UTF8" else ""

    def write(path: str) -> None:
        files.write_csv(sales_export(spark, sf_dir, system, cur, lines), path, encoding=encoding, compression=compression,
                        level="BEST_SPEED" if lines is None else "DEFAULT_COMPRESSION")  # several exports: disk counts

    return written_once(spark, (f"{system}-{encoding.lower()}", sf_dir, compression), write)
