"""Registered queries over whole tables: the marts in display order, a hot
customer's invoice list in chunks, rows fetched per mart, wall-clock columns, the
existence test, and the entities brought to their declared schemas."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, IntegerType, TimestampType

from ledgerlens import schemas
from ledgerlens.config import DEFAULT
from ledgerlens.operators import alerts as A
from ledgerlens.operators import conform as CF
from ledgerlens.operators import mapping as MP
from ledgerlens.operators import marts as M
from ledgerlens.plans import catalog_ingest as I
from ledgerlens.plans import catalog_rules as R
from ledgerlens.plans import oracle as O
from ledgerlens.plans.jobs import shared_staging, staging_from_fixture
from ledgerlens.sources import exports, files, fixture, tables

P = DEFAULT
MARTS = {"dead_stock": M.dead_stock, "low_margin": M.low_margin, "credit_risk": M.credit_risk}
ENTITIES = {"sales_transactions": schemas.SALES, "inventory": schemas.INVENTORY, "customers": schemas.CUSTOMERS, "products": schemas.PRODUCTS}


def _stg(s, sf):
    return shared_staging(s, sf, P)


def _ordered(name):
    def query(s, sf):
        return M.displayed(MARTS[name](_stg(s, sf), P, False), name)
    query.__doc__ = f"The {name} mart with the rank it is shown at."
    return query


def overdue_invoice_chunks(s, sf):
    return M.overdue_invoice_chunks(_stg(s, sf), P, CHUNK)


CHUNK = 24  # characters: the lists of the test tables are short


def mart_fetch_counts(s, sf):
    stg = _stg(s, sf)
    return A.fetch_counts(A.all_alerts(A.credit_risk_alerts(M.credit_risk(stg, P, False), P, False),
                                       A.dead_stock_alerts(M.dead_stock(stg, P, False), P, False),
                                       A.low_margin_alerts(M.low_margin(stg, P, False), P, False)))


def wall_clock_columns(s, sf):
    """(model, column_name, model_rows, stamped): the columns that carry the time of the run are filled in every row."""
    stg = staging_from_fixture(s, sf, P, with_loaded_at=True)
    parts = [("stg_sales_transactions", "loaded_at", stg)]
    parts += [(f"mart_{n}", "created_at", build(_stg(s, sf), P, True)) for n, build in MARTS.items()]
    parts += [("alerts_dead_stock", "timestamp", A.dead_stock_alerts(M.dead_stock(_stg(s, sf), P, False), P, True)),
              ("alerts_low_margin", "timestamp", A.low_margin_alerts(M.low_margin(_stg(s, sf), P, False), P, True)),
              ("alerts_credit_risk", "timestamp", A.credit_risk_alerts(M.credit_risk(_stg(s, sf), P, False), P, True))]
    rows = [df.agg(F.count("*").alias("model_rows"), F.count_if(F.col(c).cast("timestamp").isNotNull()).alias("stamped")).select(
        F.lit(m).alias("model"), F.lit(c).alias("column_name"), "model_rows", "stamped") for m, c, df in parts]
    return R.T.union_all(rows)


def table_exists(s, sf):
    """A loaded table exists and holds its rows; one never loaded does not."""
    I.load_replace_append(s, sf, "ll_sales_there")
    there = s.table("ll_sales_there").agg(F.count("*").alias("table_rows"))
    return there.select(F.lit("ll_sales_there").alias("name"), F.lit(tables.table_exists(s, "ll_sales_there")).alias("found"), "table_rows").unionByName(
        there.select(F.lit("ll_never_loaded").alias("name"), F.lit(tables.table_exists(s, "ll_never_loaded")).alias("found"),
                     F.lit(0).cast("long").alias("table_rows")))


def _entity(s, sf, name):
    """Rows of an entity as text, as an export has them."""
    if name == "sales_transactions":
        df = files.read_csv(s, exports.export_path(s, sf))
        targets, _, _ = MP.plan_columns(files.data_columns(df), "gofrugal", collapse=False)
        return MP.apply_columns(df.drop(*files.BOOKKEEPING), targets)
    df = {"inventory": lambda: fixture.inventory_snapshot(s, sf, P), "customers": lambda: fixture.customer_master(s, sf),
          "products": lambda: fixture.product_master(s, sf)}[name]()
    return df.select(*(F.col(c).cast("string") for c in df.columns))


def _conformed(name):
    def query(s, sf):
        return CF.conformed(CF.checked(_entity(s, sf, name), ENTITIES[name]))
    query.__doc__ = f"The rows of {name} that fit the declared schema, typed."
    return query


def quarantine_sales(s, sf):
    """Sale lines that do not fit, with what is wrong with them."""
    bad = CF.quarantine(CF.checked(_entity(s, sf, "sales_transactions"), schemas.SALES))
    return bad.select("transaction_id", "product_id", "transaction_date", "unit_price", F.array_join("errors", "; ").alias("errors"))


QUERIES = {
    **{f"mart_{n}_ordered": _ordered(n) for n in MARTS},
    "overdue_invoice_chunks": overdue_invoice_chunks,
    "mart_fetch_counts": mart_fetch_counts,
    "wall_clock_columns": wall_clock_columns,
    "table_exists": table_exists,
    **{f"conform_{n}": _conformed(n) for n in ENTITIES},
    "quarantine_sales": quarantine_sales,
}

_RANK = "CASE alert_severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 3 ELSE 4 END"
_CTE = {"dead_stock": "dead", "low_margin": "lowm", "credit_risk": "credit"}


def _ordered_sql(name: str) -> str:
    metric, key = M.DISPLAY_METRICS[name]
    ties = ", ".join(f"{k} ASC NULLS FIRST" for k in key if k != metric)
    return O.with_(O.MARTS, f"SELECT *, row_number() OVER (ORDER BY {_RANK}, {metric} DESC NULLS LAST, {ties}) AS display_rank FROM {_CTE[name]}")


_TYPES = {DateType: "DATE", TimestampType: "TIMESTAMP", IntegerType: "INTEGER", BooleanType: "BOOLEAN", DecimalType: "DECIMAL(18,4)"}


def _conform_sql(name: str, cte: str, present: set[str]) -> str:
    cols = []
    for f in ENTITIES[name].fields:
        kind = _TYPES.get(type(f.dataType), "VARCHAR")
        cols.append(f"CAST({f.name if f.name in present else 'NULL'} AS {kind}) AS {f.name}")
    return O.with_(R.B, f"SELECT {', '.join(cols)} FROM {cte}")


def _sales_checked() -> list[tuple[str, str]]:
    """The export's text under the universal names, every field read as its type, and the errors."""
    m = I.GOFRUGAL
    value, errors = {}, []
    for f in schemas.SALES.fields:
        text = f'"{m[f.name]}"' if f.name in m else None
        if text is None:
            value[f.name] = f"CAST(NULL AS {_TYPES.get(type(f.dataType), 'VARCHAR')})"
        elif isinstance(f.dataType, DateType):
            value[f.name] = I._parse_date(text)
        elif isinstance(f.dataType, DecimalType):
            value[f.name] = f"TRY_CAST(trim(replace(replace({text}, '₹', ''), ',', ''), {I._WSCH}) AS DECIMAL(18,4))"
        else:
            value[f.name] = text
        if text and type(f.dataType) in _TYPES:
            errors.append(f"CASE WHEN {text} IS NOT NULL AND {value[f.name]} IS NULL THEN '{f.name}: not a {CF._NAMES[type(f.dataType)]}' END")
        if not f.nullable:
            errors.append(f"CASE WHEN {text or 'NULL'} IS NULL THEN '{f.name}: missing' END")
    cols = ", ".join(f"{v} AS {n}" for n, v in value.items())
    return [("export", I.export_sql()), ("checked", f"""SELECT {cols}, "{m['transaction_date']}" AS _date, "{m['unit_price']}" AS _price,
  list_filter([{', '.join(errors)}], lambda x: x IS NOT NULL) AS errors FROM export""")]


_FIELDS = ", ".join(f.name for f in schemas.SALES.fields)
_WALL = [("stg_sales_transactions", "loaded_at", "stg"), *((f"mart_{n}", "created_at", c) for n, c in _CTE.items()),
         ("alerts_dead_stock", "timestamp", "a_dead"), ("alerts_low_margin", "timestamp", "a_low"), ("alerts_credit_risk", "timestamp", "a_credit")]

ORACLE = {
    **{f"mart_{n}_ordered": _ordered_sql(n) for n in MARTS},
    "overdue_invoice_chunks": O.with_(O.BASE, f"""SELECT customer_id, chunk, string_agg(piece, ', ' ORDER BY before) AS ids FROM (
  SELECT customer_id, before, CAST(before // {CHUNK} AS BIGINT) AS chunk, rtrim(repeat(transaction_id || ', ', CAST(n AS INTEGER)), ', ') AS piece FROM (
    SELECT *, coalesce(sum(n * (length(transaction_id) + 2)) OVER (PARTITION BY customer_id ORDER BY transaction_date, transaction_id, cut
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (
      SELECT customer_id, transaction_date, transaction_id, cut, least(most, n_lines - cut * most) AS n FROM (
        SELECT *, unnest(range(0, (n_lines - 1) // most + 1)) AS cut FROM (
          SELECT customer_id, transaction_date, transaction_id, count(*) AS n_lines, greatest(1, {CHUNK} // (length(transaction_id) + 2)) AS most
          FROM stg WHERE payment_status <> 'PAID' AND days_overdue >= {P.credit_risk_days} AND transaction_id IS NOT NULL GROUP BY ALL)))))
GROUP BY customer_id, chunk"""),
    "mart_fetch_counts": O.with_(O.ALERTS, "SELECT t.alert_type, count(a.alert_type) AS rows_fetched FROM (VALUES "
                                 + ", ".join(f"('{t}')" for t in A.C.ALERT_TYPE_ORDER)
                                 + ") t(alert_type) LEFT JOIN alerts a ON a.alert_type = t.alert_type GROUP BY t.alert_type"),
    "wall_clock_columns": O.with_(O.ALERTS, " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{c}' AS column_name, count(*) AS model_rows, count(*) AS stamped FROM {t}" for m, c, t in _WALL)),
    "table_exists": O.with_(I._BASE + [("tagged", I._TAGGED)],
                            "SELECT 'll_sales_there' AS name, true AS found, 2 * count(*)::BIGINT AS table_rows FROM tagged WHERE dq_check IS NULL "
                            "UNION ALL SELECT 'll_never_loaded', false, 0"),
    "conform_sales_transactions": O.with_(_sales_checked(), f"SELECT {_FIELDS} FROM checked WHERE len(errors) = 0"),
    "conform_inventory": _conform_sql("inventory", "inv", {"product_id", "product_name", "snapshot_date", "quantity_on_hand", "reorder_level", "last_sale_date"}),
    "conform_customers": _conform_sql("customers", "cust", {"customer_id", "customer_name", "customer_type", "credit_limit", "territory"}),
    "conform_products": _conform_sql("products", "prod", {"product_id", "product_name", "product_category", "brand", "standard_cost"}),
    "quarantine_sales": O.with_(_sales_checked(), "SELECT transaction_id, product_id, _date AS transaction_date, _price AS unit_price, "
                                "array_to_string(errors, '; ') AS errors FROM checked WHERE len(errors) > 0"),
}
