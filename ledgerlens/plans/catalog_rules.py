"""Registered data tests (Q1-Q4) and declared rules (D1-D19, D21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.config import DEFAULT
from ledgerlens.functions.columns import days_between
from ledgerlens.operators import datatests as T
from ledgerlens.operators import mapping as MP
from ledgerlens.operators import marts as M
from ledgerlens.operators import rules as R
from ledgerlens.operators.metrics import SUM_MONEY
from ledgerlens.operators.staging import customer_name_of, product_name_of
from ledgerlens.plans import oracle as O
from ledgerlens.plans.catalog import _balanced, _stg
from ledgerlens.session import session_key, shared_path
from ledgerlens.sources import files, fixture, landing

P = DEFAULT
SALES_NOT_NULL = ("transaction_id", "transaction_date", "customer_name", "product_name",
                  "quantity", "unit_price", "total_amount")
STAGING_NOT_NULL = ("transaction_id", "transaction_date", "customer_name", "product_name", "quantity", "unit_price")
INVENTORY_NOT_NULL = ("product_id", "quantity_on_hand")


def _raw_typed(s, sf):
    return fixture.raw_sales(s, sf).withColumn("transaction_date", F.to_date("transaction_date", "yyyy-MM-dd"))


def test_not_null(s, sf):
    return T.union_all([
        T.not_null(fixture.raw_sales(s, sf), "sales_raw", SALES_NOT_NULL),
        T.not_null(_stg(s, sf), "stg_sales_transactions", STAGING_NOT_NULL),
        T.not_null(fixture.inventory_snapshot(s, sf, P), "inventory_raw", INVENTORY_NOT_NULL),
    ])


def test_unique(s, sf):
    return T.union_all([T.unique(fixture.raw_sales(s, sf), "sales_raw", ["transaction_id"]),
                        T.unique(_stg(s, sf), "stg_sales_transactions", ["transaction_id"])])


def dq_rules_sales(s, sf):
    return R.rule_counts(_raw_typed(s, sf), R.sales_rule_checks(P), "sales_transactions")


def dq_rules_applied(s, sf):
    """Sales rows after the declared rules: an error drops the row, warnings
    stay as a '; '-joined tag."""
    kept = R.apply_rules(_raw_typed(s, sf), R.sales_rule_checks(P))
    return kept.select("invoice_number", "product_name", "quantity", "unit_price", "cost_price", "total_amount",
                       F.array_join("failed_rules", "; ").alias("warnings"))


def dq_rules_inventory(s, sf):
    return R.rule_counts(fixture.inventory_snapshot(s, sf, P), R.inventory_rule_checks(), "inventory")


def allowed_values(s, sf):
    return T.union_all([
        T.allowed_values(fixture.raw_sales(s, sf), "sales_transactions", "payment_status",
                         C.ALLOWED_VALUES[("sales_transactions", "payment_status")]),
        T.allowed_values(fixture.customer_master(s, sf), "customers", "customer_type",
                         C.ALLOWED_VALUES[("customers", "customer_type")]),
        *(T.allowed_values(fixture.sales_attributes(s, sf), "sales_transactions", field, C.ALLOWED_VALUES[("sales_transactions", field)])
          for field in ("customer_type", "payment_mode")),
    ])


def _entities(s, sf):
    return {"sales_transactions": _stg(s, sf), "inventory": fixture.inventory_snapshot(s, sf, P),
            "customers": fixture.customer_master(s, sf), "products": fixture.product_master(s, sf)}


def primary_key_check(s, sf):
    return T.union_all([T.unique(df, name, list(C.PRIMARY_KEYS[name])) for name, df in _entities(s, sf).items()])


def required_fields(s, sf):
    return T.union_all([T.not_null(df, name, [f for f, req in C.ENTITY_FIELDS[name] if req])
                        for name, df in _entities(s, sf).items()])


def _product_days(s, sf):
    stg = _stg(s, sf)
    pdays = stg.groupBy("product_id").agg(F.max("transaction_date").alias("last_sale_date"),
                                          F.sum("quantity").cast(SUM_MONEY).alias("total_quantity_ever_sold"))
    pdays = pdays.withColumns({"product_name": product_name_of(F.col("product_id")),
                               "days_since_last_sale": days_between(F.lit(P.as_of), F.col("last_sale_date"))})
    snap = R.latest_snapshot(fixture.inventory_snapshot(s, sf, P)).select("product_id", "quantity_on_hand")
    return pdays.join(snap, "product_id", "left")


def _customer_overdue(s, sf):
    stg = _stg(s, sf)
    od = stg.where(R.rule_filter(R.rule("credit_risk")))
    return od.groupBy("customer_id").agg(
        F.max("days_overdue").alias("days_overdue"),
        F.sum("total_amount").cast(SUM_MONEY).alias("total_overdue_amount"),
        F.count_distinct("transaction_id").alias("invoices")
    ).withColumn("customer_name", customer_name_of(F.col("customer_id")))


def rule_alerts(s, sf):
    """Rows meeting each enabled rule's declared conditions."""
    stg = _stg(s, sf)
    frames = {"dead_stock": _product_days(s, sf), "low_margin": stg, "credit_risk": stg}
    out = []
    for r in C.ALERT_RULES:
        if not r.enabled:
            continue
        out.append(frames[r.name].agg(F.count_if(R.rule_filter(r)).alias("matches"))
                   .select(F.lit(r.name).alias("rule"), "matches"))
    return T.union_all(out)


def _ladders(s, sf):
    stg = _stg(s, sf)
    dead = R.rule("dead_stock")
    low = R.rule("low_margin")
    credit = R.rule("credit_risk")
    d = (_product_days(s, sf).where(R.rule_filter(dead))
         .select(F.lit("dead_stock").alias("rule"), F.col("product_id").alias("entity"),
                 R.severity_column(dead).alias("severity")))
    lm = (stg.where(R.rule_filter(low))
          .select(F.lit("low_margin").alias("rule"),
                  F.concat_ws("|", "transaction_id", "product_id").alias("entity"),
                  R.severity_column(low).alias("severity")))
    cr = (_customer_overdue(s, sf)
          .select(F.lit("credit_risk").alias("rule"), F.col("customer_id").alias("entity"),
                  R.severity_column(credit, "total_overdue_amount").alias("severity")))
    return d.unionByName(lm).unionByName(cr)


def rule_severity(s, sf):
    return _ladders(s, sf).groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("entities"))


def rule_frames(s, sf):
    """The rows that a rule file may judge, by name."""
    products = _product_days(s, sf).withColumn(
        "value", F.round(F.col("total_quantity_ever_sold") * F.lit(C.DEAD_VALUE_FACTOR) * F.lit(C.DEAD_VALUE_UNIT_PRICE), 0))
    return {"products": products, "lines": _stg(s, sf), "overdue_customers": _customer_overdue(s, sf),
            "inventory": fixture.inventory_snapshot(s, sf, P)}


def rule_messages(s, sf):
    """Every enabled rule of the rule file, compiled over the frames it names."""
    return R.compiled(C.ALERT_RULES, rule_frames(s, sf))


def dead_stock_on_hand(s, sf):
    return R.dead_stock_on_hand(M.dead_stock(_stg(s, sf), P, False), fixture.inventory_snapshot(s, sf, P))


def stock_out(s, sf):
    return R.stock_out(fixture.inventory_snapshot(s, sf, P)).select(
        "product_id", "quantity_on_hand", "reorder_level", "snapshot_date")


def threshold_variants(s, sf):
    stg = _stg(s, sf)
    pd_ = (stg.groupBy("product_id").agg(F.max("transaction_date").alias("last"))
              .withColumn("days_since_last_sale", days_between(F.lit(P.as_of), F.col("last"))))
    d = R.dead_stock_variant(pd_).select(F.lit("dead_stock").alias("rule"), F.col("product_id").alias("entity"),
                                         "severity")
    co = M.overdue_lines(stg, P).groupBy("customer_id").agg(
        F.max("days_overdue").alias("max_days_overdue"),
        F.sum("total_amount").cast(SUM_MONEY).alias("total_overdue_amount"))
    c = R.credit_variant(co).select(F.lit("credit_risk").alias("rule"), F.col("customer_id").alias("entity"),
                                    "severity")
    return d.unionByName(c)


def _sales_with_category(s, sf):
    prod = fixture.product_master(s, sf).select("product_id", "product_category")
    return _stg(s, sf).join(prod, "product_id", "left")


def margin_by_category(s, sf):
    b = R.margin_bands(_sales_with_category(s, sf), s)
    return b.groupBy("product_category", "margin_band").agg(F.count(F.lit(1)).alias("sale_lines"))


def industry_bands(s, sf):
    return R.industry_bands(_sales_with_category(s, sf), s)


def turnover_vs_target(s, sf):
    return R.turnover(_sales_with_category(s, sf), P)


def seasonal_expectation(s, sf):
    return R.seasonal_expectation(_stg(s, sf), s)


def credit_terms(s, sf):
    return R.credit_terms(_stg(s, sf), P)


def credit_score(s, sf):
    return R.credit_score(_stg(s, sf), P)


def digest_capped(s, sf):
    return R.digest_capped(_balanced(s, sf))


def indian_number_format(s, sf):
    return R.indian_amounts(M.credit_risk(_stg(s, sf), P, False))


def impute_cost(s, sf):
    out = R.impute_cost(_stg(s, sf))
    return out.where("cost_imputed").select("transaction_id", "product_id", "unit_price", "cost_price",
                                            "unit_margin", "margin_percentage")


_INV_CACHE: dict = {}


def inventory_mapping(s, sf):
    """Inventory exports in two layouts, written from the snapshot, read back,
    detected (inventory mappings) and renamed to the universal names."""
    key = session_key(s, sf)
    if key not in _INV_CACHE:
        inv = fixture.inventory_snapshot(s, sf, P)
        paths = {}
        layouts = {
            "gofrugal": inv.select(F.concat(F.lit("P"), F.regexp_extract("product_id", r"#(\d+)$", 1)).alias("ItemCode"),
                                   F.col("product_name").alias("ItemName"),
                                   F.col("quantity_on_hand").cast("bigint").cast("string").alias("StockQty"),
                                   F.col("last_sale_date").cast("string").alias("LastSaleDate")),
            "tally": inv.select(F.col("product_name").alias("StockItemName"),
                                F.col("quantity_on_hand").cast("bigint").cast("string").alias("ClosingBalance")),
        }
        for name, df in layouts.items():
            paths[name] = files.write_csv(df, shared_path(s, f"inventory-{name}"))
        _INV_CACHE[key] = paths
    paths = list(_INV_CACHE[key].values())
    together = f"{paths[0].rsplit('/', 1)[0]}/{{{','.join(p.rsplit('/', 1)[1] for p in paths)}}}"
    listed = landing.manifest(s, together, shared_path(s, "inventory-manifest"), entity="inventory")
    out = []
    for system, df in landing.layouts(s, together, listed):
        targets, _, _ = MP.plan_columns(files.data_columns(df), system, entity="inventory")
        mapped = MP.apply_columns(df, targets)
        out.append(mapped.select(F.lit(system).alias("system"), "product_name",
                                 F.col("quantity_on_hand").try_cast("double").alias("quantity_on_hand")))
    return T.union_all(out)


def overdue_invoices(s, sf):
    return M.overdue_invoices(_stg(s, sf), P)


def slow_moving_products(s, sf):
    """Products not sold for the slow-moving level of the benchmarks."""
    days = _stg(s, sf).groupBy("product_id").agg(F.max("transaction_date").alias("last_sale_date"))
    days = days.withColumn("days_since_last_sale", days_between(F.lit(P.as_of), F.col("last_sale_date")))
    return days.where(F.col("days_since_last_sale") >= C.SLOW_MOVING_DAYS)


QUERIES = {
    "overdue_invoices": overdue_invoices,
    "slow_moving_products": slow_moving_products,
    "test_not_null": test_not_null,
    "test_unique": test_unique,
    "dq_rules_sales": dq_rules_sales,
    "dq_rules_inventory": dq_rules_inventory,
    "dq_rules_applied": dq_rules_applied,
    "allowed_values": allowed_values,
    "primary_key_check": primary_key_check,
    "required_fields": required_fields,
    "rule_alerts": rule_alerts,
    "rule_severity": rule_severity,
    "rule_messages": rule_messages,
    "dead_stock_on_hand": dead_stock_on_hand,
    "stock_out": stock_out,
    "threshold_variants": threshold_variants,
    "margin_by_category": margin_by_category,
    "industry_bands": industry_bands,
    "turnover_vs_target": turnover_vs_target,
    "seasonal_expectation": seasonal_expectation,
    "credit_terms": credit_terms,
    "credit_score": credit_score,
    "digest_capped": digest_capped,
    "indian_number_format": indian_number_format,
    "impute_cost": impute_cost,
    "inventory_mapping": inventory_mapping,
}

# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

AS_OF = O.AS_OF
INV = f"""SELECT p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_id,
  p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name,
  {AS_OF} AS snapshot_date, CAST(CASE WHEN p_partkey % 97 = 0 THEN -3 ELSE p_partkey % 40 END AS DECIMAL(18,4)) AS quantity_on_hand,
  CAST(10 AS DECIMAL(18,4)) AS reorder_level,
  CAST({AS_OF} - CAST(p_partkey % 365 - 3 AS INTEGER) AS DATE) AS last_sale_date,
  CASE p_partkey % 6 WHEN 0 THEN 'Monoblock Pump' WHEN 1 THEN 'Submersible Pump' WHEN 2 THEN 'Motor' WHEN 3 THEN 'Accessories' ELSE split_part(p_type, ' ', 1) END AS product_category
FROM part"""
PROD = """SELECT p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_id,
  p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name, CASE p_partkey % 6 WHEN 0 THEN 'Monoblock Pump' WHEN 1 THEN 'Submersible Pump' WHEN 2 THEN 'Motor' WHEN 3 THEN 'Accessories' ELSE split_part(p_type, ' ', 1) END AS product_category,
  p_brand AS brand, CAST(p_retailprice AS DECIMAL(18,4)) AS standard_cost FROM part"""
CUST = """SELECT c_name AS customer_id, c_name AS customer_name, c_mktsegment AS customer_type,
  CAST(CAST(FLOOR(c_acctbal * 100) AS BIGINT) * 0.01 AS DECIMAL(18,4)) AS credit_limit, n_name AS territory
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""
RAWT = "SELECT * REPLACE (CAST(strptime(transaction_date, '%Y-%m-%d') AS DATE) AS transaction_date) FROM raw"
B = O.BASE + [("inv", INV), ("prod", PROD), ("cust", CUST)]


def _nn(table: str, model: str, cols, present) -> str:
    parts = []
    for c in cols:
        if c in present:
            parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, "
                         f"CAST(count_if({c} IS NULL) AS BIGINT) AS failures FROM {table}")
        else:
            parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, "
                         "CAST(NULL AS BIGINT) AS failures")
    return " UNION ALL ".join(parts)


RAW_COLS = {"invoice_number", "transaction_id", "transaction_date", "customer_name", "product_name", "quantity", "unit_price",
            "cost_price", "total_amount", "payment_status", "payment_due_date"}
STG_COLS = {"transaction_id", "transaction_date", "customer_id", "customer_name", "product_id", "product_name",
            "quantity", "unit_price", "cost_price", "total_amount"}
INV_COLS = {"product_id", "product_name", "snapshot_date", "quantity_on_hand", "reorder_level", "last_sale_date"}
CUST_COLS = {"customer_id", "customer_name", "customer_type", "credit_limit", "territory"}
PROD_COLS = {"product_id", "product_name", "product_category", "brand", "standard_cost"}


def _uniq(table: str, model: str, keys, present) -> str:
    name = ",".join(keys)
    if not all(k in present for k in keys):
        return f"SELECT '{model}' AS model, '{name}' AS key, CAST(NULL AS BIGINT) AS duplicated_values, CAST(NULL AS BIGINT) AS duplicated_rows"
    where = f"WHERE {keys[0]} IS NOT NULL" if len(keys) == 1 else ""
    return (f"SELECT '{model}' AS model, '{name}' AS key, CAST(count(*) AS BIGINT) AS duplicated_values, "
            f"CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicated_rows FROM (SELECT count(*) AS n FROM {table} {where} "
            f"GROUP BY {name} HAVING count(*) > 1) t")


_SALES_RULES = [
    ("quantity must be greater than 0", "error", "NOT coalesce(quantity > 0, false)"),
    ("unit_price must be greater than 0", "error", "NOT coalesce(unit_price > 0, false)"),
    ("total_amount should equal quantity × unit_price", "warning",
     "coalesce(abs(total_amount - quantity * unit_price) > 0.01, false)"),
    ("cost_price should be less than unit_price", "warning",
     "cost_price IS NOT NULL AND unit_price IS NOT NULL AND cost_price >= unit_price"),
    ("transaction_date should not be in future", "error", f"coalesce(transaction_date > {AS_OF}, false)"),
]
_INV_RULES = [
    ("quantity_on_hand must be >= 0", "error", "NOT coalesce(quantity_on_hand >= 0, false)"),
    ("last_sale_date should not be after snapshot_date", "error", "coalesce(last_sale_date > snapshot_date, false)"),
]


def _rules_sql(entity: str, table: str, rules) -> str:
    return " UNION ALL ".join(f"SELECT '{entity}' AS entity, '{n}' AS rule, '{s}' AS severity, "
                              f"CAST(count_if({c}) AS BIGINT) AS failures FROM {table}" for n, s, c in rules)


_WS = O._sql_str(C.UNICODE_WHITESPACE)


_SALES_ATTRIBUTES = """(SELECT CASE WHEN c_custkey % 3 = 0 THEN 'Wholesaler' ELSE c_mktsegment END AS customer_type,
  CASE l_returnflag WHEN 'A' THEN 'Cash' WHEN 'N' THEN ' upi ' ELSE 'Barter' END AS payment_mode
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey) sa"""


def _allowed(table: str, entity: str, field: str, allowed) -> str:
    vals = ", ".join(f"'{a.lower()}'" for a in allowed)
    return (f"SELECT '{entity}' AS entity, '{field}' AS field, CAST({field} AS VARCHAR) AS value, count(*) AS rows "
            f"FROM {table} WHERE {field} IS NOT NULL AND lower(trim(CAST({field} AS VARCHAR), {_WS})) NOT IN ({vals}) "
            f"GROUP BY {field}")


PDAYS = f"""SELECT pd.*, inv.quantity_on_hand FROM (
  SELECT product_id, max(product_name) AS product_name, max(transaction_date) AS last_sale_date,
    CAST(sum(quantity) AS DECIMAL(38,4)) AS total_quantity_ever_sold,
    CAST(date_diff('day', max(transaction_date), {AS_OF}) AS BIGINT) AS days_since_last_sale
  FROM stg GROUP BY product_id) pd LEFT JOIN inv ON pd.product_id = inv.product_id"""
_CREDIT_COND = f"upper(trim(payment_status, {_WS})) <> 'PAID' AND coalesce(days_overdue >= 15, false)"
CODUE = f"""SELECT customer_id, max(customer_name) AS customer_name, max(days_overdue) AS days_overdue,
  CAST(sum(total_amount) AS DECIMAL(38,4)) AS total_overdue_amount, count(DISTINCT transaction_id) AS invoices
FROM stg WHERE {_CREDIT_COND} GROUP BY customer_id"""
_DEAD_COND = "coalesce(days_since_last_sale >= 90, false) AND coalesce(quantity_on_hand > 0, false)"
_LOW_COND = "coalesce(margin_percentage < 0.10, false) AND cost_price IS NOT NULL"
_DEAD_SEV = ("CASE WHEN days_since_last_sale >= 180 THEN 'CRITICAL' WHEN days_since_last_sale >= 120 THEN 'HIGH' "
             "WHEN days_since_last_sale >= 90 THEN 'MEDIUM' END")
_LOW_SEV = ("CASE WHEN margin_percentage < 0.00 THEN 'CRITICAL' WHEN margin_percentage < 0.05 THEN 'HIGH' "
            "WHEN margin_percentage < 0.10 THEN 'MEDIUM' END")
_CRED_SEV = ("CASE WHEN days_overdue >= 90 AND total_overdue_amount >= 100000 THEN 'CRITICAL' "
             "WHEN days_overdue >= 60 THEN 'HIGH' WHEN days_overdue >= 30 THEN 'MEDIUM' "
             "WHEN days_overdue >= 15 THEN 'LOW' END")
LADDERS = f"""SELECT 'dead_stock' AS rule, product_id AS entity, {_DEAD_SEV} AS severity FROM pdays WHERE {_DEAD_COND}
UNION ALL SELECT 'low_margin', concat_ws('|', transaction_id, product_id), {_LOW_SEV} FROM stg WHERE {_LOW_COND}
UNION ALL SELECT 'credit_risk', customer_id, {_CRED_SEV} FROM codue"""


def indian_sql(x: str) -> str:
    """Whole-number text with Indian digit groups (no look-ahead in RE2:
    group the reversed digits instead)."""
    r = f"CAST(CAST(round(CAST({x} AS DECIMAL(38,4)), 0) AS DECIMAL(38,0)) AS HUGEINT)"
    rev = f"reverse(CAST(abs({r}) AS VARCHAR))"
    tail = f"rtrim(regexp_replace(substr({rev}, 4), '(\\d\\d)', '\\1,', 'g'), ',')"
    body = f"reverse(CASE WHEN length({rev}) > 3 THEN substr({rev}, 1, 3) || ',' || {tail} ELSE {rev} END)"
    return f"(CASE WHEN {r} < 0 THEN '-' ELSE '' END || {body})"


_BAND = """CASE WHEN margin_percentage >= coalesce(target_margin, 0.15) THEN 'healthy'
  WHEN margin_percentage >= coalesce(min_margin, 0.10) THEN 'acceptable'
  WHEN margin_percentage >= 0.05 THEN 'below_minimum' ELSE 'critical' END"""
_CATS = ", ".join(f"('{k}', CAST({v[0]} AS DECIMAL(4,2)), CAST({v[1]} AS DECIMAL(4,2)))"
                  for k, v in C.CATEGORY_MARGINS.items())
_SEASONS = ", ".join(f"({m}, '{n}', CAST({mult} AS DECIMAL(3,1)))" for n, ms, mult in C.SEASONS for m in ms)
_TURN_CASE = ("CASE " + " ".join(f"WHEN product_category = '{k}' THEN {v}" for k, v in C.CATEGORY_TURNOVER_DAYS.items())
              + f" ELSE {C.TURNOVER_TARGET_DAYS['general_distributor']} END")
W = C.CREDIT_SCORE_WEIGHTS
_TENURE = f"CAST(date_diff('day', first_purchase, {AS_OF}) AS DOUBLE)"
_PH = "CAST(paid_lines AS DOUBLE) / CAST(lines AS DOUBLE)"
_OA = ("1.0 - least(1.0, coalesce(CASE WHEN lifetime_value > 0 THEN CAST(overdue_amount AS DOUBLE) / "
       "CAST(lifetime_value AS DOUBLE) END, 1.0))")
_PF = f"least(1.0, CAST(purchase_days AS DOUBLE) / greatest(1.0, {_TENURE} / 30.0))"
_CT = f"least(1.0, {_TENURE} / 365.0)"
_SCORE = (f"((((CAST({float(W['payment_history'])} AS DOUBLE) * ({_PH}) + CAST({float(W['overdue_amount'])} AS DOUBLE) * ({_OA}))"
          f" + CAST({float(W['payment_frequency'])} AS DOUBLE) * ({_PF})) + CAST({float(W['customer_tenure'])} AS DOUBLE) * ({_CT})) * 100.0)")
_IMPUTED = "coalesce(cost_price, CAST(unit_price * 0.8 AS DECIMAL(18,4)))"
_IMP_MARGIN = f"CAST(unit_price - {_IMPUTED} AS DECIMAL(19,4))"

ORACLE = {
    "test_not_null": O.with_(B, " UNION ALL ".join([
        _nn("raw", "sales_raw", SALES_NOT_NULL, RAW_COLS),
        _nn("stg", "stg_sales_transactions", STAGING_NOT_NULL, STG_COLS),
        _nn("inv", "inventory_raw", INVENTORY_NOT_NULL, INV_COLS)])),
    "test_unique": O.with_(B, _uniq("raw", "sales_raw", ["transaction_id"], RAW_COLS) + " UNION ALL "
                           + _uniq("stg", "stg_sales_transactions", ["transaction_id"], STG_COLS)),
    "dq_rules_sales": O.with_(B + [("rawt", RAWT)], _rules_sql("sales_transactions", "rawt", _SALES_RULES)),
    "dq_rules_inventory": O.with_(B, _rules_sql("inventory", "inv", _INV_RULES)),
    "allowed_values": O.with_(B, _allowed("raw", "sales_transactions", "payment_status",
                                          C.ALLOWED_VALUES[("sales_transactions", "payment_status")])
                              + " UNION ALL " + _allowed("cust", "customers", "customer_type",
                                                         C.ALLOWED_VALUES[("customers", "customer_type")])
                              + "".join(" UNION ALL " + _allowed(_SALES_ATTRIBUTES, "sales_transactions", field, C.ALLOWED_VALUES[("sales_transactions", field)])
                                        for field in ("customer_type", "payment_mode"))),
    "primary_key_check": O.with_(B, " UNION ALL ".join([
        _uniq("stg", "sales_transactions", ["transaction_id"], STG_COLS),
        _uniq("inv", "inventory", ["product_id", "snapshot_date"], INV_COLS),
        _uniq("cust", "customers", ["customer_id"], CUST_COLS),
        _uniq("prod", "products", ["product_id"], PROD_COLS)])),
    "required_fields": O.with_(B, " UNION ALL ".join([
        _nn("stg", "sales_transactions", [f for f, r in C.ENTITY_FIELDS["sales_transactions"] if r], STG_COLS),
        _nn("inv", "inventory", [f for f, r in C.ENTITY_FIELDS["inventory"] if r], INV_COLS),
        _nn("cust", "customers", [f for f, r in C.ENTITY_FIELDS["customers"] if r], CUST_COLS),
        _nn("prod", "products", [f for f, r in C.ENTITY_FIELDS["products"] if r], PROD_COLS)])),
    "rule_alerts": O.with_(B + [("pdays", PDAYS)],
                           f"SELECT 'dead_stock' AS rule, count_if({_DEAD_COND}) AS matches FROM pdays "
                           f"UNION ALL SELECT 'low_margin', count_if({_LOW_COND}) FROM stg "
                           f"UNION ALL SELECT 'credit_risk', count_if({_CREDIT_COND}) FROM stg"),
    "rule_severity": O.with_(B + [("pdays", PDAYS), ("codue", CODUE), ("lad", LADDERS)],
                             "SELECT rule, severity, count(*) AS entities FROM lad GROUP BY rule, severity"),
    "dead_stock_on_hand": O.with_(B + [("dead", O.DEAD_STOCK)],
                                  "SELECT dead.*, inv.quantity_on_hand, inv.snapshot_date FROM dead JOIN inv "
                                  "ON dead.product_id = inv.product_id WHERE coalesce(inv.quantity_on_hand > 0, false)"),
    "stock_out": O.with_(B, "SELECT product_id, quantity_on_hand, reorder_level, snapshot_date FROM inv "
                            "WHERE coalesce(quantity_on_hand <= reorder_level, false)"),
    "threshold_variants": O.with_(B, f"""SELECT 'dead_stock' AS rule, product_id AS entity,
  CASE WHEN d >= 180 THEN 'CRITICAL' WHEN d >= 120 THEN 'HIGH' WHEN d >= 90 THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM (SELECT product_id, date_diff('day', max(transaction_date), {AS_OF}) AS d FROM stg GROUP BY product_id) t WHERE d >= 60
UNION ALL
SELECT 'credit_risk', customer_id,
  CASE WHEN m >= 90 OR a >= 100000 THEN 'CRITICAL' WHEN m >= 60 OR a >= 50000 THEN 'HIGH'
       WHEN m >= 30 THEN 'MEDIUM' ELSE 'LOW' END
FROM (SELECT customer_id, max(days_overdue) AS m, CAST(sum(total_amount) AS DECIMAL(38,4)) AS a FROM stg
      WHERE payment_status <> 'PAID' AND days_overdue >= {P.credit_risk_days} GROUP BY customer_id) u"""),
    "margin_by_category": O.with_(B + [("cats", f"SELECT * FROM (VALUES {_CATS}) t(product_category, target_margin, min_margin)")],
                                  f"""SELECT product_category, margin_band, count(*) AS sale_lines FROM (
  SELECT p.product_category, {_BAND} AS margin_band FROM stg s LEFT JOIN prod p ON s.product_id = p.product_id
  LEFT JOIN cats c ON p.product_category = c.product_category) t GROUP BY product_category, margin_band"""),
    "industry_bands": O.with_(B + [("cats", f"SELECT * FROM (VALUES {_CATS}) t(product_category, target_margin, min_margin)")],
                              f"""SELECT industry, product_category, margin_band, count(*) AS sale_lines FROM (
  SELECT p.product_category, {_BAND} AS margin_band FROM stg s LEFT JOIN prod p ON s.product_id = p.product_id
  LEFT JOIN cats c ON p.product_category = c.product_category) t
  CROSS JOIN (VALUES ('pump_distributor'), ('general_distributor')) i(industry) GROUP BY ALL"""),
    "turnover_vs_target": O.with_(B, f"""SELECT product_id, product_category, sale_lines,
  CASE WHEN sale_lines > 1 THEN span / (sale_lines - 1) END AS avg_days_between_sales,
  {_TURN_CASE} AS target_days,
  CASE WHEN sale_lines > 1 THEN span / (sale_lines - 1) END > {_TURN_CASE} AS slower_than_target
FROM (SELECT s.product_id, max(p.product_category) AS product_category, count(*) AS sale_lines,
        CAST(date_diff('day', min(transaction_date), max(transaction_date)) AS BIGINT) AS span
      FROM stg s LEFT JOIN prod p ON s.product_id = p.product_id GROUP BY s.product_id) t"""),
    "seasonal_expectation": O.with_(B + [("seasons", f"SELECT * FROM (VALUES {_SEASONS}) t(transaction_month, season, multiplier)")],
                                    f"""SELECT transaction_year, m.transaction_month, season, multiplier,
  CAST(actual_quantity AS DECIMAL(38,4)) AS actual_quantity,
  CAST(mean_q * multiplier AS DECIMAL(38,5)) AS expected_quantity
FROM (SELECT transaction_year, transaction_month, CAST(sum(quantity) AS DECIMAL(28,4)) AS actual_quantity
      FROM stg GROUP BY transaction_year, transaction_month) m
LEFT JOIN seasons s ON m.transaction_month = s.transaction_month,
(SELECT CAST(CAST({O.round_div(O.scaled_int('sum(q)', 4), 'count(*)')} AS DECIMAL(38,0)) * CAST('0.0001' AS DECIMAL(5,4))
        AS DECIMAL(38,4)) AS mean_q FROM
   (SELECT CAST(sum(quantity) AS DECIMAL(28,4)) AS q FROM stg GROUP BY transaction_year, transaction_month) x) g"""),
    "credit_terms": O.with_(B, f"""SELECT transaction_id, product_id, customer_id,
  coalesce(payment_due_date, CAST(transaction_date + INTERVAL 30 DAY AS DATE)) AS effective_due_date,
  CASE WHEN payment_status <> 'PAID' THEN CAST(date_diff('day', coalesce(payment_due_date, CAST(transaction_date + INTERVAL 30 DAY AS DATE)), {AS_OF}) AS BIGINT) END AS days_past_due,
  payment_status <> 'PAID' AND date_diff('day', coalesce(payment_due_date, CAST(transaction_date + INTERVAL 30 DAY AS DATE)), {AS_OF}) > 15 AS overdue,
  payment_status <> 'PAID' AND date_diff('day', coalesce(payment_due_date, CAST(transaction_date + INTERVAL 30 DAY AS DATE)), {AS_OF}) > 60 AS critical,
  payment_status <> 'PAID' AND date_diff('day', transaction_date, {AS_OF}) > 45 AS beyond_max_period
FROM stg"""),
    "credit_score": O.with_(B, f"""SELECT customer_id, {_PH} AS payment_history, {_OA} AS overdue_amount_score,
  {_PF} AS payment_frequency, {_CT} AS customer_tenure, {_SCORE} AS credit_score
FROM (SELECT customer_id, count(*) AS lines, count_if(payment_status = 'PAID') AS paid_lines,
        sum(CASE WHEN payment_status <> 'PAID' AND days_overdue > 0 THEN total_amount ELSE 0 END) AS overdue_amount,
        sum(total_amount) AS lifetime_value, count(DISTINCT transaction_date) AS purchase_days,
        min(transaction_date) AS first_purchase FROM stg GROUP BY customer_id) t"""),
    "digest_capped": O.with_(O.ALERTS, f"""SELECT *, CAST(row_number() OVER (ORDER BY {O._SEV_RANK}, metric_value DESC,
  CASE alert_type {' '.join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(C.ALERT_TYPE_ORDER))} ELSE 3 END, type_rank) AS INTEGER) AS message_rank
FROM balanced WHERE type_rank <= {C.DIGEST_MAX_PER_GROUP} QUALIFY message_rank <= {C.DIGEST_MAX_PER_MESSAGE}"""),
    "indian_number_format": O.with_(O.MARTS, f"""SELECT customer_id, total_overdue_amount,
  '{C.RUPEE}' || {indian_sql('total_overdue_amount')} AS amount_text,
  strftime(oldest_unpaid_date, '%d %b %Y') AS oldest_unpaid_text FROM credit"""),
    "impute_cost": O.with_(B, f"""SELECT transaction_id, product_id, unit_price, {_IMPUTED} AS cost_price,
  {_IMP_MARGIN} AS unit_margin,
  CASE WHEN unit_price > 0 THEN {O.div9(_IMP_MARGIN, 'unit_price')} ELSE CAST(0 AS DECIMAL(28,9)) END AS margin_percentage
FROM stg WHERE cost_price IS NULL"""),
}


def _template_sql(template: str, values: dict[str, str]) -> str:
    import string as _s
    parts = []
    for lit, field, _, _ in _s.Formatter().parse(template):
        if lit:
            parts.append(O._sql_str(lit))
        if field is not None:
            parts.append(f"coalesce(CAST({values[field]} AS VARCHAR), '')")
    return " || ".join(parts)


def _messages_sql(r: C.Rule, values: dict[str, str], sev_sql: str) -> tuple[str, str]:
    msg = "CASE " + " ".join(f"WHEN {sev_sql} = '{lv.name.upper()}' THEN {_template_sql(lv.message, values)}"
                             for lv in r.levels) + " END"
    act = "CASE " + " ".join(f"WHEN {sev_sql} = '{lv.name.upper()}' THEN {O._sql_str(lv.action)}"
                             for lv in r.levels) + " END"
    return msg, act


_DEAD_VALUES = {"product_name": f"trim(product_id, {_WS})", "days": "days_since_last_sale",
                "qty": "CAST(quantity_on_hand AS BIGINT)",
                "value": indian_sql("round(total_quantity_ever_sold * 0.1 * 4000, 0)")}
_LOW_VALUES = {"customer_name": "customer_name", "product_name": "product_name",
               "margin": "replace(format('{:,.1f}', CAST(margin_percentage * 100 AS DOUBLE)), ',', '')"}
_CRED_VALUES = {"customer_name": f"trim(upper(customer_id), {_WS})", "amount": indian_sql("total_overdue_amount"),
                "invoices": "invoices", "days": "days_overdue"}
_dm, _da = _messages_sql(R.rule("dead_stock"), _DEAD_VALUES, "sev")
_lm, _la = _messages_sql(R.rule("low_margin"), _LOW_VALUES, "sev")
_cm, _ca = _messages_sql(R.rule("credit_risk"), _CRED_VALUES, "sev")
ORACLE["rule_messages"] = O.with_(B + [("pdays", PDAYS), ("codue", CODUE)], f"""
SELECT 'dead_stock' AS rule, product_id AS entity, sev AS severity, {_dm} AS message, {_da} AS action
FROM (SELECT *, {_DEAD_SEV} AS sev FROM pdays WHERE {_DEAD_COND}) d WHERE sev IS NOT NULL
UNION ALL
SELECT 'low_margin', concat_ws('|', transaction_id, product_id), sev, {_lm}, {_la}
FROM (SELECT *, {_LOW_SEV} AS sev FROM stg WHERE {_LOW_COND}) l WHERE sev IS NOT NULL
UNION ALL
SELECT 'credit_risk', customer_id, sev, {_cm}, {_ca}
FROM (SELECT *, {_CRED_SEV} AS sev FROM codue) c WHERE sev IS NOT NULL""")

_WARN_LIST = ", ".join(f"CASE WHEN {c} THEN {O._sql_str(n)} END" for n, sev, c in _SALES_RULES)
_ERRORS = " OR ".join(f"({c})" for n, sev, c in _SALES_RULES if sev == "error")
ORACLE["dq_rules_applied"] = O.with_(B + [("rawt", RAWT)], f"""SELECT invoice_number, product_name, quantity, unit_price,
  cost_price, total_amount, array_to_string(list_filter([{_WARN_LIST}], lambda x: x IS NOT NULL), '; ') AS warnings
FROM rawt WHERE NOT ({_ERRORS})""")

ORACLE["inventory_mapping"] = f"""SELECT 'gofrugal' AS system, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name,
  CAST(CASE WHEN p_partkey % 97 = 0 THEN -3 ELSE p_partkey % 40 END AS DOUBLE) AS quantity_on_hand FROM part
UNION ALL
SELECT 'tally', p_name || ' #' || CAST(p_partkey AS VARCHAR), CAST(CASE WHEN p_partkey % 97 = 0 THEN -3 ELSE p_partkey % 40 END AS DOUBLE) FROM part"""

ORACLE["overdue_invoices"] = O.with_(O.BASE, f"""SELECT customer_id, transaction_date, transaction_id, count(*) AS n_lines,
  CAST(sum(total_amount) AS DECIMAL(38,4)) AS amount, max(days_overdue) AS max_days,
  CAST(sum(days_overdue) AS BIGINT) AS sum_days, count(days_overdue) AS n_days
FROM stg WHERE payment_status <> 'PAID' AND days_overdue >= {P.credit_risk_days} GROUP BY ALL""")
ORACLE["slow_moving_products"] = O.with_(O.BASE, f"""SELECT * FROM (SELECT product_id, max(transaction_date) AS last_sale_date,
  CAST(date_diff('day', max(transaction_date), {AS_OF}) AS BIGINT) AS days_since_last_sale FROM stg GROUP BY product_id)
WHERE days_since_last_sale >= {C.SLOW_MOVING_DAYS}""")
