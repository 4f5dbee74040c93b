"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

DuckDB turns decimal division and ``avg`` of decimals into DOUBLE, so exact
ratios and means are written here with HUGEINT integer arithmetic, rounded
half away from zero at 9 digits -- the same value Spark's decimal division
gives.  Every query is composed from the CTEs below.
"""

from __future__ import annotations

from ledgerlens import config as C
from ledgerlens.config import DEFAULT

P = DEFAULT
AS_OF = f"DATE '{P.as_of.isoformat()}'"
WS = C.UNICODE_WHITESPACE


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def scaled_int(x: str, scale: int) -> str:
    return f"CAST(CAST({x} AS DECIMAL(28,{scale})) * {10 ** scale} AS HUGEINT)"


def round_div(a_int: str, b_int: str, mult: int = 1) -> str:
    """round_half_away(a * mult / b) on integers."""
    return (f"(sign({a_int}) * sign({b_int}) * ((abs({a_int}) * {2 * mult} + abs({b_int})) "
            f"// (2 * abs({b_int}))))")


def as_dec9(int_expr: str) -> str:
    return f"CAST(CAST({int_expr} AS DECIMAL(38,0)) * CAST('0.000000001' AS DECIMAL(10,9)) AS DECIMAL(28,9))"


def div9(a: str, b: str) -> str:
    """a / b rounded half away from zero to 9 digits, inputs of scale <= 9."""
    return as_dec9(round_div(scaled_int(a, 9), scaled_int(b, 9), 10 ** 9))


def avg9(x: str) -> str:
    """Exact mean of a DECIMAL(28,9) column, 9 digits."""
    return f"CASE WHEN count({x}) > 0 THEN {as_dec9(round_div(scaled_int(f'sum({x})', 9), f'count({x})'))} END"


def with_(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{q}\n)" for n, q in ctes) + "\n" + body


# -- raw sales over the test tables (the fixture text; runs in both engines) --
_RAW_DATE = "(CASE WHEN o_orderkey % 307 = 0 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 400 DAY AS DATE) ELSE CAST(o_orderdate AS DATE) END)"
RAW = f"""SELECT CAST(o_orderkey AS STRING) AS invoice_number,
  CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_orderkey AS STRING) END AS transaction_id,
  CASE WHEN o_orderkey % 1009 <> 0 THEN CAST({_RAW_DATE} AS STRING) END AS transaction_date,
  c_name AS customer_name,
  concat(p_name, ' #', CAST(p_partkey AS STRING)) AS product_name,
  CASE WHEN o_orderkey % 499 = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE CAST(l_quantity AS DECIMAL(18,4)) END AS quantity,
  CASE WHEN o_orderkey % 701 = 0 THEN CAST(0 AS DECIMAL(18,4))
       ELSE CAST(CAST(FLOOR(l_extendedprice * 100 / l_quantity) AS BIGINT) * 0.01 AS DECIMAL(18,4)) END AS unit_price,
  CASE WHEN p_size = 50 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(18,4)) END AS cost_price,
  CASE WHEN o_orderkey % 601 = 0 THEN CAST(0 AS DECIMAL(18,4))
       WHEN o_orderkey % 53 = 0 THEN CAST(l_extendedprice AS DECIMAL(18,4))
       ELSE CAST(CAST(l_quantity AS BIGINT) * CAST(FLOOR(l_extendedprice * 100 / l_quantity) AS BIGINT) * 0.01 AS DECIMAL(18,4)) END AS total_amount,
  CASE WHEN o_orderstatus = 'F' THEN 'Paid'
       WHEN {_RAW_DATE} < DATE '2001-03-20' AND o_orderkey % 97 <> 0 THEN ' paid '
       WHEN o_orderstatus = 'P' THEN 'Partial'
       ELSE NULL END AS payment_status,
  CASE WHEN o_orderkey % 101 = 0 THEN 'not a date'
       ELSE CAST(CAST({_RAW_DATE} + INTERVAL 30 DAY AS DATE) AS STRING) END AS payment_due_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey"""

_WS = _sql_str(WS)
_STATUS = f"trim(upper(coalesce(payment_status, 'UNPAID')), {_WS})"
_DUE = "CAST(try_strptime(payment_due_date, '%Y-%m-%d') AS DATE)"
_D = "CAST(strptime(transaction_date, '%Y-%m-%d') AS DATE)"
_MARGIN = "CAST(CAST(unit_price AS DECIMAL(18,4)) - coalesce(CAST(cost_price AS DECIMAL(18,4)), 0) AS DECIMAL(19,4))"

STG = f"""SELECT CAST(invoice_number AS VARCHAR) AS transaction_id,
  {_D} AS transaction_date,
  CAST(year({_D}) AS BIGINT) AS transaction_year,
  CAST(month({_D}) AS BIGINT) AS transaction_month,
  monthname({_D}) AS transaction_month_name,
  CAST(quarter({_D}) AS BIGINT) AS transaction_quarter,
  CAST(customer_name AS VARCHAR) AS customer_id,
  trim(upper(customer_name), {_WS}) AS customer_name,
  trim(product_name, {_WS}) AS product_name,
  CAST(product_name AS VARCHAR) AS product_id,
  CAST(quantity AS DECIMAL(18,4)) AS quantity,
  CAST(unit_price AS DECIMAL(18,4)) AS unit_price,
  CAST(cost_price AS DECIMAL(18,4)) AS cost_price,
  CAST(total_amount AS DECIMAL(18,4)) AS total_amount,
  {_MARGIN} AS unit_margin,
  CASE WHEN CAST(unit_price AS DECIMAL(18,4)) > 0 THEN {div9(_MARGIN, 'CAST(unit_price AS DECIMAL(18,4))')}
       ELSE CAST(0 AS DECIMAL(28,9)) END AS margin_percentage,
  {_STATUS} AS payment_status,
  {_DUE} AS payment_due_date,
  CAST(CASE WHEN {_STATUS} = 'PAID' THEN 0
       WHEN {_DUE} IS NULL THEN NULL
       ELSE date_diff('day', {_DUE}, {AS_OF}) END AS BIGINT) AS days_overdue
FROM raw
WHERE transaction_date IS NOT NULL AND quantity > 0 AND total_amount > 0"""

BASE = [("raw", RAW), ("stg", STG)]

CUSTOMER_METRICS = f"""SELECT customer_id,
  max(customer_name) AS customer_name,
  count(DISTINCT transaction_id) AS total_transactions,
  CAST(sum(total_amount) AS DECIMAL(38,4)) AS lifetime_value,
  {avg9('margin_percentage')} AS avg_customer_margin,
  max(transaction_date) AS last_purchase_date,
  CAST(date_diff('day', max(transaction_date), {AS_OF}) AS BIGINT) AS days_since_last_purchase,
  CAST(sum(CASE WHEN payment_status <> 'PAID' THEN total_amount ELSE 0 END) AS DECIMAL(38,4)) AS total_outstanding,
  count(CASE WHEN days_overdue > 0 THEN 1 END) AS overdue_invoice_count
FROM stg GROUP BY customer_id"""

PRODUCT_METRICS = f"""SELECT product_id,
  max(product_name) AS product_name,
  count(DISTINCT customer_id) AS unique_customers,
  CAST(sum(quantity) AS DECIMAL(38,4)) AS total_quantity_sold,
  {avg9('margin_percentage')} AS avg_product_margin,
  max(transaction_date) AS last_sold_date,
  CAST(date_diff('day', max(transaction_date), {AS_OF}) AS BIGINT) AS days_since_last_sold,
  CAST(sum(CASE WHEN transaction_date >= {AS_OF} - INTERVAL {P.velocity_days} DAY THEN quantity ELSE 0 END) AS DECIMAL(38,4)) AS quantity_sold_last_30d
FROM stg GROUP BY product_id"""

ENRICHED = """SELECT s.*,
  cm.lifetime_value AS customer_lifetime_value, cm.days_since_last_purchase, cm.avg_customer_margin,
  cm.total_outstanding AS customer_total_outstanding, cm.overdue_invoice_count AS customer_overdue_count,
  pm.avg_product_margin, pm.last_sold_date AS product_last_sold_date,
  pm.days_since_last_sold AS product_days_since_last_sold, pm.quantity_sold_last_30d AS product_velocity_30d
FROM stg s LEFT JOIN cm ON s.customer_id = cm.customer_id
  LEFT JOIN pm ON s.product_id = pm.product_id"""

DEAD_STOCK = f"""SELECT product_id, product_name, last_sale_date, days_since_last_sale,
  total_quantity_ever_sold, avg_margin,
  CAST(round(total_quantity_ever_sold * 0.1 * 4000, 2) AS DECIMAL(38,2)) AS estimated_value_locked,
  CASE WHEN days_since_last_sale >= 180 THEN 'CRITICAL' WHEN days_since_last_sale >= 120 THEN 'HIGH'
       WHEN days_since_last_sale >= {P.dead_stock_days} THEN 'MEDIUM' ELSE 'LOW' END AS alert_severity,
  CASE WHEN days_since_last_sale >= 180 THEN {_sql_str(C.DEAD_ACTION_CRITICAL)}
       WHEN days_since_last_sale >= 120 THEN {_sql_str(C.DEAD_ACTION_HIGH)}
       WHEN days_since_last_sale >= 90 THEN {_sql_str(C.DEAD_ACTION_MEDIUM)}
       ELSE {_sql_str(C.DEAD_ACTION_NORMAL)} END AS recommended_action,
  {AS_OF} AS analysis_date
FROM (SELECT product_id, max(product_name) AS product_name, max(transaction_date) AS last_sale_date,
        CAST(date_diff('day', max(transaction_date), {AS_OF}) AS BIGINT) AS days_since_last_sale,
        CAST(sum(quantity) AS DECIMAL(38,4)) AS total_quantity_ever_sold,
        {avg9('margin_percentage')} AS avg_margin
      FROM stg GROUP BY product_id) t
WHERE days_since_last_sale >= {P.dead_stock_days}"""

_THR = f"CAST('{P.low_margin_threshold}' AS DECIMAL(2,2))"
LOW_MARGIN = f"""SELECT transaction_id, transaction_date, customer_id, customer_name, product_id, product_name,
  quantity, unit_price, cost_price, margin_percentage, total_amount,
  CAST(unit_margin * quantity AS DECIMAL(38,8)) AS total_margin_earned,
  CAST(CAST({_THR} * unit_price - unit_margin AS DECIMAL(20,6)) * CAST(quantity AS DECIMAL(17,4)) AS DECIMAL(38,10)) AS margin_gap_vs_target,
  avg_product_margin,
  CAST(margin_percentage - avg_product_margin AS DECIMAL(28,9)) AS margin_vs_product_avg,
  CASE WHEN margin_percentage < 0 THEN 'CRITICAL' WHEN margin_percentage < 0.05 THEN 'HIGH'
       WHEN margin_percentage < {_THR} THEN 'MEDIUM' ELSE 'LOW' END AS alert_severity,
  CASE WHEN margin_percentage < 0 THEN {_sql_str(C.CAUSE_BELOW_COST)}
       WHEN cost_price IS NULL THEN {_sql_str(C.CAUSE_MISSING_COST)}
       WHEN margin_percentage < avg_product_margin THEN {_sql_str(C.CAUSE_BELOW_AVG)}
       ELSE {_sql_str(C.CAUSE_GENERAL)} END AS probable_cause,
  CASE WHEN margin_percentage < 0 THEN {_sql_str(C.MARGIN_ACTION_CRITICAL)}
       WHEN margin_percentage < 0.05 THEN {_sql_str(C.MARGIN_ACTION_HIGH)}
       ELSE {_sql_str(C.MARGIN_ACTION_OTHER)} END AS recommended_action,
  {AS_OF} AS analysis_date
FROM stg s LEFT JOIN (SELECT product_id AS pid, {avg9('margin_percentage')} AS avg_product_margin
                      FROM stg GROUP BY product_id) pa ON s.product_id = pa.pid
WHERE margin_percentage < {_THR} AND cost_price IS NOT NULL
  AND transaction_date >= {AS_OF} - INTERVAL {P.low_margin_lookback_days} DAY"""

_RISK = (f"CAST(round(CAST({div9('total_overdue_amount', 'nullif(customer_lifetime_value, 0)')} AS DECIMAL(20,9)) * 100, 2) "
         f"AS DECIMAL(38,2))")
CREDIT_RISK = f"""SELECT customer_id, customer_name, overdue_invoice_count, total_overdue_amount, max_days_overdue,
  round(avg_days_overdue, 0) AS avg_days_overdue, oldest_unpaid_date, customer_lifetime_value, overdue_invoice_ids,
  CAST(CASE WHEN max_days_overdue > 90 THEN 0 WHEN max_days_overdue > 60 THEN 25
       WHEN max_days_overdue > 30 THEN 50 WHEN max_days_overdue > 15 THEN 75 ELSE 100 END AS BIGINT) AS payment_score,
  {_RISK} AS risk_percentage_of_ltv,
  CASE WHEN total_overdue_amount > 100000 AND max_days_overdue > 60 THEN 'CRITICAL'
       WHEN max_days_overdue > 90 THEN 'CRITICAL' WHEN max_days_overdue > 60 THEN 'HIGH'
       WHEN max_days_overdue > 30 THEN 'MEDIUM' WHEN max_days_overdue > {P.credit_risk_days} THEN 'LOW'
       ELSE 'INFO' END AS alert_severity,
  CASE WHEN max_days_overdue > 90 THEN {_sql_str(C.CREDIT_ACTION_CRITICAL)}
       WHEN max_days_overdue > 60 THEN {_sql_str(C.CREDIT_ACTION_HIGH)}
       WHEN max_days_overdue > 30 THEN {_sql_str(C.CREDIT_ACTION_MEDIUM)}
       ELSE {_sql_str(C.CREDIT_ACTION_LOW)} END AS recommended_action,
  {AS_OF} AS analysis_date
FROM (SELECT s.customer_id, max(s.customer_name) AS customer_name, max(cm.lifetime_value) AS customer_lifetime_value,
        count(DISTINCT transaction_id) AS overdue_invoice_count,
        CAST(sum(total_amount) AS DECIMAL(38,4)) AS total_overdue_amount,
        max(days_overdue) AS max_days_overdue, avg(days_overdue) AS avg_days_overdue,
        min(transaction_date) AS oldest_unpaid_date,
        string_agg(transaction_id, ', ' ORDER BY transaction_date, transaction_id) AS overdue_invoice_ids
      FROM stg s LEFT JOIN cm ON s.customer_id = cm.customer_id
      WHERE payment_status <> 'PAID' AND days_overdue >= {P.credit_risk_days}
      GROUP BY s.customer_id) u"""

MARTS = BASE + [("cm", CUSTOMER_METRICS), ("pm", PRODUCT_METRICS), ("dead", DEAD_STOCK),
                ("lowm", LOW_MARGIN), ("credit", CREDIT_RISK)]


def _fmt0(x: str) -> str:
    return f"format('{{:,.0f}}', {x})"


def _fmt1(x: str) -> str:
    return f"replace(format('{{:,.1f}}', {x}), ',', '')"


def _alerts(src: str, alert_type: str, entity: str, metric: str, message: str, action: str, order: str) -> str:
    return f"""SELECT '{alert_type}' AS alert_type, alert_severity AS severity, {entity} AS entity,
  {metric} AS metric_value, CAST(0.0 AS DOUBLE) AS threshold, {message} AS message, {action} AS action,
  CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS fetch_rank
FROM (SELECT * FROM {src} WHERE alert_severity IN ('CRITICAL', 'HIGH') ORDER BY {order} LIMIT {P.alerts_per_mart}) t"""


A_DEAD = _alerts("dead", C.DEAD_STOCK, "product_name", "CAST(days_since_last_sale AS DOUBLE)",
                 "coalesce(product_name, 'None') || ' not sold for ' || CAST(days_since_last_sale AS VARCHAR) || ' days'",
                 "recommended_action",
                 "days_since_last_sale DESC NULLS LAST, product_name ASC NULLS FIRST, product_id ASC NULLS FIRST")
A_LOW = _alerts("(SELECT *, customer_name || ' - ' || product_name AS entity FROM lowm)", C.LOW_MARGIN, "entity",
                "CAST(margin_percentage * 100 AS DOUBLE)",
                f"coalesce(entity, 'None') || ' has ' || {_fmt1('CAST(margin_percentage * 100 AS DOUBLE)')} || '% margin'",
                "probable_cause",
                "margin_percentage ASC NULLS FIRST, entity ASC NULLS FIRST, alert_severity ASC NULLS FIRST, "
                "probable_cause ASC NULLS FIRST")
A_CREDIT = _alerts("credit", C.CREDIT_RISK, "customer_name", "CAST(total_overdue_amount AS DOUBLE)",
                   f"coalesce(customer_name, 'None') || ' owes {C.RUPEE}' || {_fmt0('CAST(total_overdue_amount AS DOUBLE)')}",
                   "recommended_action",
                   "total_overdue_amount DESC NULLS LAST, customer_name ASC NULLS FIRST, customer_id ASC NULLS FIRST")

_SEV_RANK = ("CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 "
             "WHEN 'LOW' THEN 3 ELSE 4 END")
ALL_ALERTS = "SELECT * FROM a_credit UNION ALL SELECT * FROM a_dead UNION ALL SELECT * FROM a_low"
BALANCED = f"""SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY alert_type ORDER BY {_SEV_RANK}, metric_value DESC, fetch_rank) AS INTEGER) AS type_rank
  FROM alerts) t WHERE type_rank <= {P.alerts_per_type}"""
ALERTS = MARTS + [("a_dead", A_DEAD), ("a_low", A_LOW), ("a_credit", A_CREDIT), ("alerts", ALL_ALERTS),
                  ("balanced", BALANCED)]

_EMOJI = ("CASE severity " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.SEVERITY_EMOJI.items())
          + f" ELSE '{C.DEFAULT_EMOJI}' END")
_SECTION = ("CASE alert_type " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(C.ALERT_TYPE_ORDER))
            + f" ELSE {len(C.ALERT_TYPE_ORDER)} END")
DIGEST_LINES = f"""SELECT alert_type, {_SECTION} AS section_order, type_rank AS line_number,
  {_EMOJI} || ' ' || CAST(type_rank AS VARCHAR) || '. ' || coalesce(entity, 'None') || chr(10) || '   └ ' ||
  CASE alert_type WHEN '{C.CREDIT_RISK}' THEN 'Owes: {C.RUPEE}' || {_fmt0('metric_value')}
                  WHEN '{C.DEAD_STOCK}' THEN 'Not sold: ' || CAST(CAST(trunc(metric_value) AS BIGINT) AS VARCHAR) || ' days'
                  ELSE 'Margin: ' || {_fmt1('metric_value')} || '%' END
  || chr(10) || '   └ ' || coalesce(action, 'None') AS line
FROM balanced WHERE type_rank <= {P.digest_lines_per_type}"""


_TITLES = " UNION ALL ".join(f"SELECT '{t}' AS alert_type, {_sql_str(C.SECTION_TITLES[t])} AS title"
                             for t in C.ALERT_TYPE_ORDER)
_WHEN = f"strftime(TIMESTAMP '{P.digest_ts().isoformat(sep=' ')}', '%d %b %Y, %I:%M %p')"
_HEADER = (f"{_sql_str(C.DIGEST_HEADER.format(business=P.business_name))} || chr(10) || '📅 ' || {_WHEN} || chr(10) "
           f"|| chr(10) || {_sql_str(C.DIGEST_ACTION_LINE)} || chr(10)")
_FOOTER = " || chr(10) || ".join(_sql_str(x) for x in C.DIGEST_FOOTER)
_NO_ALERTS = _sql_str(C.NO_ALERTS_TEXT.format(business=P.business_name))
DIGEST = f"""SELECT {_sql_str(P.business_name)} AS business,
  CASE WHEN count(*) = 0 THEN {_NO_ALERTS}
       ELSE {_HEADER} || chr(10) || string_agg(block, chr(10) ORDER BY section_order) || chr(10) || {_FOOTER} END AS digest
FROM (SELECT l.section_order, t.title || chr(10) || string_agg(l.line, chr(10) ORDER BY l.line_number) || chr(10) AS block
      FROM lines l JOIN ({_TITLES}) t ON l.alert_type = t.alert_type
      GROUP BY l.alert_type, l.section_order, t.title) s"""


def queries() -> dict[str, str]:
    """Oracle SQL per query key."""
    b = BASE
    cols_stg = "*"
    inv = f"""SELECT p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_id,
  p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name,
  {AS_OF} AS snapshot_date, CAST(CASE WHEN p_partkey % 97 = 0 THEN -3 ELSE p_partkey % 40 END AS DECIMAL(18,4)) AS quantity_on_hand,
  CAST(10 AS DECIMAL(18,4)) AS reorder_level,
  CAST({AS_OF} - CAST(p_partkey % 365 - 3 AS INTEGER) AS DATE) AS last_sale_date,
  CASE p_partkey % 6 WHEN 0 THEN 'Monoblock Pump' WHEN 1 THEN 'Submersible Pump' WHEN 2 THEN 'Motor' WHEN 3 THEN 'Accessories' ELSE split_part(p_type, ' ', 1) END AS product_category
FROM part"""
    return {
        "inventory_snapshot": inv,
        "raw_sales": RAW,
        "staging": with_(b, f"SELECT {cols_stg} FROM stg"),
        "customer_metrics": with_(b, CUSTOMER_METRICS),
        "product_metrics": with_(b, PRODUCT_METRICS),
        "sales_enriched": with_(b + [("cm", CUSTOMER_METRICS), ("pm", PRODUCT_METRICS)], ENRICHED),
        "mart_dead_stock": with_(b, DEAD_STOCK),
        "mart_low_margin": with_(b, LOW_MARGIN),
        "mart_credit_risk": with_(b + [("cm", CUSTOMER_METRICS)], CREDIT_RISK),
        "alerts_dead_stock": with_(MARTS, A_DEAD),
        "alerts_low_margin": with_(MARTS, A_LOW),
        "alerts_credit_risk": with_(MARTS, A_CREDIT),
        "all_alerts": with_(ALERTS, "SELECT * FROM alerts"),
        "balanced_alerts": with_(ALERTS, "SELECT * FROM balanced"),
        "alert_counts": with_(ALERTS, "SELECT alert_type, count(*) AS alert_count FROM balanced GROUP BY alert_type"),
        "digest_lines": with_(ALERTS, DIGEST_LINES),
        "daily_digest": with_(ALERTS + [("lines", DIGEST_LINES)], DIGEST),
        "daily_digest_empty": f"SELECT {_sql_str(P.business_name)} AS business, {_NO_ALERTS} AS digest",
        "alerts_missing_mart": with_(MARTS + [("a_dead", A_DEAD), ("a_credit", A_CREDIT)],
                                     "SELECT * FROM a_credit UNION ALL SELECT * FROM a_dead"),
    }
