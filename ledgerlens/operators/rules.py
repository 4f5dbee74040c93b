"""Rules the configuration declares but the warehouse models never ran:
quality rules, rule conditions and severity ladders as data, message
templates, inventory checks, benchmark bands, seasonality, credit terms and
score, digest caps and number formats.

Where the configuration gives no formula the reading chosen here is stated
in the function's docstring.  Everything is column expressions and
aggregates; small configuration tables are joined with an explicit
``broadcast`` only because their size is fixed by the configuration.
"""

from __future__ import annotations

import functools
import string
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StructType

from ledgerlens import config as C
from ledgerlens.config import DEFAULT, Params
from ledgerlens.functions.columns import (
    MARGIN_TYPE, days_between, exact_ratio, fmt_fixed, indian_grouping, severity_rank, ws_trim,
)

# ---------------------------------------------------------------------------
# D1 / D2: data-quality rules, one tagging pass each
# ---------------------------------------------------------------------------


def sales_rule_checks(p: Params = DEFAULT) -> list[tuple[str, str, Column]]:
    """(rule, severity, failing condition) for typed sales rows
    (quantity, unit_price, total_amount, cost_price, transaction_date)."""
    names = [r for r, _ in C.DQ_RULES["sales_transactions"]]
    sev = dict(C.DQ_RULES["sales_transactions"])
    q, pr, tot, cost = F.col("quantity"), F.col("unit_price"), F.col("total_amount"), F.col("cost_price")
    conds = [
        ~F.coalesce(q > 0, F.lit(False)),
        ~F.coalesce(pr > 0, F.lit(False)),
        # ours: equality within 0.01
        F.coalesce(F.abs(tot - q * pr) > F.lit(C.TOTAL_TOLERANCE), F.lit(False)),
        cost.isNotNull() & pr.isNotNull() & (cost >= pr),
        F.coalesce(F.col("transaction_date") > F.lit(p.as_of), F.lit(False)),
    ]
    return [(n, sev[n], c) for n, c in zip(names, conds)]


def inventory_rule_checks() -> list[tuple[str, str, Column]]:
    names = [r for r, _ in C.DQ_RULES["inventory"]]
    sev = dict(C.DQ_RULES["inventory"])
    conds = [
        ~F.coalesce(F.col("quantity_on_hand") >= 0, F.lit(False)),
        F.coalesce(F.col("last_sale_date") > F.col("snapshot_date"), F.lit(False)),
    ]
    return [(n, sev[n], c) for n, c in zip(names, conds)]


def tag_rules(df: DataFrame, checks) -> DataFrame:
    """Adds ``failed_rules`` (array of rule names, in rule order) and
    ``has_error`` (an error rule failed: the row is dropped by ``apply_rules``)."""
    failed = F.filter(F.array(*[F.when(c, F.lit(n)) for n, _, c in checks]), lambda x: x.isNotNull())
    errors = [c for _, s, c in checks if s == "error"]
    return df.withColumns({"failed_rules": failed,
                           "has_error": functools.reduce(lambda a, b: a | b, errors, F.lit(False))})


def rule_counts(df: DataFrame, checks, entity: str) -> DataFrame:
    """(entity, rule, severity, failures) in one aggregate."""
    agg = df.agg(*[F.count_if(c).alias(f"r{i}") for i, (_, _, c) in enumerate(checks)])
    args = ", ".join(f"'{n}', '{s}', CAST(r{i} AS BIGINT)" for i, (n, s, _) in enumerate(checks))
    return agg.selectExpr(f"'{entity}' AS entity", f"stack({len(checks)}, {args}) AS (rule, severity, failures)")


def apply_rules(df: DataFrame, checks) -> DataFrame:
    """Rows without an error; warnings stay as tags."""
    return tag_rules(df, checks).where(~F.col("has_error"))


# ---------------------------------------------------------------------------
# D6 / D7 / D8: rule conditions, severity ladders and message templates
# ---------------------------------------------------------------------------

_OPS = {
    ">=": lambda a, b: a >= b, ">": lambda a, b: a > b, "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b, "!=": lambda a, b: a != b, "==": lambda a, b: a == b,
}


def condition_column(cond: C.Condition) -> Column:
    """A Column from one declared condition (whitelisted operators only).
    Text values compare trimmed and case-insensitively (ours: the YAML writes
    'Paid' where staging holds 'PAID')."""
    col = F.col(cond.field)
    if cond.operator == "IS NOT NULL":
        return col.isNotNull()
    if cond.operator == "IS NULL":
        return col.isNull()
    if cond.operator not in _OPS:
        raise ValueError(f"operator not allowed: {cond.operator}")
    if cond.value_ref is not None:
        other = F.col(cond.value_ref)
    elif isinstance(cond.value, str):
        col, other = F.upper(ws_trim(col)), F.lit(cond.value.strip().upper())
    else:
        other = F.lit(cond.value)
    return F.coalesce(_OPS[cond.operator](col, other), F.lit(False))


def rule_filter(rule: C.Rule) -> Column:
    """All conditions of a rule, AND-ed."""
    return functools.reduce(lambda a, b: a & b, [condition_column(c) for c in rule.conditions])


def rule(name: str) -> C.Rule:
    return next(r for r in C.ALERT_RULES if r.name == name)


def severity_column(r: C.Rule, amount_col: str | None = None) -> Column:
    """Severity from the rule's ladder.  'ge' rules: metric >= level; 'lt'
    rules: metric < level (strictly below, ours).  A level with an amount is
    met when both the days and the amount are (AND, as rule conditions are)."""
    metric = F.col(r.metric)
    out = F.lit(None).cast("string")
    for lv in reversed(r.levels):
        hit = metric >= F.lit(lv.threshold) if r.direction == "ge" else metric < F.lit(lv.threshold)
        if lv.amount is not None and amount_col:
            hit = hit & (F.col(amount_col) >= F.lit(lv.amount))
        out = F.when(hit, F.lit(lv.name.upper())).otherwise(out)
    return out


def level_text(r: C.Rule, sev: Column, attr: str) -> Column:
    out = F.lit(None).cast("string")
    for lv in r.levels:
        out = F.when(sev == lv.name.upper(), F.lit(getattr(lv, attr))).otherwise(out)
    return out


def render_template(template: str, values: dict[str, Column]) -> Column:
    """'{name} owes {amount}' -> concat of literals and columns (split once, on the driver)."""
    parts = []
    for lit, field, _, _ in string.Formatter().parse(template):
        if lit:
            parts.append(F.lit(lit))
        if field is not None:
            parts.append(F.coalesce(values[field].cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def rule_messages_for(r: C.Rule, df: DataFrame, values: dict[str, Column], entity: Column,
                      amount_col: str | None = None, prefiltered: bool = False) -> DataFrame:
    """One row per entity meeting the rule: severity, message and action from
    the ladder.  ``prefiltered``: ``df`` is an aggregate of rows that already
    met the rule's line-level conditions."""
    sev = severity_column(r, amount_col)
    rows = (df if prefiltered else df.where(rule_filter(r))).withColumn("severity", sev).where(F.col("severity").isNotNull())
    msg = F.lit(None).cast("string")
    for lv in r.levels:
        msg = F.when(F.col("severity") == lv.name.upper(), render_template(lv.message, values)).otherwise(msg)
    return rows.select(F.lit(r.name).alias("rule"), entity.alias("entity"), "severity",
                       msg.alias("message"), level_text(r, F.col("severity"), "action").alias("action"))


FORMATS = {
    "whole": lambda c: c.cast("bigint"),
    "indian": indian_grouping,
    "percent": lambda c: fmt_fixed((c * 100).cast("double"), 1),
}


def _number(kind: DataType) -> bool:
    return isinstance(kind, NumericType)


def faults(r: C.Rule, frames: Mapping[str, StructType]) -> list[str]:
    """What is wrong with a declared rule, given the columns of the frames it may read."""
    out = []

    def kind(frame: str, column: str, what: str) -> DataType | None:
        if frame not in frames:
            return None
        if column not in frames[frame].names:
            out.append(f"{what}: {frame} has no column {column}")
            return None
        return frames[frame][column].dataType

    for name in {r.frame, r.filter_frame}:
        if name not in frames:
            out.append(f"no frame {name!r}")
    for c in r.conditions:
        of = kind(r.filter_frame, c.field, "condition")
        if c.operator not in _OPS and c.operator not in ("IS NULL", "IS NOT NULL"):
            out.append(f"condition on {c.field}: operator not allowed: {c.operator}")
        if c.value_ref is not None:
            kind(r.filter_frame, c.value_ref, "condition")
        elif c.operator in _OPS and of is not None and (c.value is None or _number(of) != (not isinstance(c.value, str))):
            out.append(f"condition on {c.field}: {c.value!r} does not compare with {of.simpleString()}")
    metric = kind(r.frame, r.metric, "metric") if r.levels else None
    if metric is not None and not _number(metric):
        out.append(f"metric {r.metric} is no number")
    if r.direction not in ("ge", "lt"):
        out.append(f"direction {r.direction!r}")
    steps = [lv.threshold for lv in r.levels]
    if steps != sorted(steps, reverse=r.direction == "ge"):
        out.append("levels are not in order of severity")
    for lv in r.levels:
        if lv.name.upper() not in C.SEVERITY_ORDER:
            out.append(f"level {lv.name!r}")
        if lv.amount is not None and r.amount_field is None:
            out.append(f"level {lv.name}: an amount without amount_field")
        out += [f"level {lv.name}: no value for {{{f}}}" for _, f, _, _ in string.Formatter().parse(lv.message) if f is not None and f not in r.values]
    for column, *form in r.values.values():
        kind(r.frame, column, "value")
        out += [f"value {column}: no format {f!r}" for f in form if f not in FORMATS]
    for k in (*r.key, *([r.amount_field] if r.amount_field else [])):
        kind(r.frame, k, "key")
    return out


def compiled(rules: Iterable[C.Rule], frames: Mapping[str, DataFrame]) -> DataFrame:
    """(rule, entity, severity, message, action) of every enabled rule of a rule file:
    conditions, ladder and templates as columns over the frames it names.  All rules
    are checked against the frames' columns first; what is wrong is one error."""
    rules = [r for r in rules if r.enabled]
    schemas = {n: f.schema for n, f in frames.items()}
    wrong = [f"{r.name}: {fault}" for r in rules for fault in faults(r, schemas)]
    if wrong:
        raise ValueError("; ".join(wrong))
    out = []
    for r in rules:
        values = {name: FORMATS[form[0]](F.col(c)) if form else F.col(c) for name, (c, *form) in r.values.items()}
        entity = F.col(r.key[0]) if len(r.key) == 1 else F.concat_ws("|", *r.key)
        out.append(rule_messages_for(r, frames[r.frame], values, entity, r.amount_field, prefiltered=r.filter_frame != r.frame))
    return functools.reduce(DataFrame.unionByName, out)


# ---------------------------------------------------------------------------
# D9 / D10: inventory
# ---------------------------------------------------------------------------


def latest_snapshot(inv: DataFrame) -> DataFrame:
    """Latest snapshot row per product: one max-by aggregate (no per-product sort)."""
    cols = [c for c in inv.columns if c != "product_id"]
    latest = inv.groupBy("product_id").agg(F.max_by(F.struct(*cols), F.col("snapshot_date")).alias("s"))
    return latest.select("product_id", *[F.col(f"s.{c}").alias(c) for c in cols])


def dead_stock_on_hand(dead: DataFrame, inv: DataFrame) -> DataFrame:
    """Dead-stock rows whose latest stock on hand is above zero."""
    snap = latest_snapshot(inv).select("product_id", "quantity_on_hand", F.col("snapshot_date"))
    return dead.join(snap, "product_id").where(condition_column(C.Condition("quantity_on_hand", ">", 0)))


def stock_out(inv: DataFrame) -> DataFrame:
    """Latest snapshot at or below its reorder level (the rule is disabled in
    the configuration; this is the check it declares)."""
    return latest_snapshot(inv).where(rule_filter(rule("stock_out")))


# ---------------------------------------------------------------------------
# D11 - D16: benchmarks
# ---------------------------------------------------------------------------


def dead_stock_variant(product_days: DataFrame) -> DataFrame:
    """Dead-stock severities with the wider ladder (LOW from 60 days)."""
    t = C.THRESHOLD_VARIANTS["dead_stock"]
    d = F.col("days_since_last_sale")
    sev = (F.when(d >= t["critical"], "CRITICAL").when(d >= t["high"], "HIGH")
            .when(d >= t["medium"], "MEDIUM").when(d >= t["low"], "LOW"))
    return product_days.withColumn("severity", sev).where(F.col("severity").isNotNull())


def credit_variant(customer_overdue: DataFrame) -> DataFrame:
    """Credit severities where days OR amount reach a level (ours)."""
    t = C.THRESHOLD_VARIANTS["credit_risk"]
    d, a = F.col("max_days_overdue"), F.col("total_overdue_amount")
    sev = (F.when((d >= t["critical_days"]) | (a >= t["critical_amount"]), "CRITICAL")
            .when((d >= t["high_days"]) | (a >= t["high_amount"]), "HIGH")
            .when(d >= t["medium_days"], "MEDIUM").otherwise("LOW"))
    return customer_overdue.withColumn("severity", sev)


def category_margins(spark: SparkSession, bench: C.Benchmarks = C.PUMPS) -> DataFrame:
    rows = [(k, *v) for k, v in bench.category_margins.items()]
    return spark.createDataFrame(rows, "product_category string, target_margin decimal(4,2), min_margin decimal(4,2)")


def margin_bands(sales: DataFrame, spark: SparkSession, bench: C.Benchmarks = C.PUMPS) -> DataFrame:
    """Margin band per sale line against its category's target and minimum,
    falling back to the industry bands.
    The category table has a fixed handful of rows: broadcast."""
    cats = F.broadcast(category_margins(spark, bench))
    df = sales.join(cats, "product_category", "left")
    target = F.coalesce(F.col("target_margin"), F.lit(bench.margins["healthy"]))
    minimum = F.coalesce(F.col("min_margin"), F.lit(bench.margins["acceptable"]))
    m = F.col("margin_percentage")
    band = (F.when(m >= target, "healthy").when(m >= minimum, "acceptable")
             .when(m >= F.lit(bench.margins["critical"]), "below_minimum").otherwise("critical"))
    return df.withColumn("margin_band", band)


def industry_bands(sales: DataFrame, spark: SparkSession, industries: Mapping[str, C.Benchmarks] = C.BENCHMARKS) -> DataFrame:
    """(industry, product_category, margin_band, sale_lines): every sale line judged
    by the margins of every industry, in one pass over the lines; a line without a
    margin is in the band ``critical``, as in ``margin_bands``."""
    df = sales.select("product_category", "margin_percentage")
    for i, bench in enumerate(industries.values()):
        df = margin_bands(df, spark, bench).drop("target_margin", "min_margin").withColumnRenamed("margin_band", f"_band{i}")
    each = [F.struct(F.lit(name).alias("industry"), F.col(f"_band{i}").alias("margin_band")) for i, name in enumerate(industries)]
    rows = df.select("product_category", F.inline(F.array(*each)))
    return rows.groupBy("industry", "product_category", "margin_band").agg(F.count(F.lit(1)).alias("sale_lines"))


def turnover(sales: DataFrame, p: Params = DEFAULT, bench: C.Benchmarks = C.GENERAL) -> DataFrame:
    """Average days between consecutive sale lines of a product against the
    turnover target (category target, else the industry's).  The mean of the
    consecutive gaps telescopes to (last - first) / (lines - 1), so this is a
    plain aggregate, not a per-product sort."""
    # the category is a function of the product: a grouping key, not a string max
    per = sales.groupBy("product_id", "product_category").agg(
        F.count(F.lit(1)).alias("sale_lines"),
        F.min("transaction_date").alias("first_sale"),
        F.max("transaction_date").alias("last_sale"))
    span = days_between(F.col("last_sale"), F.col("first_sale"))
    avg_gap = F.when(F.col("sale_lines") > 1, span / (F.col("sale_lines") - 1))
    target = F.lit(bench.turnover_days)
    for cat, days in bench.category_turnover_days.items():
        target = F.when(F.col("product_category") == cat, F.lit(days)).otherwise(target)
    return per.select("product_id", "product_category", "sale_lines", avg_gap.alias("avg_days_between_sales"),
                      target.alias("target_days"), (avg_gap > target).alias("slower_than_target"))


def season_table(spark: SparkSession, bench: C.Benchmarks = C.PUMPS) -> DataFrame:
    rows = [(m, name, mult) for name, months, mult in bench.seasons for m in months]
    return spark.createDataFrame(rows, "transaction_month bigint, season string, multiplier decimal(3,1)")


def seasonal_expectation(sales: DataFrame, spark: SparkSession, bench: C.Benchmarks = C.PUMPS) -> DataFrame:
    """Monthly quantity against expectation = mean monthly quantity x the
    season's multiplier (ours: the configuration names only the multipliers)."""
    monthly = sales.groupBy("transaction_year", "transaction_month").agg(
        F.sum("quantity").cast("decimal(28,4)").alias("actual_quantity"))
    # one row per calendar month seen: a whole-table window over it is bounded
    everything = Window.partitionBy()
    mean_q = (F.sum("actual_quantity").over(everything).cast("decimal(28,4)")
              / F.count(F.lit(1)).over(everything)).cast("decimal(38,4)")
    df = monthly.join(F.broadcast(season_table(spark, bench)), "transaction_month", "left").withColumn("mean_q", mean_q)
    return df.select("transaction_year", "transaction_month", "season", "multiplier",
                     F.col("actual_quantity").cast("decimal(38,4)").alias("actual_quantity"),
                     (F.col("mean_q") * F.col("multiplier")).cast("decimal(38,5)").alias("expected_quantity"))


def credit_terms(sales: DataFrame, p: Params = DEFAULT, bench: C.Benchmarks = C.PUMPS) -> DataFrame:
    """Due date falling back to sale date + the standard credit period; days
    past due against the overdue threshold and the critical level; lines
    older than the maximum period while unpaid."""
    t = bench.credit_terms
    due = F.coalesce(F.col("payment_due_date"), F.date_add(F.col("transaction_date"), t["standard_credit_period"]))
    unpaid = F.col("payment_status") != "PAID"
    past = days_between(F.lit(p.as_of), due)
    age = days_between(F.lit(p.as_of), F.col("transaction_date"))
    return sales.select(
        "transaction_id", "product_id", "customer_id",
        due.alias("effective_due_date"),
        F.when(unpaid, past).alias("days_past_due"),
        (unpaid & (past > t["overdue_threshold"])).alias("overdue"),
        (unpaid & (past > t["critical_overdue"])).alias("critical"),
        (unpaid & (age > t["maximum_credit_period"])).alias("beyond_max_period"),
    )


def credit_score(sales: DataFrame, p: Params = DEFAULT, bench: C.Benchmarks = C.PUMPS) -> DataFrame:
    """Weighted score 0-100 per customer from four features in [0, 1] (the
    features are ours; the weights are the configuration's):
      payment_history   = paid lines / lines
      overdue_amount    = 1 - min(1, overdue amount / lifetime value)
      payment_frequency = min(1, distinct purchase days / max(1, tenure days / 30))
      customer_tenure   = min(1, tenure days / 365), tenure from first purchase to as_of."""
    w = bench.credit_score_weights
    overdue = (F.col("payment_status") != "PAID") & (F.col("days_overdue") > 0)
    per = sales.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("payment_status") == "PAID").alias("paid_lines"),
        F.sum(F.when(overdue, F.col("total_amount")).otherwise(F.lit(0))).alias("overdue_amount"),
        F.sum("total_amount").alias("lifetime_value"),
        F.count_distinct("transaction_date").alias("purchase_days"),
        F.min("transaction_date").alias("first_purchase"))
    tenure = days_between(F.lit(p.as_of), F.col("first_purchase")).cast("double")
    ph = F.col("paid_lines").cast("double") / F.col("lines").cast("double")
    ratio = F.when(F.col("lifetime_value") > 0,
                   F.col("overdue_amount").cast("double") / F.col("lifetime_value").cast("double"))
    oa = F.lit(1.0) - F.least(F.lit(1.0), F.coalesce(ratio, F.lit(1.0)))
    pf = F.least(F.lit(1.0), F.col("purchase_days").cast("double") / F.greatest(F.lit(1.0), tenure / F.lit(30.0)))
    ct = F.least(F.lit(1.0), tenure / F.lit(365.0))
    score = (((F.lit(float(w["payment_history"])) * ph + F.lit(float(w["overdue_amount"])) * oa)
              + F.lit(float(w["payment_frequency"])) * pf) + F.lit(float(w["customer_tenure"])) * ct) * F.lit(100.0)
    return per.select("customer_id", ph.alias("payment_history"), oa.alias("overdue_amount_score"),
                      pf.alias("payment_frequency"), ct.alias("customer_tenure"), score.alias("credit_score"))


# ---------------------------------------------------------------------------
# D17 - D19
# ---------------------------------------------------------------------------


def digest_capped(balanced: DataFrame) -> DataFrame:
    """At most 3 per alert type, then at most 5 per message, by severity,
    metric, type order and rank within the type."""
    per_type = balanced.where(F.col("type_rank") <= C.DIGEST_MAX_PER_GROUP)
    order = [severity_rank("severity"), F.col("metric_value").desc()]
    t_ord = F.lit(len(C.ALERT_TYPE_ORDER))
    for i, t in reversed(list(enumerate(C.ALERT_TYPE_ORDER))):
        t_ord = F.when(F.col("alert_type") == t, F.lit(i)).otherwise(t_ord)
    # at most 9 rows reach this window
    w = Window.orderBy(*order, t_ord, F.col("type_rank"))
    return per_type.withColumn("message_rank", F.row_number().over(w)).where(
        F.col("message_rank") <= C.DIGEST_MAX_PER_MESSAGE)


def indian_amounts(credit: DataFrame) -> DataFrame:
    """Overdue amounts with Indian digit groups and dates as '%d %b %Y'."""
    return credit.select("customer_id", "total_overdue_amount",
                         F.concat(F.lit(C.RUPEE), indian_grouping(F.col("total_overdue_amount"))).alias("amount_text"),
                         F.date_format("oldest_unpaid_date", "dd MMM yyyy").alias("oldest_unpaid_text"))


def impute_cost(sales: DataFrame, enabled: bool = True) -> DataFrame:
    """cost = price x 0.8 where the export has none (a configuration comment),
    behind a switch; margin recomputed from the imputed cost."""
    if not enabled:
        return sales
    cost = F.coalesce(F.col("cost_price"), (F.col("unit_price") * F.lit(C.COST_IMPUTE_FACTOR)).cast("decimal(18,4)"))
    margin = F.col("unit_price") - cost
    return sales.withColumns({
        "cost_imputed": F.col("cost_price").isNull(),
        "cost_price": cost,
        "unit_margin": margin,
        "margin_percentage": F.when(F.col("unit_price") > 0, exact_ratio(margin, F.col("unit_price")))
                              .otherwise(F.lit(0).cast(MARGIN_TYPE)),
    })
