"""Alert rows from the marts, the balanced top-N per type, and the digest.

Every step here works on at most ``alerts_per_mart`` rows per mart: the top-k
fetch is a ``orderBy().limit()``, which Spark plans as TakeOrderedAndProject
(each task keeps its own k best, one task merges them), so the marts are never
sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ledgerlens import config as C
from ledgerlens.config import DEFAULT, Params
from ledgerlens.functions.columns import emoji_for, fmt_fixed, fmt_grouped, severity_rank

ALERT_SCHEMA = ("alert_type string, severity string, entity string, metric_value double, "
                "threshold double, message string, action string, fetch_rank int")
ALERT_COLUMNS = ("alert_type", "severity", "entity", "metric_value", "threshold", "message", "action")


def _py_str(c: Column) -> Column:
    """How Python's f-string shows a value that may be None."""
    return F.coalesce(c, F.lit("None"))


def _top(mart: DataFrame, order: list[Column], k: int) -> DataFrame:
    top = mart.where(F.col("alert_severity").isin(*C.ALERT_SEVERITIES)).orderBy(*order).limit(k)
    # k rows at most: numbering them in one partition is free
    return top.withColumn("fetch_rank", F.row_number().over(Window.orderBy(*order)).cast("int"))


def _alert_rows(df: DataFrame, alert_type: str, entity: Column, metric: Column, message: Column,
                action: Column, with_timestamp: bool) -> DataFrame:
    out = df.select(
        F.lit(alert_type).alias("alert_type"),
        F.col("alert_severity").alias("severity"),
        entity.alias("entity"),
        metric.alias("metric_value"),
        F.lit(0.0).alias("threshold"),
        message.alias("message"),
        action.alias("action"),
        F.col("fetch_rank"),
    )
    return out.withColumn("timestamp", F.current_timestamp()) if with_timestamp else out


def dead_stock_alerts(mart: DataFrame, p: Params = DEFAULT, with_timestamp: bool = True) -> DataFrame:
    top = _top(mart, [F.col("days_since_last_sale").desc(), F.col("product_name").asc_nulls_first(),
                      F.col("product_id").asc_nulls_first()], p.alerts_per_mart)
    metric = F.col("days_since_last_sale").cast("double")
    msg = F.concat(_py_str(F.col("product_name")), F.lit(" not sold for "),
                   metric.cast("bigint").cast("string"), F.lit(" days"))
    return _alert_rows(top, C.DEAD_STOCK, F.col("product_name"), metric, msg,
                       F.col("recommended_action"), with_timestamp)


def low_margin_alerts(mart: DataFrame, p: Params = DEFAULT, with_timestamp: bool = True) -> DataFrame:
    entity = F.concat(F.col("customer_name"), F.lit(" - "), F.col("product_name"))  # null if either is null
    top = _top(mart.withColumn("entity", entity),
               [F.col("margin_percentage").asc_nulls_first(), F.col("entity").asc_nulls_first(),
                F.col("alert_severity").asc_nulls_first(), F.col("probable_cause").asc_nulls_first()],
               p.alerts_per_mart)
    metric = (F.col("margin_percentage") * 100).cast("double")
    msg = F.concat(_py_str(F.col("entity")), F.lit(" has "), fmt_fixed(metric, 1), F.lit("% margin"))
    return _alert_rows(top, C.LOW_MARGIN, F.col("entity"), metric, msg, F.col("probable_cause"), with_timestamp)


def credit_risk_alerts(mart: DataFrame, p: Params = DEFAULT, with_timestamp: bool = True) -> DataFrame:
    top = _top(mart, [F.col("total_overdue_amount").desc(), F.col("customer_name").asc_nulls_first(),
                      F.col("customer_id").asc_nulls_first()], p.alerts_per_mart)
    metric = F.col("total_overdue_amount").cast("double")
    msg = F.concat(_py_str(F.col("customer_name")), F.lit(f" owes {C.RUPEE}"), fmt_grouped(metric, 0))
    return _alert_rows(top, C.CREDIT_RISK, F.col("customer_name"), metric, msg,
                       F.col("recommended_action"), with_timestamp)


def empty_alerts(spark: SparkSession, with_timestamp: bool = True) -> DataFrame:
    schema = ALERT_SCHEMA + (", timestamp timestamp" if with_timestamp else "")
    return spark.createDataFrame([], schema)


def safe_alerts(build, spark: SparkSession, with_timestamp: bool = True) -> DataFrame:
    """Per-mart isolation: a mart that cannot be read (missing table, bad
    schema) yields no alerts instead of failing the other two."""
    try:
        df = build()
        df.schema  # force analysis now, so a missing table fails here
        return df
    except AnalysisException:
        return empty_alerts(spark, with_timestamp)


def all_alerts(credit: DataFrame, dead: DataFrame, margin: DataFrame) -> DataFrame:
    """The three alert sets as one table of uniform rows."""
    return credit.unionByName(dead).unionByName(margin)


def balanced_alerts(alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Top ``alerts_per_type`` per alert type: severity rank, then metric
    descending, then the order the rows were fetched in (the reference's stable
    sort).  ``worst_first`` ranks the lowest margin first for low-margin rows.
    Adds ``type_rank`` (1-based)."""
    metric_key = F.col("metric_value").desc()
    if p.worst_first:
        metric_key = F.when(F.col("alert_type") == C.LOW_MARGIN, F.col("metric_value"))\
                      .otherwise(-F.col("metric_value")).asc()
    w = Window.partitionBy("alert_type").orderBy(severity_rank("severity"), metric_key, F.col("fetch_rank"))
    return (alerts.withColumn("type_rank", F.row_number().over(w))
                  .where(F.col("type_rank") <= p.alerts_per_type))


def fetch_counts(alerts: DataFrame) -> DataFrame:
    """(alert_type, rows_fetched): rows taken from each mart before balancing, with a
    line for a mart that gave none."""
    per = alerts.groupBy("alert_type").agg(F.count(F.lit(1)).alias("n"))
    types = alerts.sparkSession.createDataFrame([(t,) for t in C.ALERT_TYPE_ORDER], "type string")
    return types.join(per, F.col("type") == F.col("alert_type"), "left").select(
        F.col("type").alias("alert_type"), F.coalesce("n", F.lit(0)).alias("rows_fetched"))


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert_type").agg(F.count(F.lit(1)).alias("alert_count"))


def _type_order(c: Column) -> Column:
    expr = F.lit(len(C.ALERT_TYPE_ORDER))
    for i, t in reversed(list(enumerate(C.ALERT_TYPE_ORDER))):
        expr = F.when(c == t, F.lit(i)).otherwise(expr)
    return expr


def digest_lines(balanced: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """First ``digest_lines_per_type`` alerts of each type as digest entries."""
    rows = balanced.where(F.col("type_rank") <= p.digest_lines_per_type)
    metric = F.col("metric_value")
    detail = (F.when(F.col("alert_type") == C.CREDIT_RISK,
                     F.concat(F.lit(f"Owes: {C.RUPEE}"), fmt_grouped(metric, 0)))
               .when(F.col("alert_type") == C.DEAD_STOCK,
                     F.concat(F.lit("Not sold: "), metric.cast("bigint").cast("string"), F.lit(" days")))
               .otherwise(F.concat(F.lit("Margin: "), fmt_fixed(metric, 1), F.lit("%"))))
    line = F.concat(emoji_for("severity"), F.lit(" "), F.col("type_rank").cast("string"), F.lit(". "),
                    _py_str(F.col("entity")), F.lit("\n   └ "), detail, F.lit("\n   └ "),
                    _py_str(F.col("action")))
    return rows.select("alert_type", _type_order(F.col("alert_type")).alias("section_order"),
                       F.col("type_rank").alias("line_number"), line.alias("line"))


def daily_digest(spark: SparkSession, balanced: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """One row (business, digest): header, one section per alert type present
    (credit, dead stock, margin), footer; or the no-alert text."""
    lines = digest_lines(balanced, p)
    titles = spark.createDataFrame(
        [(t, i, C.SECTION_TITLES[t]) for i, t in enumerate(C.ALERT_TYPE_ORDER)],
        "alert_type string, section_order int, title string")
    # a section block: title, its lines, then an empty line
    sections = (lines.groupBy("alert_type", "section_order").agg(
        F.expr("listagg(line, '\n') WITHIN GROUP (ORDER BY line_number)").alias("body"))
        .join(titles.select("alert_type", "title"), "alert_type")
        .select("section_order", F.concat_ws("\n", "title", "body", F.lit("")).alias("block")))
    body = sections.agg(
        F.expr("listagg(block, '\n') WITHIN GROUP (ORDER BY section_order)").alias("sections"))
    # a timestamp without time zone: the text does not depend on the session zone
    when_txt = F.date_format(F.to_timestamp_ntz(F.lit(p.digest_ts().strftime("%Y-%m-%d %H:%M:%S"))),
                             "dd MMM yyyy, hh:mm a")
    header = F.concat_ws("\n", F.lit(C.DIGEST_HEADER.format(business=p.business_name)),
                         F.concat(F.lit("📅 "), when_txt), F.lit(""), F.lit(C.DIGEST_ACTION_LINE), F.lit(""))
    footer = F.lit("\n".join(C.DIGEST_FOOTER))
    text = F.when(F.col("sections").isNull(), F.lit(C.NO_ALERTS_TEXT.format(business=p.business_name))) \
            .otherwise(F.concat_ws("\n", header, F.col("sections"), footer))
    return body.select(F.lit(p.business_name).alias("business"), text.alias("digest"))
