"""Registered streaming query: critical alerts from a file stream of sale lines."""

from __future__ import annotations

from ledgerlens.config import DEFAULT
from ledgerlens.plans import oracle as O
from ledgerlens.session import shared_path
from ledgerlens.streaming import critical, entities

P = DEFAULT


def stream_critical_alerts(spark, sf):
    """availableNow run over the lineitem file(s); the result is read back from the sink."""
    return critical.read_alerts(spark, critical.run_available_now(spark, sf, P))


def stream_entity_alerts(spark, sf):
    """Critical customers and products: the alerts that stand after an availableNow
    run over the lines, in micro-batches of one file."""
    out = shared_path(spark, "entity-alerts")
    critical.run_available_now(spark, sf, P, max_files_per_trigger=1, entities_path=out)
    return entities.standing_alerts(spark, out)


QUERIES = {"stream_critical_alerts": stream_critical_alerts, "stream_entity_alerts": stream_entity_alerts}

ORACLE = {
    "stream_critical_alerts": O.with_(O.BASE, """SELECT transaction_id, transaction_date, customer_id,
  customer_name, product_id, quantity, unit_price, cost_price, margin_percentage,
  'CRITICAL' AS alert_severity, 'URGENT: Review pricing. Currently making loss!' AS recommended_action
FROM stg WHERE margin_percentage < 0 AND cost_price IS NOT NULL"""),
    "stream_entity_alerts": O.with_(O.MARTS, f"""SELECT 'CREDIT_RISK' AS alert_type, customer_id AS entity_id, customer_name AS entity_name,
  total_overdue_amount AS amount, max_days_overdue AS days, oldest_unpaid_date AS first_date, recommended_action, {O.AS_OF} AS as_of
FROM credit WHERE alert_severity = 'CRITICAL'
UNION ALL SELECT 'DEAD_STOCK', product_id, product_name, total_quantity_ever_sold, days_since_last_sale, last_sale_date, recommended_action, {O.AS_OF}
FROM dead WHERE alert_severity = 'CRITICAL'"""),
}
