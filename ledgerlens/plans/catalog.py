"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

Every query reads the test tables (or data Spark derives from them) in full.
Columns that carry wall-clock time (loaded_at, created_at, timestamp) are left
out so results are repeatable.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.config import DEFAULT
from ledgerlens.operators import alerts as A
from ledgerlens.operators import marts as M
from ledgerlens.operators import metrics as X
from ledgerlens.plans.jobs import enriched, shared_staging, staging_from_fixture
from ledgerlens.sources import fixture

P = DEFAULT
Query = Callable[[SparkSession, str], DataFrame]


def _stg(spark, sf):
    return shared_staging(spark, sf, P)


def _alerts(spark, sf):
    stg = _stg(spark, sf)
    return A.all_alerts(
        A.credit_risk_alerts(M.credit_risk(stg, P, False), P, False),
        A.dead_stock_alerts(M.dead_stock(stg, P, False), P, False),
        A.low_margin_alerts(M.low_margin(stg, P, False), P, False),
    )


def _balanced(spark, sf):
    return A.balanced_alerts(_alerts(spark, sf), P)


def _inventory(spark, sf):
    return fixture.inventory_snapshot(spark, sf, P)


def _alerts_missing_mart(spark, sf):
    """Marts saved as tables, the low-margin table left out: its alerts are
    empty and the other two types still come through."""
    from ledgerlens.plans.jobs import alerts_from_tables
    from ledgerlens.session import shared_path
    from ledgerlens.sources.tables import load_table
    stg = _stg(spark, sf)
    prefix = "ll_mart_"
    loc = shared_path(spark, "marts")
    for name, mart in (("credit_risk", M.credit_risk(stg, P)), ("dead_stock", M.dead_stock(stg, P))):
        if not load_table(mart, prefix + name, path=f"{loc}/{name}"):
            raise RuntimeError(f"mart {name} was not saved")
    spark.sql(f"DROP TABLE IF EXISTS {prefix}low_margin_sales")
    return alerts_from_tables(spark, P, prefix=prefix, with_timestamp=False)


def _digest_empty(spark, sf):
    """The digest of marts in which nothing reaches a threshold: the whole plan
    runs over the tables and gives the no-alert text."""
    p = replace(P, dead_stock_days=10 ** 6, credit_risk_days=10 ** 6, low_margin_threshold=Decimal(-10 ** 6))
    stg = _stg(spark, sf)
    none = A.all_alerts(A.credit_risk_alerts(M.credit_risk(stg, p, False), p, False),
                        A.dead_stock_alerts(M.dead_stock(stg, p, False), p, False),
                        A.low_margin_alerts(M.low_margin(stg, p, False), p, False))
    return A.daily_digest(spark, A.balanced_alerts(none, p), p)


CORE: dict[str, Query] = {
    "inventory_snapshot": _inventory,
    "alerts_missing_mart": _alerts_missing_mart,
    "daily_digest_empty": _digest_empty,
    "raw_sales": lambda s, sf: fixture.raw_sales(s, sf),
    "staging": lambda s, sf: staging_from_fixture(s, sf, P),
    "customer_metrics": lambda s, sf: X.customer_metrics(_stg(s, sf), P),
    "product_metrics": lambda s, sf: X.product_metrics(_stg(s, sf), P),
    "sales_enriched": lambda s, sf: enriched(s, _stg(s, sf), P),
    "mart_dead_stock": lambda s, sf: M.dead_stock(_stg(s, sf), P, False),
    "mart_low_margin": lambda s, sf: M.low_margin(_stg(s, sf), P, False),
    "mart_credit_risk": lambda s, sf: M.credit_risk(_stg(s, sf), P, False),
    "alerts_dead_stock": lambda s, sf: A.dead_stock_alerts(M.dead_stock(_stg(s, sf), P, False), P, False),
    "alerts_low_margin": lambda s, sf: A.low_margin_alerts(M.low_margin(_stg(s, sf), P, False), P, False),
    "alerts_credit_risk": lambda s, sf: A.credit_risk_alerts(M.credit_risk(_stg(s, sf), P, False), P, False),
    "all_alerts": _alerts,
    "balanced_alerts": _balanced,
    "alert_counts": lambda s, sf: A.alert_counts(_balanced(s, sf)),
    "digest_lines": lambda s, sf: A.digest_lines(_balanced(s, sf), P),
    "daily_digest": lambda s, sf: A.daily_digest(s, _balanced(s, sf), P),
}


def queries() -> dict[str, Query]:
    out = dict(CORE)
    for mod in _extensions():
        out.update(mod.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    from ledgerlens.plans import oracle
    out = oracle.queries()
    for mod in _extensions():
        out.update(getattr(mod, "ORACLE", {}))
    return {k: v for k, v in out.items() if k in queries()}


def _extensions():
    mods = []
    for name in ("ledgerlens.plans.catalog_ingest", "ledgerlens.plans.catalog_rules", "ledgerlens.plans.catalog_tables",
                 "ledgerlens.plans.catalog_stream"):
        try:
            mods.append(__import__(name, fromlist=["QUERIES"]))
        except ModuleNotFoundError as e:
            if e.name != name:
                raise
    return mods
