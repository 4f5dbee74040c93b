import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.config import Params
from ledgerlens.operators import alerts as A
from ledgerlens.plans import jobs

P = Params(as_of=dt.date(2024, 6, 30), business_name="ABC")
SCHEMA = A.ALERT_SCHEMA


def alerts(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_balanced_top5_ties_keep_fetch_order(spark):
    rows = [("DEAD_STOCK", "HIGH", f"p{i}", 130.0, 0.0, "m", "a", i) for i in range(1, 7)]
    rows.append(("DEAD_STOCK", "CRITICAL", "px", 100.0, 0.0, "m", "a", 7))
    out = A.balanced_alerts(alerts(spark, rows), P).orderBy("type_rank").collect()
    assert [r.entity for r in out] == ["px", "p1", "p2", "p3", "p4"]


def test_low_margin_higher_margin_first_within_severity(spark):
    rows = [("LOW_MARGIN", "CRITICAL", "a", -50.0, 0.0, "m", "x", 1),
            ("LOW_MARGIN", "CRITICAL", "b", -5.0, 0.0, "m", "x", 2)]
    out = A.balanced_alerts(alerts(spark, rows), P).orderBy("type_rank").collect()
    assert [r.entity for r in out] == ["b", "a"]
    worst = A.balanced_alerts(alerts(spark, rows), Params(worst_first=True)).orderBy("type_rank").collect()
    assert [r.entity for r in worst] == ["a", "b"]


def test_digest_sections_and_missing_type(spark):
    rows = [("CREDIT_RISK", "CRITICAL", "ACME", 123456.5, 0.0, "m", "Stop", 1),
            ("LOW_MARGIN", "HIGH", None, 2.25, 0.0, "m", "Cause", 1)]
    bal = A.balanced_alerts(alerts(spark, rows), P)
    text = A.daily_digest(spark, bal, P).collect()[0].digest
    assert text.startswith("🚨 *ABC - Daily Alert*\n📅 30 Jun 2024, 09:00 AM\n\n⚠️ *ACTION REQUIRED*\n\n")
    assert "💳 *OVERDUE PAYMENTS*\n🔴 1. ACME\n   └ Owes: ₹123,456\n   └ Stop\n" in text   # half-even like Python
    assert "📦" not in text                                         # no dead-stock section
    assert "🟠 1. None\n   └ Margin: 2.2%\n   └ Cause" in text
    assert text.endswith("\n---\n💬 Reply HELP for support")


def test_no_alerts_text(spark):
    bal = A.balanced_alerts(A.empty_alerts(spark, False).drop("timestamp"), P)
    text = A.daily_digest(spark, bal, P).collect()[0].digest
    assert text == "✅ *ABC - Daily Report*\n\nNo critical issues today!\nAll systems running smoothly 🎉"


def test_missing_mart_table_gives_no_alerts(spark):
    out = jobs.alerts_from_tables(spark, P, prefix="no_such_mart_", with_timestamp=False)
    assert out.count() == 0


def test_daily_run_over_fixture_at_most_five_per_type(spark, sf):
    from ledgerlens.sources import fixture
    digest = jobs.run(spark, fixture.raw_sales(spark, sf), Params(), materialize="persist")
    assert digest.count() == 1
    from ledgerlens.plans.catalog import queries
    bal = queries()["balanced_alerts"](spark, sf)
    per = {r.alert_type: r["count"] for r in bal.groupBy("alert_type").count().collect()}
    assert per and all(v <= 5 for v in per.values())
