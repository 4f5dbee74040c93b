import dataclasses
import datetime as dt
import json
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.config import Params
from ledgerlens.functions.columns import indian_grouping
from ledgerlens.operators import rules as R

P = Params(as_of=dt.date(2024, 6, 30))
INV = "product_id string, snapshot_date date, quantity_on_hand decimal(18,4), reorder_level decimal(18,4), last_sale_date date"


def test_indian_grouping(spark):
    vals = [D("100000"), D("12345678"), D("999"), D("1000"), D("-250000.5"), D("0.4")]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(18,4)")
    got = [r.y for r in df.select(indian_grouping(F.col("x")).alias("y")).collect()]
    assert got == ["1,00,000", "1,23,45,678", "999", "1,000", "-2,50,001", "0"]


def test_inventory_rules_and_stock_out(spark):
    snap = dt.date(2024, 6, 30)
    rows = [("neg", snap, D(-1), D(10), snap), ("late", snap, D(5), D(10), dt.date(2024, 7, 2)),
            ("eq", snap, D(10), D(10), snap), ("ok", snap, D(50), D(10), snap),
            ("ok", dt.date(2024, 5, 1), D(0), D(10), dt.date(2024, 4, 1))]   # older snapshot of "ok"
    inv = spark.createDataFrame(rows, INV)
    counts = {r.rule: r.failures for r in R.rule_counts(inv, R.inventory_rule_checks(), "inventory").collect()}
    assert counts == {"quantity_on_hand must be >= 0": 1, "last_sale_date should not be after snapshot_date": 1}
    out = sorted(r.product_id for r in R.stock_out(inv).collect())
    assert out == ["eq", "late", "neg"]                                 # latest "ok" snapshot has 50 on hand


def test_condition_columns_and_templates(spark):
    df = spark.createDataFrame([(" paid ", 20), ("Unpaid", 20), ("Unpaid", 10)], "payment_status string, days_overdue int")
    got = [r.m for r in df.select(R.rule_filter(R.rule("credit_risk")).alias("m")).collect()]
    assert got == [False, True, False]
    t = R.render_template("{customer_name}: ₹{amount} payment pending",
                          {"customer_name": F.lit("ACME"), "amount": F.lit("1,00,000")})
    assert spark.range(1).select(t.alias("t")).first().t == "ACME: ₹1,00,000 payment pending"


def test_credit_ladder_critical_needs_days_and_amount(spark):
    r = R.rule("credit_risk")
    df = spark.createDataFrame([(95, D(100000)), (95, D(99999)), (61, D(500000)), (15, D(1))],
                               "days_overdue int, total_overdue_amount decimal(18,4)")
    got = [x.s for x in df.select(R.severity_column(r, "total_overdue_amount").alias("s")).collect()]
    assert got == ["CRITICAL", "HIGH", "HIGH", "LOW"]


def test_turnover_is_mean_gap(spark):
    rows = [("a", "Motor", dt.date(2024, 1, 1)), ("a", "Motor", dt.date(2024, 1, 11)),
            ("a", "Motor", dt.date(2024, 3, 1)), ("b", "X", dt.date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "product_id string, product_category string, transaction_date date")
    out = {r.product_id: r for r in R.turnover(df, P).collect()}
    assert out["a"].avg_days_between_sales == 30.0 and out["a"].target_days == 40
    assert out["b"].avg_days_between_sales is None and out["b"].target_days == 60


def test_config_ladders_match_marts():
    dead = R.rule("dead_stock")
    assert [lv.threshold for lv in dead.levels] == [C.DEAD_CRITICAL_DAYS, C.DEAD_HIGH_DAYS, 90]


def test_margin_bands_category_and_default(spark):
    rows = [("Motor", D("0.11")), ("Motor", D("0.07")), ("Motor", D("0.05")), ("Other", D("0.15")),
            ("Other", D("0.12")), ("Other", D("0.01"))]
    df = spark.createDataFrame(rows, "product_category string, margin_percentage decimal(28,9)")
    got = [r.margin_band for r in R.margin_bands(df, spark).collect()]
    # Motor: target 0.10, minimum 0.06; others: 0.15 / 0.10; below 0.05 critical
    assert got == ["healthy", "acceptable", "below_minimum", "healthy", "acceptable", "critical"]


def test_credit_terms_fallback_due_date(spark):
    rows = [("1", "P", "C", dt.date(2024, 5, 1), None, "UNPAID"),
            ("2", "P", "C", dt.date(2024, 6, 20), dt.date(2024, 6, 25), "UNPAID"),
            ("3", "P", "C", dt.date(2024, 1, 1), None, "PAID")]
    df = spark.createDataFrame(rows, "transaction_id string, product_id string, customer_id string, "
                                     "transaction_date date, payment_due_date date, payment_status string")
    out = {r.transaction_id: r for r in R.credit_terms(df, P).collect()}
    assert out["1"].effective_due_date == dt.date(2024, 5, 31) and out["1"].days_past_due == 30
    assert out["1"].overdue and not out["1"].critical and out["1"].beyond_max_period
    assert out["2"].days_past_due == 5 and not out["2"].overdue
    assert out["3"].days_past_due is None and not out["3"].overdue


def test_credit_score_bounds(spark, sf):
    from ledgerlens.plans.catalog import queries
    rows = queries()["credit_score"](spark, sf).collect()
    assert rows and all(0.0 <= r.credit_score <= 100.0 for r in rows)
    assert all(0.0 <= r.payment_history <= 1.0 and 0.0 <= r.customer_tenure <= 1.0 for r in rows)


def test_digest_caps(spark, sf):
    from ledgerlens.plans.catalog import queries
    rows = queries()["digest_capped"](spark, sf).collect()
    assert len(rows) <= C.DIGEST_MAX_PER_MESSAGE
    assert all(r.type_rank <= C.DIGEST_MAX_PER_GROUP for r in rows)
    assert sorted(r.message_rank for r in rows) == list(range(1, len(rows) + 1))


def test_inventory_headers_map(spark):
    from ledgerlens.operators import mapping as MP
    t, _, unmatched = MP.plan_columns(["StockItemName", "ClosingBalance"], "tally", entity="inventory")
    assert t == {"StockItemName": ["product_name"], "ClosingBalance": ["quantity_on_hand"]} and not unmatched
    heads = MP.header_frame(spark, {"inv": ["ItemCode", "ItemName", "StockQty", "LastSaleDate"]})
    best = MP.detect_source(heads, MP.mapping_frame(spark, "inventory")).collect()[0]
    assert best.system == "gofrugal" and best.matches == 4 and best.confidence == 1.0


def test_indian_grouping_spark_and_duckdb_agree(spark):
    import duckdb
    from ledgerlens.plans.catalog_rules import indian_sql
    vals = ["0", "7", "999", "1000", "99999", "100000", "1234567", "12345678", "123456789012", "-5", "-1000",
            "-250000.5", "1234.4999", "0.5"]
    df = spark.createDataFrame([(D(v),) for v in vals], "x decimal(18,4)")
    got = [r.y for r in df.select(indian_grouping(F.col("x")).alias("y")).collect()]
    con = duckdb.connect()
    want = [con.sql(f"SELECT {indian_sql(f'CAST({v} AS DECIMAL(18,4))')}").fetchall()[0][0] for v in vals]
    assert got == want
    assert got[5] == "1,00,000" and got[8] == "1,23,45,67,89,012"


def test_a_fifth_rule_by_file_only(spark, tmp_path):
    import json
    import os

    from ledgerlens import config as C
    shipped = os.path.join(os.path.dirname(C.__file__), "conf", "alert_rules.json")
    declared = json.load(open(shipped, encoding="utf-8"))
    declared["rules"].append({
        "name": "big_bill", "enabled": True, "frame": "lines", "key": ["transaction_id"], "metric": "total_amount",
        "conditions": [{"field": "total_amount", "operator": ">=", "value": 100.5}, {"field": "payment_status", "operator": "==", "value": "unpaid"}],
        "values": {"who": ["customer_name"], "amount": ["total_amount", "indian"]},
        "levels": [{"name": "critical", "threshold": 200000, "message": "{who}: ₹{amount}", "action": "Call"},
                   {"name": "low", "threshold": 100.5, "message": "{who} {amount}", "action": "Watch"}]})
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(declared, ensure_ascii=False), encoding="utf-8")
    rules = [r for r in C.load_rules(str(path)) if r.name == "big_bill"]
    lines = spark.createDataFrame([("1", "A", 250000.0, " Unpaid "), ("2", "B", 100.5, "UNPAID"), ("3", "C", 300000.0, "PAID"), ("4", "D", 99.0, "UNPAID")],
                                  "transaction_id string, customer_name string, total_amount double, payment_status string")
    got = sorted(map(tuple, R.compiled(rules, {"lines": lines}).collect()))
    assert got == [("big_bill", "1", "CRITICAL", "A: ₹2,50,000", "Call"), ("big_bill", "2", "LOW", "B " + got[1][3].split(" ", 1)[1], "Watch")]
    assert len(C.load_rules(str(path))) == len(C.ALERT_RULES) + 1


def test_faulty_rules_are_named_before_anything_runs(spark):
    from ledgerlens import config as C
    lines = spark.createDataFrame([], "id string, amount double, status string")
    bad = C.Rule("x", True, "status", (C.Condition("nowhere", ">=", 1), C.Condition("amount", "LIKE", "a"), C.Condition("amount", ">", "much")),
                 (C.Level("low", 1, "{who}", "a"), C.Level("grave", 5, "", "a", amount=3)), "up", "lines", "lines", ("key",), {"n": ("amount", "roman")})
    with pytest.raises(ValueError) as e:
        R.compiled([bad], {"lines": lines})
    for part in ("no column nowhere", "operator not allowed: LIKE", "'much' does not compare", "metric status is no number", "direction 'up'",
                 "no value for {who}", "level 'grave'", "amount without amount_field", "no format 'roman'", "no column key"):
        assert part in str(e.value), part
    assert R.faults(C.Rule("y", True, "amount", (), (), "ge", "other", "other"), {"lines": lines.schema}) == ["no frame 'other'"]
    assert all(r.frame and r.key for r in C.ALERT_RULES)


def test_an_industry_added_by_file_only(spark, tmp_path):
    with open(os.path.join(os.path.dirname(C.__file__), "conf", "benchmarks.json"), encoding="utf-8") as f:
        declared = json.load(f)
    declared["industries"]["paint"] = {
        "seasons": {"festive": {"months": [10, 11], "multiplier": 3}}, "margins": {"healthy": 0.3, "acceptable": 0.2, "critical": 0.1},
        "category_margins": {"Primer": [0.5, 0.4]}, "turnover_days": 20, "category_turnover_days": {"Primer": 10}, "slow_moving_days": 30,
        "credit_terms": {"standard_credit_period": 7, "maximum_credit_period": 9, "overdue_threshold": 1, "critical_overdue": 5}}
    path = tmp_path / "benchmarks.json"
    path.write_text(json.dumps(declared))
    found = C.load_benchmarks(str(path))
    assert {k: v for k, v in found.items() if k != "paint"} == C.BENCHMARKS
    paint = found["paint"]
    rows = [("t1", "Primer", "a", D("0.45")), ("t2", "Primer", "a", D("0.55")), ("t3", "Other", "b", D("0.25")),
            ("t4", "Motor", "c", D("0.05")), ("t5", None, "d", D("0.31")), ("t6", "Primer", "a", None)]
    df = spark.createDataFrame(rows, "transaction_id string, product_category string, product_id string, margin_percentage decimal(28,9)")
    got = {r.transaction_id: r.margin_band for r in R.margin_bands(df, spark, paint).collect()}
    assert got == {"t1": "acceptable", "t2": "healthy", "t3": "acceptable", "t4": "critical", "t5": "healthy", "t6": "critical"}
    bands = {tuple(r) for r in R.industry_bands(df, spark, {"paint": paint, "general": found["general_distributor"]}).collect()}
    assert {b for b in bands if b[0] == "paint"} == {
        ("paint", "Primer", "acceptable", 1), ("paint", "Primer", "healthy", 1), ("paint", "Primer", "critical", 1),
        ("paint", "Other", "acceptable", 1), ("paint", "Motor", "critical", 1), ("paint", None, "healthy", 1)}
    assert ("general", "Motor", "below_minimum", 1) in bands and sum(b[3] for b in bands) == 12
    sold = spark.createDataFrame([("a", "Primer", dt.date(2024, 1, 1)), ("b", "X", dt.date(2024, 1, 1))],
                                 "product_id string, product_category string, transaction_date date")
    assert {r.product_id: r.target_days for r in R.turnover(sold, P, paint).collect()} == {"a": 10, "b": 20}
    assert {r.transaction_month: r.season for r in R.season_table(spark, paint).collect()} == {10: "festive", 11: "festive"}


@pytest.mark.parametrize("change", [{"margins": {"healthy": D("0.1"), "acceptable": D("0.2"), "critical": D("0.05")}},
                                    {"margins": {"healthy": D("0.1")}},
                                    {"seasons": (("a", (1, 2), D(1)), ("b", (2,), D(1)))},
                                    {"seasons": (("a", (13,), D(1)),)},
                                    {"category_margins": {"x": (D("0.1"), D("0.2"))}},
                                    {"credit_score_weights": {"payment_history": D("0.5")}}])
def test_wrong_benchmarks_are_refused(change):
    with pytest.raises(ValueError):
        dataclasses.replace(C.PUMPS, **change)
