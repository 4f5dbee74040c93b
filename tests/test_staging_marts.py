import datetime as dt
import shutil
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerlens.config import Params
from ledgerlens.operators import marts as M
from ledgerlens.operators import metrics as X
from ledgerlens.operators.staging import stage_sales
from ledgerlens.plans import jobs

AS_OF = dt.date(2024, 6, 30)
P = Params(as_of=AS_OF)
RAW = ("invoice_number string, transaction_date string, customer_name string, product_name string, "
       "quantity decimal(18,4), unit_price decimal(18,4), cost_price decimal(18,4), total_amount decimal(18,4), "
       "payment_status string, payment_due_date string")


def day(n):
    return (AS_OF - dt.timedelta(days=n)).isoformat()


def row(inv, days_ago, cust="C", prod="P", qty=1, price=100, cost=50, total=None, status="Paid", due=None):
    price = None if price is None else D(str(price))
    cost = None if cost is None else D(str(cost))
    total = D(str(total)) if total is not None else (D(str(qty)) * (price or D(1)))
    return (str(inv), day(days_ago), cust, prod, D(str(qty)), price, cost, total, status, due)


def stage(spark, rows):
    return stage_sales(spark.createDataFrame(rows, RAW), P, with_loaded_at=False)


def test_staging_trims_unicode_whitespace_and_keeps_raw_ids(spark):
    rows = [row(1, 1, cust="\tAb "), row(2, 1, cust="ab "), row(3, 1, cust=None)]
    out = {r.transaction_id: r for r in stage(spark, rows).collect()}
    assert out["1"].customer_name == "AB" and out["1"].customer_id == "\tAb "
    assert out["2"].customer_name == "AB" and out["2"].customer_id == "ab "   # two ids, one display name
    assert out["3"].customer_name is None


def test_staging_filter_and_margins(spark):
    rows = [row(1, 1, qty=0), row(2, 1, total=0), row(3, 1, price=0, cost=10), row(4, 1, price=None, cost=10),
            row(5, 1, price=80, cost=None), row(6, 1, price=100, cost=110)]
    rows.append(("7", None, "C", "P", D(1), D(1), D(1), D(1), "Paid", None))
    out = {r.transaction_id: r for r in stage(spark, rows).collect()}
    assert set(out) == {"3", "4", "5", "6"}                       # qty 0, total 0, null date dropped
    assert out["3"].margin_percentage == 0                           # price 0 -> margin 0
    assert out["4"].margin_percentage == 0                           # null price -> 0
    assert out["5"].margin_percentage == 1                           # null cost counts as 0 -> 100 %
    assert out["6"].margin_percentage == D("-0.1")


def test_payment_status_and_overdue_days(spark):
    rows = [row(1, 40, status=None, due=day(20)), row(2, 40, status="", due=day(20)),
            row(3, 40, status=" paid ", due=day(20)), row(4, 40, status="PARTIAL", due=None),
            row(5, 40, status="Partial", due="2024-02-30"), row(6, 40, status="Partial", due=day(-5))]
    out = {r.transaction_id: r for r in stage(spark, rows).collect()}
    assert (out["1"].payment_status, out["1"].days_overdue) == ("UNPAID", 20)
    assert (out["2"].payment_status, out["2"].days_overdue) == ("", 20)   # empty is not replaced
    assert (out["3"].payment_status, out["3"].days_overdue) == ("PAID", 0)
    assert out["4"].days_overdue is None and out["5"].days_overdue is None  # missing / invalid due date
    assert out["6"].days_overdue == -5                                   # not yet due


def test_dead_stock_thresholds(spark):
    days = [89, 90, 119, 120, 179, 180]
    rows = [row(i, d, prod=f"P{d}") for i, d in enumerate(days)]
    out = {r.product_id: r for r in M.dead_stock(stage(spark, rows), P, False).collect()}
    assert "P89" not in out
    sev = {k: v.alert_severity for k, v in out.items()}
    assert sev == {"P90": "MEDIUM", "P119": "MEDIUM", "P120": "HIGH", "P179": "HIGH",
                   "P180": "CRITICAL"}
    assert out["P90"].estimated_value_locked == D("400.00")            # qty 1 * 0.1 * 4000


def test_dead_stock_normal_action_with_lower_parameter(spark):
    p = Params(as_of=AS_OF, dead_stock_days=60)
    df = M.dead_stock(stage(spark, [row(1, 70, prod="A")]), p, False).collect()
    assert df[0].alert_severity == "MEDIUM" and df[0].recommended_action.startswith("Normal")


def test_low_margin_thresholds(spark):
    # margins -0.01, 0, 0.0499, 0.05, 0.0999, 0.10 via price 10000 and cost
    costs = {"m-0.01": 10100, "m0": 10000, "m0.0499": 9501, "m0.05": 9500, "m0.0999": 9001, "m0.10": 9000}
    rows = [row(i, 5, prod=k, price=10000, cost=c) for i, (k, c) in enumerate(costs.items())]
    rows.append(row(99, 5, prod="nocost", price=10000, cost=None))
    rows.append(row(98, 120, prod="old", price=10000, cost=10100))    # outside 90 days
    out = {r.product_id: r for r in M.low_margin(stage(spark, rows), P, False).collect()}
    assert set(out) == {"m-0.01", "m0", "m0.0499", "m0.05", "m0.0999"}
    assert out["m-0.01"].alert_severity == "CRITICAL"
    assert out["m-0.01"].probable_cause == "Selling below cost price"
    assert out["m0"].alert_severity == "HIGH" and out["m0.0499"].alert_severity == "HIGH"
    assert out["m0.05"].alert_severity == "MEDIUM" and out["m0.0999"].alert_severity == "MEDIUM"
    assert out["m0.05"].margin_gap_vs_target == D("500")              # 0.10*10000 - 500


def test_credit_risk_edges(spark):
    # one customer per overdue age; C61 twice with amounts at the critical boundary
    rows = []
    for i, d in enumerate([14, 15, 16, 30, 31, 60, 61, 90, 91]):
        rows.append(row(i, 200, cust=f"C{d}", status="Unpaid", due=day(d), total=10))
    rows.append(row(100, 200, cust="BIG0", status="Unpaid", due=day(61), qty=1, price=100000, total=100000))
    rows.append(row(101, 200, cust="BIG1", status="Unpaid", due=day(61), qty=1, price=100000, total="100000.01"))
    rows.append(row(102, 200, cust="MULTI", status="Unpaid", due=day(20), total=5))
    rows.append(row(102, 200, cust="MULTI", status="Unpaid", due=day(20), total=5))
    out = {r.customer_id: r for r in M.credit_risk(stage(spark, rows), P, False).collect()}
    assert "C14" not in out
    sev = {k: (v.alert_severity, v.payment_score) for k, v in out.items()}
    assert sev["C15"] == ("INFO", 100)
    assert sev["C16"] == ("LOW", 75)
    assert sev["C30"] == ("LOW", 75) and sev["C31"] == ("MEDIUM", 50)
    assert sev["C60"] == ("MEDIUM", 50) and sev["C61"] == ("HIGH", 25)
    assert sev["C90"] == ("HIGH", 25) and sev["C91"] == ("CRITICAL", 0)
    assert sev["BIG0"] == ("HIGH", 25) and sev["BIG1"] == ("CRITICAL", 25)
    assert out["MULTI"].overdue_invoice_count == 1                     # distinct invoices
    assert out["MULTI"].overdue_invoice_ids == "102, 102"              # list is not distinct


def test_credit_ids_ordered_by_date_then_id(spark):
    rows = [row(30, 10, cust="X", status="Unpaid", due=day(40)), row(20, 50, cust="X", status="Unpaid", due=day(40)),
            row(10, 10, cust="X", status="Unpaid", due=day(40))]
    out = M.credit_risk(stage(spark, rows), P, False).collect()[0]
    assert out.overdue_invoice_ids == "20, 10, 30"
    assert out.oldest_unpaid_date == AS_OF - dt.timedelta(days=50)


def test_risk_share_uses_staged_lines_only(spark):
    rows = [row(1, 100, cust="Z", status="Unpaid", due=day(40), total=10),
            row(2, 100, cust="Z", status="Paid", total=-10)]                 # dropped by the staging filter
    out = M.credit_risk(stage(spark, rows), P, False).collect()[0]
    assert out.risk_percentage_of_ltv == D("100.00")


def test_enriched_keeps_every_line(spark):
    rows = [row(i, i, cust=f"C{i % 3}", prod=f"P{i % 4}") for i in range(1, 25)] + [row(99, 1, cust=None)]
    stg = stage(spark, rows)
    enr = X.enrich_sales(stg, P)
    assert enr.count() == stg.count()
    nulls = enr.where("customer_id IS NULL").collect()[0]
    assert nulls.customer_lifetime_value is None                      # null ids match nothing


def test_text_columns_stage_like_numbers(spark):
    text = spark.createDataFrame([("1", day(1), "C", "P", "12.5", "10", None, "125", "Paid", None)],
                                 ", ".join(f"{c.split()[0]} string" for c in RAW.split(", ")))
    out = stage_sales(text, P, with_loaded_at=False).collect()
    assert len(out) == 1 and out[0].quantity == D("12.5")


def test_materialized_marts_equal_lazy(spark, sf):
    from ledgerlens.config import DEFAULT
    from ledgerlens.plans import jobs
    from ledgerlens.sources import fixture
    raw = fixture.raw_sales(spark, sf)
    lazy = jobs.build_marts(spark, raw, DEFAULT, materialize=None, with_created_at=False)
    table = jobs.build_marts(spark, raw, DEFAULT, materialize="table", with_created_at=False)
    for name in ("dead_stock", "low_margin", "credit_risk"):
        a, b = getattr(lazy, name), getattr(table, name)
        assert a.count() == b.count()
        assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_exact_ratio_ties_agree_with_duckdb_helper(spark):
    import duckdb
    from ledgerlens.functions.columns import exact_ratio
    from ledgerlens.plans.oracle import div9
    pairs = [("1", "1024"), ("-1", "1024"), ("1", "3"), ("2", "3"), ("-2", "3"), ("1234.5678", "0.0001"),
             ("0.0001", "8"), ("-0.0005", "2048"), ("99999.9999", "7")]
    df = spark.createDataFrame([(D(a), D(b)) for a, b in pairs], "a decimal(18,4), b decimal(18,4)")
    got = [r.q for r in df.select(exact_ratio(F.col("a"), F.col("b")).alias("q")).collect()]
    con = duckdb.connect()
    want = [con.sql(f"SELECT {div9(f'CAST({a} AS DECIMAL(18,4))', f'CAST({b} AS DECIMAL(18,4))')}").fetchall()[0][0]
            for a, b in pairs]
    assert got == want
    assert got[0] == D("0.000976563") and got[1] == D("-0.000976563")     # ties round away from zero


def test_staging_code_is_small_enough_to_be_compiled(spark, sf):
    """The JVM does not compile methods of more than 8,000 bytes: a staging projection beyond that runs several times slower."""
    import contextlib
    import io
    import re

    from ledgerlens.operators.staging import stage_sales
    from ledgerlens.sources import fixture
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    said = io.StringIO()
    try:
        with contextlib.redirect_stdout(said):
            stage_sales(fixture.raw_sales(spark, sf), with_loaded_at=False).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:([0-9]+)", said.getvalue())]
    assert sizes and max(sizes) < 8000


def test_month_names(spark):
    from pyspark.sql import functions as F

    from ledgerlens.functions.columns import month_name
    d = F.make_date(F.lit(2024), F.col("id").cast("int"), F.lit(1))
    assert spark.range(1, 13).where(month_name(d) != F.date_format(d, "MMMM")).isEmpty()
    assert spark.range(1).select(month_name(F.lit(None).cast("date"))).first()[0] is None


def test_shared_staging_follows_changed_tables(spark, sf, tmp_path):
    for t in jobs.STAGED_TABLES:
        shutil.copyfile(f"{sf}/{t}.parquet", tmp_path / f"{t}.parquet")
    first = jobs.shared_staging(spark, str(tmp_path))
    assert jobs.shared_staging(spark, f"{tmp_path}/") is first
    half = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_orderkey % 2 = 0")
    half.coalesce(1).write.parquet(str(tmp_path / "half"))
    (file,) = (tmp_path / "half").glob("*.parquet")
    shutil.copyfile(file, tmp_path / "lineitem.parquet")
    spark.catalog.refreshByPath(str(tmp_path))
    changed = jobs.shared_staging(spark, str(tmp_path))
    expected = jobs.staging_from_fixture(spark, str(tmp_path)).count()
    assert changed is not first and 0 < changed.count() == expected < first.count()
    assert jobs.shared_staging(spark, str(tmp_path)) is changed


def test_narrow_rows_are_shuffled_by_month(spark, sf):
    """Derived columns are made after the rows of a month are brought together."""
    stg = jobs.staging_from_fixture(spark, sf, by_month=True)
    plan = stg._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RebalancePartitions"):]
    assert "margin_percentage" not in below and "days_overdue" not in below and "margin_percentage" in plan
    assert stg.exceptAll(jobs.staging_from_fixture(spark, sf)).isEmpty() and stg.count() == jobs.staging_from_fixture(spark, sf).count()


def test_appended_rows_are_not_cleaned_again(spark, sf, monkeypatch):
    from ledgerlens.plans import catalog_ingest as I
    sources = []
    load = I.tables.load_table

    def loaded(df, name, how="replace", **kw):
        sources.append(df._jdf.queryExecution().optimizedPlan().toString())
        return load(df, name, how, **kw)
    monkeypatch.setattr(I.tables, "load_table", loaded)
    out = I.load_replace_append(spark, sf, "ll_sales_once")
    assert out.count() == 2 * I.clean_sales(spark, sf).count() and out.where("NOT load_ok").isEmpty()
    assert "csv" in sources[0] and "csv" not in sources[1]
