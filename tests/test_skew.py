"""Hot keys: one customer with half of all lines, a null-id group with a
third of the rows.  Results are checked against a brute-force pandas
computation on the collected rows; plans are checked for partial aggregation
before the shuffle."""

import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from ledgerlens.config import DEFAULT
from ledgerlens.operators import cleaning as CL
from ledgerlens.operators import marts as M
from ledgerlens.operators.staging import stage_sales
from ledgerlens.sources import files, fixture


def hot_staging(spark, sf):
    raw = fixture.raw_sales(spark, sf)
    # every other order belongs to one customer
    raw = raw.withColumn("customer_name", F.when(F.col("invoice_number").cast("bigint") % 2 == 0,
                                                 F.lit("Customer#HOT")).otherwise(F.col("customer_name")))
    return stage_sales(raw, DEFAULT, with_loaded_at=False)


def test_credit_risk_with_hot_customer_matches_brute_force(spark, sf):
    stg = hot_staging(spark, sf)
    got = {r.customer_id: r for r in M.credit_risk(stg, DEFAULT, False).collect()}
    pdf = stg.toPandas()
    od = pdf[(pdf.payment_status != "PAID") & (pdf.days_overdue >= DEFAULT.credit_risk_days)]
    for cust, g in od.groupby("customer_id"):
        r = got[cust]
        g = g.sort_values(["transaction_date", "transaction_id"], kind="stable")
        assert r.overdue_invoice_count == g.transaction_id.nunique()
        assert r.total_overdue_amount == g.total_amount.sum()
        assert r.max_days_overdue == g.days_overdue.max()
        assert r.overdue_invoice_ids == ", ".join(g.transaction_id)
    assert len(got) == od.customer_id.nunique()
    hot = got["Customer#HOT"]
    assert hot.overdue_invoice_count > 5 * max(v.overdue_invoice_count for k, v in got.items() if k != "Customer#HOT")


def test_aggregates_are_partial_before_the_shuffle(spark, sf):
    plan = M.dead_stock(hot_staging(spark, sf), DEFAULT, False)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    ex = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(product_id" in l)
    # the operator under the product exchange is the partial (map-side) aggregate
    assert "partial_" in lines[ex + 1]


def test_keep_first_with_a_large_null_id_group(spark):
    d = tempfile.mkdtemp(prefix="ll-skew-")
    rows = ["BillNo,BillDate,CustomerName,ItemName,Qty,Rate,Amount"]
    for i in range(3000):
        bill = "" if i % 3 == 0 else str(i % 50)          # a third of the rows have no id
        rows.append(f"{bill},2024-03-01,C{i},P,1,10,10")
    with open(os.path.join(d, "export.csv"), "w") as f:
        f.write("\n".join(rows) + "\n")
    import datetime as dt
    from ledgerlens.config import Params
    c = CL.clean_export(files.read_csv(spark, d, "UTF-8"), "gofrugal", Params(as_of=dt.date(2024, 6, 30)),
                        collapse=False)
    firsts = c.tagged.where("_is_first").select("transaction_id", "customer_name").toPandas()
    # brute force: file order is line order in a single file
    src = pd.DataFrame([r.split(",") for r in rows[1:]], columns=rows[0].split(","))
    src["BillNo"] = src["BillNo"].replace("", None)
    want = src.drop_duplicates(subset=["BillNo"], keep="first")
    assert sorted(firsts.customer_name) == sorted(want.CustomerName)
    assert firsts.transaction_id.isna().sum() == 1
