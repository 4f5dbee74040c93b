import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlens.config import Params
from ledgerlens.operators import cleaning as CL
from ledgerlens.operators import mapping as MP
from ledgerlens.sources import files, landing

P = Params(as_of=dt.date(2024, 6, 30))


def write_text(text: str, encoding: str) -> str:
    d = tempfile.mkdtemp(prefix="ll-csv-")
    with open(os.path.join(d, "export.csv"), "wb") as f:
        f.write(text.encode(encoding))
    return d


def test_numbers(spark):
    vals = ["₹4,500.00", " 12 ", "1e3", "NaN", "abc", None, "0", "-1"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r.y for r in df.select(CL.to_number(F.col("x")).alias("y")).collect()]
    assert got == [4500.0, 12.0, 1000.0, None, None, None, 0.0, -1.0]


def test_dates_and_future_rows(spark):
    vals = ["2024-03-15", "15/03/2024", "2024-02-30", None, "2024-07-01"]
    df = spark.createDataFrame([(v,) for v in vals], "transaction_date string")
    got = [r.transaction_date for r in CL.clean_dates(df, p=P).collect()]
    assert got == ["2024-03-15", "2024-03-15", None, None]              # future row removed, nulls pass


def test_detect_and_fuzzy(spark):
    heads = {
        "g": ["BillNo", "BillDate", "CustomerCode", "CustomerName", "ItemCode", "ItemName", "Qty", "Rate",
              "CostPrice", "Amount", "GSTAmount", "PaymentStatus", "DueDate"],
        "t": ["VoucherNumber", "VoucherDate", "PartyName", "StockItemName", "Quantity", "Rate", "Amount", "TaxAmount"],
        "k": ["ORDERNUMBER", "ORDERDATE", "CUSTOMERNAME", "PRODUCTCODE", "PRODUCTLINE", "QUANTITYORDERED",
              "PRICEEACH", "SALES", "STATUS"],
        "none": ["foo", "bar"],
    }
    out = {r.file: r for r in MP.detect_source(MP.header_frame(spark, heads), MP.mapping_frame(spark)).collect()}
    assert out["g"].system == "gofrugal" and out["t"].system == "tally" and out["k"].system == "kaggle"
    assert out["none"].system == "gofrugal" and out["none"].matches == 0 and out["none"].low_confidence
    assert MP.token_sort_ratio("GSTAmount", "Amount") == 80
    assert MP.token_sort_ratio("CustomerCode", "CustomerName") == 75
    assert MP.token_sort_ratio("Qty", "Quantity") < 70
    # a missing GSTAmount steals Amount unless exact matches are protected
    cols = [c for c in heads["g"] if c != "GSTAmount"]
    t1, _, _ = MP.plan_columns(cols, "gofrugal")
    assert t1["Amount"] == ["tax_amount"]
    t2, _, _ = MP.plan_columns(cols, "gofrugal", exclude_exact=True)
    assert t2["Amount"] == ["total_amount"]
    t3, rows, _ = MP.plan_columns(["Bill No"] + heads["g"][1:], "gofrugal")
    assert t3["Bill No"] == ["invoice_number"]                             # last-wins collapse


def test_encoding_probe_and_read(spark):
    text = "BillNo,CustomerName\n1,Café €5\n2,Müller\n"
    p_utf8 = write_text(text, "utf-8")
    p_1252 = write_text(text, "cp1252")
    p_l1 = write_text(text.replace("€", "E"), "latin-1")
    assert files.probe_encoding(spark, p_utf8) == "UTF-8"
    assert files.probe_encoding(spark, p_1252) == "windows-1252"
    names = sorted(r.CustomerName for r in files.read_csv(spark, p_1252).collect())
    assert names == ["Café €5", "Müller"]
    assert sorted(r.CustomerName for r in files.read_csv(spark, p_l1).collect()) == ["Café E5", "Müller"]
    p_undef = write_text("BillNo,CustomerName\n1,x", "latin-1")
    with open(os.path.join(p_undef, "export.csv"), "ab") as f:
        f.write(b"\x81y\n")                                                  # no character in cp1252
    assert files.probe_encoding(spark, p_undef) == "ISO-8859-1"


def test_windows_1252_in_any_session(spark, tmp_path):
    """Every character of the encoding survives reading and writing, whatever the session's settings."""
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "false"
    every = "".join(bytes([b]).decode("cp1252") for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    path = write_text(f"BillNo,Prix €\n1,{every}\n2,plain\n", "cp1252")
    df = files.read_csv(spark, path)
    assert files.data_columns(df) == ["BillNo", "Prix €"]
    assert sorted(tuple(r) for r in df.select("BillNo", "Prix €").collect()) == [("1", every), ("2", "plain")]
    out = str(tmp_path / "out")
    files.write_csv(df.select("BillNo", "Prix €").coalesce(1), out, encoding="windows-1252")
    (part,) = [f for f in os.listdir(out) if f.endswith(".csv")]
    raw = open(f"{out}/{part}", "rb").read().decode("cp1252")
    assert sorted(raw.splitlines()) == sorted(["BillNo,Prix €", f"1,{every}", "2,plain"])


def test_a_header_that_begins_with_an_underscore_is_kept(spark):
    df = files.read_csv(spark, write_text("_id,BillNo,BillDate,CustomerName,ItemName,Qty,Rate,Amount\nx,1,2024-03-01,A,P,1,10,10\n", "utf-8"))
    row = CL.clean_export(df, "gofrugal", P).rows.collect()[0]
    assert row["_id"] == "x" and row["source_file"] == "export.csv"


def test_dedupe_keeps_first_copy_and_report(spark):
    text = ("BillNo,BillDate,CustomerName,ItemName,Qty,Rate,Amount\n"
            "1,2024-03-01,A,P,0,10,10\n"        # bad first copy: the whole bill goes (T8)
            "1,2024-03-01,A,P,1,10,10\n"
            "2,2024-03-02,B,P,1,10,10\n"
            ",2024-03-03,C,P,1,10,10\n"          # two null ids: one group
            ",2024-03-03,D,P,1,10,10\n"
            "3,2030-01-01,E,P,1,10,10\n")        # future
    path = write_text(text, "utf-8")
    c = CL.clean_export(files.read_csv(spark, path), "gofrugal", P, collapse=False)
    kept = sorted((r.transaction_id, r.customer_name) for r in c.rows.collect())
    assert kept == [("2", "B")]   # bill 1: bad first copy; C: null id; D: second null id (duplicate)
    rep = {r.check: r.rows for r in CL.quality_report(c).collect()}
    assert rep["future_date"] == 1 and rep["input_rows"] == 5
    assert rep["duplicate"] == 2 and rep["invalid_quantity"] == 1 and rep["null_transaction_id"] == 1
    assert rep["rows_removed"] + rep["final_rows"] == rep["input_rows"]
    c2 = CL.clean_export(files.read_csv(spark, path), "gofrugal", P, collapse=True)
    rep2 = {r.check: r.rows for r in CL.quality_report(c2).collect()}
    assert "duplicate" not in rep2 and "missing_field:transaction_id" in rep2   # BillNo ends as invoice_number


def test_missing_fields(spark):
    got = [r.field for r in MP.missing_fields(spark, ["transaction_date", "quantity"]).orderBy("ord").collect()]
    assert got == ["transaction_id", "customer_name", "product_name", "unit_price", "total_amount"]


def test_clean_csv_end_to_end(spark):
    from ledgerlens.plans.jobs import clean_csv
    text = ("VoucherNumber,VoucherDate,PartyName,StockItemName,Quantity,Rate,Amount,TaxAmount\n"
            "V1,2024-03-01, Acme ,Pump,2,\"₹1,000.00\",2000,360\n"
            "V2,2024-03-02,Beta,Motor,abc,500,500,90\n")
    src = write_text(text, "utf-8")
    out = tempfile.mkdtemp(prefix="ll-out-") + "/clean"
    system, report, back = clean_csv(spark, src, out, p=P)
    assert system == "tally"
    rows = back.collect()
    assert len(rows) == 1 and rows[0].transaction_id == "V1" and float(rows[0].unit_price) == 1000.0
    assert rows[0].source_file == "export.csv" and rows[0].loaded_at is not None
    rep = {r.check: r.rows for r in report.collect()}
    assert rep["null_quantity"] == 1 and rep["final_rows"] == 1
    bad = write_text("VoucherNumber,VoucherDate,PartyName,StockItemName,Quantity,Rate,Amount\nV1,,A,P,0,1,1\n", "utf-8")
    import pytest
    with pytest.raises(ValueError):
        clean_csv(spark, bad, tempfile.mkdtemp(prefix="ll-out-") + "/x", p=P)


def _manifest(spark, d, store):
    return {os.path.basename(r.file): r for r in landing.manifest(spark, str(d), str(store)).collect()}


def test_manifest_tells_system_encoding_and_names(spark, tmp_path):
    d = tmp_path / "in"
    (d / "deep").mkdir(parents=True)
    (d / "tally.csv").write_text("VoucherNumber,VoucherDate,PartyName,StockItemName,Quantity,Rate,Amount,TaxAmount\nV1,2024-01-01,A,P,1,2,2,0\n")
    (d / "deep" / "kaggle.csv").write_text('"ORDERNUMBER","ORDERDATE","CUSTOMERNAME","PRODUCTCODE","PRODUCTLINE","QUANTITYORDERED",'
                                           '"PRICEEACH","SALES","STATUS"\n1,2024-01-01,A,P,L,1,2,2,Shipped\n')
    (d / "other.csv").write_bytes('"foo, ""x""",Größe €\n1,2\n'.encode("cp1252"))
    (d / "empty.csv").write_text("")
    out = _manifest(spark, d, tmp_path / "store")
    assert out["tally.csv"].system == "tally" and out["tally.csv"].matches == 8 and out["tally.csv"].encoding == "UTF-8"
    assert out["kaggle.csv"].system == "kaggle" and out["kaggle.csv"].matches == 14      # repeats counted
    other = out["other.csv"]
    assert other.columns == ['foo, "x"', "Größe €"] and other.encoding == "windows-1252"
    assert other.system == "gofrugal" and other.low_confidence and other.bytes == len((d / "other.csv").read_bytes())
    assert set(out) == {"tally.csv", "kaggle.csv", "other.csv"}


def test_a_second_run_of_the_manifest_reads_new_files_only(spark, tmp_path):
    d, store = tmp_path / "in", tmp_path / "store"
    d.mkdir()
    for n in range(3):
        (d / f"a{n}.csv").write_text(f"BillNo,Qty\n{n},1\n")
    assert len(_manifest(spark, d, store)) == 3
    first = sorted(p.name for p in (store / "manifest").glob("batch_id=*"))
    assert len(_manifest(spark, d, store)) == 3                                             # nothing new: nothing written
    assert sorted(p.name for p in (store / "manifest").glob("batch_id=*")) == first
    (d / "b.csv").write_text("VoucherNumber,VoucherDate,PartyName,StockItemName,Quantity,Rate,Amount,TaxAmount\n")
    out = _manifest(spark, d, store)
    assert set(out) == {"a0.csv", "a1.csv", "a2.csv", "b.csv"} and out["b.csv"].system == "tally"
    (new,) = [p for p in (store / "manifest").glob("batch_id=*") if p.name not in first]
    assert [os.path.basename(r.file) for r in spark.read.parquet(str(new)).select("file").collect()] == ["b.csv"]


def test_an_empty_landing_folder(spark, tmp_path):
    from ledgerlens.plans import jobs
    (tmp_path / "in").mkdir()
    assert landing.manifest(spark, str(tmp_path / "in"), str(tmp_path / "store")).count() == 0
    with pytest.raises(ValueError, match="no file"):
        jobs.clean_folder(spark, str(tmp_path / "in"), P)


def test_rows_of_a_layout_in_every_encoding(spark, tmp_path):
    """One read of all files: cells decoded by their file's encoding, short rows filled with nulls."""
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.csv").write_bytes('k,v\n1,"Café €, ""x"""\n2,N/A\n3\n'.encode())
    (d / "b.csv").write_bytes("k,v\n4,Café €\n".encode("cp1252"))
    (d / "c.csv").write_bytes(b"k,v\n5,Caf\xe9 \x81\n")
    (d / "d.csv").write_bytes(b"v,w,k\n6,7,k,v\nk,v,8\n")
    listed = landing.manifest(spark, str(d), str(tmp_path / "store"))
    rows = {tuple(files.data_columns(df)): sorted(map(tuple, df.select(*files.data_columns(df)).collect()), key=repr)
            for _, df in landing.layouts(spark, str(d), listed)}
    assert rows == {("k", "v"): [("1", 'Café €, "x"'), ("2", None), ("3", None), ("4", "Café €"), ("5", "Café \x81")],
                    ("v", "w", "k"): [("6", "7", "k"), ("k", "v", "8")]}


def test_nothing_left_leaves_the_output_as_it_was(spark, tmp_path):
    from ledgerlens.plans.jobs import clean_csv
    head = "VoucherNumber,VoucherDate,PartyName,StockItemName,Quantity,Rate,Amount\n"
    out = str(tmp_path / "out")
    good = write_text(head + "V1,2024-03-01,A,P,1,1,1\nV1,2024-03-01,A,P,1,1,1\n", "utf-8")
    _, report, back = clean_csv(spark, good, out, p=P)
    assert {r.check: r.rows for r in report.collect()}["duplicate"] == 1 and back.count() == 1
    with pytest.raises(ValueError, match="All rows were removed"):
        clean_csv(spark, write_text(head + "V2,,A,P,0,1,1\n", "utf-8"), out, p=P)
    assert [r.transaction_id for r in files.read_csv(spark, out, "UTF-8").collect()] == ["V1"]


def test_observed_report_equals_the_aggregated_one(spark):
    text = ("BillNo,BillDate,CustomerName,ItemName,Qty,Rate,Amount\n1,2024-03-01,A,P,0,10,10\n1,2024-03-01,A,P,1,10,10\n"
            ",2024-03-03,C,P,1,10,10\n3,2030-01-01,E,P,1,10,10\n4,x,,P,1,10,10\n")
    c = CL.clean_export(files.read_csv(spark, write_text(text, "utf-8")), "gofrugal", P, collapse=False)
    seen, watched = CL.observed(c)
    watched.rows.write.format("noop").mode("overwrite").save()
    assert CL.report_from(spark, c, seen.get).collect() == CL.quality_report(c).collect()


def test_keep_first_over_many_splits_and_a_hot_key(spark, tmp_path):
    """File order decides whatever split or task a row is read in; a third of the rows share one id."""
    d = tmp_path / "in"
    d.mkdir()
    want = {}
    for n in range(4):
        lines = [f"{'H' if i % 3 == 0 else f'{n}-{i % 50}'},2024-03-01,{n}x{i},P,1,10,10" for i in range(400)]
        (d / f"f{n}.csv").write_text("BillNo,BillDate,CustomerName,ItemName,Qty,Rate,Amount\n" + "\n".join(lines) + "\n")
        for line in lines:
            want.setdefault(line.split(",")[0], line.split(",")[2])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        c = CL.clean_export(files.read_csv(spark, str(d), "UTF-8"), "gofrugal", P, collapse=False)
        got = {r.transaction_id: r.customer_name for r in c.rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want
    plan = c.tagged._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Scan csv" not in plan


def test_fuzzy_scores_of_known_hazards():
    cases = [("GSTAmount", "Amount", 80), ("TaxAmount", "Amount", 80), ("CustomerCode", "CustomerName", 75),
             ("PRODUCTCODE", "PRODUCTLINE", 73), ("Qty", "Quantity", 55), ("ItemCode", "ItemName", 62),
             ("Bill No", "BillNo", 92), ("customer name", "CustomerName", 96)]
    for a, b, want in cases:
        assert MP.token_sort_ratio(a, b) == want, (a, b)


@pytest.mark.parametrize("text, day_first, want", [
    ("2024-01-15", True, "2024-01-15"), ("2024-01-15 10:30:00", True, "2024-01-15"), ("2024-01-15T10:30:00", True, "2024-01-15"),
    ("2/24/2003 0:00", True, "2003-02-24"), ("02/24/2003", True, "2003-02-24"), ("15-Jan-2024", True, "2024-01-15"),
    ("Jan 15, 2024", True, "2024-01-15"), ("15 January 2024", True, "2024-01-15"), ("03/04/2024", True, "2024-04-03"),
    ("03/04/2024", False, "2024-03-04"), ("24/02/2003", False, "2003-02-24"), ("1.2.2024 11:59 PM", True, "2024-02-01"),
    ("not a date", True, None), ("2024-13-45", True, None), ("", True, None)])
def test_date_layouts(spark, text, day_first, want):
    got = spark.createDataFrame([(text,)], "d string").select(CL.parse_date(F.col("d"), day_first).cast("string")).first()[0]
    assert got == want


def test_doubled_quotes_commas_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('BillNo,ItemName,Qty\n1,"Pipe 2"" steel, long",3\n2,"two\nlines",4\n')
    rows = files.read_csv(spark, str(tmp_path), multiline=True).select("BillNo", "ItemName", "Qty").collect()
    assert [tuple(r) for r in rows] == [("1", 'Pipe 2" steel, long', "3"), ("2", "two\nlines", "4")]
    back = files.read_csv(spark, files.write_csv(spark.createDataFrame(rows[:1]), str(tmp_path / "out")))
    assert back.select("ItemName").first()[0] == 'Pipe 2" steel, long'


def test_every_key_scans_a_file(spark, sf):
    import re

    import __spark_entry__ as E
    from ledgerlens.plans import catalog
    for key in catalog.queries():
        plan = E.queries()[key](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"Relation \[|Relation\[|FileScan|LogicalRelation|Relation ", plan), key


def test_a_folder_of_mixed_files_reads_each_by_its_own_header_and_encoding(spark, tmp_path):
    from ledgerlens.plans import jobs
    head = "BillNo,BillDate,CustomerCode,CustomerName,ItemCode,ItemName,{},Amount\n"
    (tmp_path / "a.csv").write_bytes((head.format("Qty,Rate") + "1,2024-01-02,C1,Café,P1,Pipe,3,10,30\n").encode("utf-8"))
    (tmp_path / "b.csv").write_bytes((head.format("Rate,Qty") + "2,2024-01-03,C2,Müller,P2,Pipe,10,4,40\n").encode("cp1252"))
    (tmp_path / "c.csv").write_text("")
    _, rows = jobs.clean_folder(spark, str(tmp_path), Params(as_of=dt.date(2024, 6, 30)))
    got = {r["customer_name"]: (r["quantity"], r["unit_price"], r["system"]) for r in rows.collect()}
    assert got == {"Café": (3.0, 10.0, "gofrugal"), "Müller": (4.0, 10.0, "gofrugal")}


def test_a_fourth_system_by_file_only(spark, tmp_path):
    import json

    from ledgerlens import config as C
    new = json.loads(json.dumps(C.ERP_MAPPINGS))
    new["kassa"] = {"sales_transactions": {"transaction_id": "BonNr", "transaction_date": "Datum", "customer_name": "Kunde",
                                           "product_name": "Artikel", "quantity": "Menge", "unit_price": "Preis", "total_amount": "Summe"}}
    (tmp_path / "m.json").write_text(json.dumps(new))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("BonNr,Datum,Kunde,Artikel,Menge,Preis,Summe\n1,2024-01-02,K,A,2,3,6\n")
    try:
        C.use_mappings(str(tmp_path / "m.json"))
        from ledgerlens.plans import jobs
        _, rows = jobs.clean_folder(spark, str(tmp_path / "in"), Params(as_of=dt.date(2024, 6, 30)))
        assert [(r["system"], r["transaction_id"], r["total_amount"]) for r in rows.collect()] == [("kassa", "1", 6.0)]
    finally:
        C.use_mappings(C.MAPPINGS_FILE)


def test_exports_are_dealt_by_order_without_a_second_shuffle(spark, sf):
    """Lines are brought to their order and left in line order; no sort of all text rows."""
    from ledgerlens.sources import exports
    plan = exports.sales_export(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    with exports.kept_lines(spark, sf) as lines:
        kept = exports.sales_export(spark, sf, "tally", lines=lines)
        assert kept.exceptAll(exports.sales_export(spark, sf, "tally")).isEmpty() and kept.count() == lines.count()
    assert not lines.is_cached
    path = exports.export_path(spark, sf)
    assert all(f.endswith(".csv.gz") for f in os.listdir(path) if f.startswith("part-"))
    placed = files.read_csv(spark, path).groupBy("_file_path").agg(F.collect_list(F.col("BillNo").cast("long")).alias("ids")).collect()
    seen = [i for r in placed for i in sorted(set(r.ids))]
    assert all(r.ids == sorted(r.ids) for r in placed) and len(seen) == len(set(seen))  # an order is in one file


def test_file_facts_do_not_sort_the_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n2,y\n")
    facts = files.file_facts(files.text_lines(spark.read, str(tmp_path)))
    assert "SortAggregate" not in facts._jdf.queryExecution().executedPlan().toString()
    assert [(r.encoding, r.header) for r in facts.collect()] == [("UTF-8", "k,v")]


def test_folder_rows_are_written_once(spark, tmp_path, monkeypatch):
    """Rows of a landing folder hold their place in the file: duplicates are judged without a second copy of them."""
    from ledgerlens.plans import jobs
    from ledgerlens.sources import tables
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.csv").write_text("BillNo,BillDate,CustomerID,CustomerName,ItemCode,ItemName,Qty,Rate,Amount\n" + "1,2024-01-02,C1,late,P1,Pipe,3,10,30\n")
    (tmp_path / "in" / "a.csv").write_text("BillNo,BillDate,CustomerID,CustomerName,ItemCode,ItemName,Qty,Rate,Amount\n"
                                           + "1,2024-01-02,C1,first,P1,Pipe,3,10,30\n1,2024-01-02,C1,second,P1,Pipe,3,10,30\n")
    names = []

    def written(df, name):
        names.append(name)
        return tables.written(df, name)
    monkeypatch.setattr(CL, "written", written)
    rows = jobs.clean_folder(spark, str(tmp_path / "in"), P, collapse=False)[1].collect()
    assert [r.customer_name for r in rows] == ["first"] and "typed" not in names


def test_one_file_is_read_for_its_encoding_by_bytes(spark):
    """A byte windows-1252 leaves undefined tells ISO-8859-1, whatever hex digits stand side by side."""
    assert files.probe_encoding(spark, write_text("A,B\nM\x81ller,1\n", "latin-1")) == "ISO-8859-1"
    assert files.probe_encoding(spark, write_text("A,B\n\xe9\xd8\x19,1\n", "latin-1")) == "windows-1252"


def test_ascii_text_is_not_translated_and_other_text_is(spark):
    df = spark.createDataFrame([("plain",), ("caf\xe9 \x80 \x93x\x94",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(files.from_latin1(F.col("t"))).collect()] == ["plain", "café € “x”", "", None]
    plan = df.select(files.from_latin1(F.col("t")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan or "OctetLength" in plan


def _operators(df, spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_date_parsers_stay_out_of_the_generated_method(spark):
    """Fourteen parsers in the whole-stage code made a method the JVM does not compile."""
    df = spark.createDataFrame([("2024-01-05",)], "d string")
    lines = [x for x in _operators(df.select(CL.parse_date(F.col("d")).alias("d")), spark) if "gettimestamp" in x]
    assert lines and not any("*(" in x for x in lines)


@pytest.mark.parametrize(("text", "want"), [
    ("2024-02-30", None), ("2024-1-5", "2024-01-05"), (" 2024-01-05\n", "2024-01-05"), ("2024-01-05T10:00:00Z", "2024-01-05"),
    ("January 5, 2024", "2024-01-05"), ("5-Jan-2024 9:30 PM", "2024-01-05"), ("01/13/2024", "2024-01-13"), ("13.01.2024", "2024-01-13"),
    ("2024-01", None), ("2024", None), ("", None), ("not a date", None), (None, None), ("0000-01-01", "0000-01-01")])
def test_dates_of_odd_texts(spark, text, want):
    got = spark.createDataFrame([(text,)], "d string").select(CL.parse_date(F.col("d")).cast("string")).first()[0]
    assert got == want


@pytest.mark.parametrize("text", ["a", " a", "a ", "\ta ", "　é b ", "é", " ", "", None, "a b"])
def test_trim_of_white_space_at_either_end(spark, text):
    from ledgerlens.functions.columns import ws_trim
    got = spark.createDataFrame([(text,)], "t string").select(ws_trim("t")).first()[0]
    assert got == (None if text is None else text.strip())


def test_conform_converts_each_value_once(spark):
    """The filter on the errors reads converted values: it does not convert again below the projection."""
    from pyspark.sql.types import DateType, DecimalType, StringType, StructField, StructType

    from ledgerlens.operators import conform as CF
    schema = StructType([StructField("id", StringType(), False), StructField("d", DateType()), StructField("x", DecimalType(18, 4)),
                         StructField("y", StringType())])
    df = spark.createDataFrame([("1", "2024-01-05", "1,5"), ("2", "no", "2"), (None, "05/01/2024", "x"), ("3", None, None)], "id string, d string, x string")
    found = CF.checked(df, schema)
    good, bad = CF.conformed(found), CF.quarantine(found)
    assert [(r.id, str(r.d), r.x, r.y) for r in good.collect()] == [("1", "2024-01-05", 15, None), ("3", "None", None, None)]
    assert [(r.id, r.d, r.x, r.errors) for r in bad.collect()] == [
        ("2", "no", "2", ["d: not a date"]), (None, "05/01/2024", "x", ["id: missing", "x: not a number"])]
    assert not any("Filter" in x and "gettimestamp" in x for x in _operators(good, spark))


def test_plain_numbers_and_odd_dates_take_the_short_way(spark):
    """Most numbers are only digits and a point, and a layout that cannot fit is not tried: same values, less work."""
    from pyspark.sql import functions as F

    from ledgerlens.operators import cleaning
    numbers = [("12", 12.0), ("12.50", 12.5), ("₹1,234.50", 1234.5), (" 7 ", 7.0), ("12\n", 12.0), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0),
               ("+3", 3.0), ("-2", -2.0), ("1.2.3", None), ("12d", None), ("NaN", None), ("١٢", None), ("", None), (None, None)]
    dates = [("2001-02-03", "2001-02-03"), ("2001/2/3", "2001-02-03"), ("03/02/2001", "2001-02-03"), ("05/25/2001", "2001-05-25"),
             ("03-Feb-2001", "2001-02-03"), ("Feb 3, 2001", "2001-02-03"), ("3.2.2001", "2001-02-03"), ("2001-02-03T10:30:00Z", "2001-02-03"),
             ("201/1/2", None), ("2001-02-0x", None), ("not a date", None), (None, None)]
    n = spark.createDataFrame(numbers, "v string, want double").select("v", "want", cleaning.to_number(F.col("v")).alias("got"))
    d = spark.createDataFrame(dates, "v string, want string").select("v", "want", cleaning.parse_date(F.col("v")).cast("string").alias("got"))
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (n, d)]
    assert "RLIKE(v" in plans[0] and "instr(" in plans[1]
    for df in (n, d):
        assert [(r["v"], r["got"]) for r in df.collect() if r["got"] != r["want"]] == []


@pytest.mark.parametrize("encoding", ["UTF-8", "windows-1252", "ISO-8859-1"])
def test_landed_cells_are_decoded_outside_the_generated_method(spark, tmp_path, encoding):
    """Decoders of twelve cells in one generated method were not compiled by the JVM; the values are as before."""
    texts = ["plain", "N/A", " N/A", "#N/A N/A", "-1.#QNAN", "-1.#QNANx", "nan", "Café", "\xa0", "é" * 9, "12.50"]
    texts += {"UTF-8": ["₹12.50"], "windows-1252": ["€ “x”"], "ISO-8859-1": ["M\x81ller"]}[encoding]
    cells = [f"c{i}" for i in range(len(texts))]
    file = {"UTF-8": "utf-8", "windows-1252": "cp1252", "ISO-8859-1": "latin-1"}[encoding]
    (tmp_path / "a.csv").write_bytes((",".join([*texts, encoding]) + "\n" + "," * len(texts) + encoding + "\n").encode(file))
    raw = spark.read.schema(", ".join(f"{c} string" for c in [*cells, "encoding"])).option("encoding", "ISO-8859-1").csv(str(tmp_path / "a.csv"))
    got = raw.select(*(landing._text(F.col(c), F.col("encoding")).alias(c) for c in cells))
    assert sorted(map(list, got.collect()), key=str) == sorted([[None if t in files.NULL_TEXTS else t for t in texts], [None] * len(texts)], key=str)
    lines = [x for x in _operators(got, spark) if "decode(" in x]
    assert lines and not any("*(" in x for x in lines)


def test_ascii_text_is_written_as_it_is(spark):
    """Only text beyond ASCII is translated for windows-1252."""
    df = spark.createDataFrame([("plain",), ("caf\xe9 € “x”",), ("\x80",), ("",), (None,)], "t string")
    out = df.select(files.to_latin1(F.col("t")).alias("t"))
    assert [r[0] for r in out.collect()] == ["plain", "caf\xe9 \x80 \x93x\x94", "?", "", None]
    assert "octet_length" in out._jdf.queryExecution().optimizedPlan().toString()
