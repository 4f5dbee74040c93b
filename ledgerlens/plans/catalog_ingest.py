"""Registered ingestion queries: CSV scan, encoding probe, mapping, cleaning,
quality report, tables.  Their input is a sales export that Spark writes from
the test tables (``sources.exports``) and reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.config import DEFAULT
from ledgerlens.operators import cleaning as CL
from ledgerlens.operators import mapping as MP
from ledgerlens.plans import jobs
from ledgerlens.plans.oracle import AS_OF, with_
from ledgerlens.session import shared_path
from ledgerlens.sources import exports, files, landing, tables

P = DEFAULT
GOFRUGAL = C.ERP_MAPPINGS["gofrugal"]["sales_transactions"]


def _read(spark: SparkSession, sf: str, system: str = "gofrugal", encoding: str = "UTF-8") -> DataFrame:
    return files.read_csv(spark, exports.export_path(spark, sf, system, encoding))


def _data(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in CL.BOOKKEEPING])


def csv_scan(spark, sf):
    return _data(_read(spark, sf))


def csv_scan_encoding(spark, sf):
    """The export written in windows-1252, read back after the encoding probe."""
    return _data(files.read_csv(spark, exports.export_path(spark, sf, "gofrugal", "windows-1252")))


def csv_scan_latin1(spark, sf):
    return _data(files.read_csv(spark, exports.export_path(spark, sf, "gofrugal", "ISO-8859-1")))


def _exports_manifest(spark, sf) -> DataFrame:
    """The manifest of the three systems' exports, kept for the session."""
    with exports.kept_lines(spark, sf) as lines:
        paths = [exports.export_path(spark, sf, s, lines=lines) for s in MP.SYSTEMS]
    folder = paths[0].rsplit("/", 1)[0]
    together = f"{folder}/{{{','.join(p.rsplit('/', 1)[1] for p in paths)}}}"
    store = exports.written_once(spark, ("manifest", sf), lambda p: None)
    return landing.manifest(spark, together, store).withColumn("export", F.regexp_extract("file", r"export-([a-z]+)-", 1))


def detect_source(spark, sf):
    """Every part file of the three exports, detected when the landing manifest was
    extended by it; reported per export folder (all files of one export share a
    header)."""
    found = ("system", "matches", "entries", "confidence", "low_confidence")
    return _exports_manifest(spark, sf).select("export", *found).distinct()


def landing_manifest(spark, sf):
    """What the manifest holds per export: layout, encoding, and all bytes accounted for."""
    listed = _exports_manifest(spark, sf)
    return listed.groupBy("export", "encoding", "system").agg(
        F.countDistinct("layout").alias("layouts"), F.max(F.size("columns")).cast("bigint").alias("n_columns"),
        F.bool_and(F.col("bytes") > 0).alias("sized"), F.bool_and(F.col("modified").isNotNull()).alias("dated"))


def column_rename(spark, sf):
    df = _read(spark, sf)
    targets, _, _ = MP.plan_columns(files.data_columns(df), "gofrugal")
    return _data(MP.apply_columns(df, targets))


RENAMED = {"BillNo": "Bill No", "CustomerName": "customer name", "ItemName": "Item_Name", "Qty": "QTY"}


def clean_sales_renamed(spark, sf):
    """The export with headers spelled differently, matched fuzzily and cleaned."""
    path = exports.written_once(spark, ("renamed", sf), lambda p: files.write_csv(
        exports.sales_export(spark, sf, "gofrugal").withColumnsRenamed(RENAMED), p, compression="gzip"))
    return CL.clean_export(files.read_csv(spark, path), "gofrugal", P).rows.drop("source_file")


def missing_fields(spark, sf):
    """Required fields that no header of an export feeds, from the headers in the
    landing manifest (under last-wins collapse, so a column feeds the last of its
    names)."""
    heads = _exports_manifest(spark, sf).select(F.col("export").alias("system"), F.explode("columns").alias("source")).distinct()
    last = MP.mapping_frame(spark).groupBy("system", "source").agg(F.max_by("universal", "entry_order").alias("field"))
    fed = heads.join(last, ["system", "source"]).select("system", "field")
    need = heads.select("system").distinct().select("system", F.posexplode(F.array(*map(F.lit, C.CLEANER_REQUIRED))).alias("ord", "field"))
    return need.join(fed, ["system", "field"], "left_anti").select("ord", "field", "system")


MIXED = (("gofrugal", "UTF-8", "₹"), ("tally", "windows-1252", ""), ("kaggle", "UTF-8", "₹"))
MIXED_COLUMNS = ("system", "transaction_id", "customer_name", "product_name", "quantity", "total_amount")


def clean_mixed_folder(spark, sf):
    """One landing folder with the exports of three systems in two encodings."""
    def write(path: str) -> None:
        with exports.kept_lines(spark, sf) as lines:
            for system, encoding, currency in MIXED:
                files.write_csv(exports.sales_export(spark, sf, system, currency, lines), f"{path}/{system}", encoding=encoding, compression="gzip")

    path = exports.written_once(spark, ("mixed", sf), write)
    return jobs.clean_folder(spark, path, P, collapse=False)[1].select(*MIXED_COLUMNS)


def _cleaned(spark, sf, collapse=True):
    return CL.clean_export(_read(spark, sf), "gofrugal", P, collapse=collapse)


def clean_numeric(spark, sf):
    c = _cleaned(spark, sf)
    return c.tagged.select("invoice_number", *C.NUMERIC_COLUMNS[:-1], "tax_amount")


def clean_dates(spark, sf):
    c = _cleaned(spark, sf)
    return c.tagged.where(~F.col("_future")).select("invoice_number", "customer_id", "product_id",
                                                    "transaction_date")


def dedupe_first(spark, sf):
    c = _cleaned(spark, sf, collapse=False)
    return c.tagged.where(~F.col("_future") & F.col("_is_first")).select(
        "transaction_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount")


def dq_filter(spark, sf):
    c = _cleaned(spark, sf)
    return c.tagged.where(~F.col("_future")).select("invoice_number", "product_id",
                                                    F.col("_dq_check").alias("dq_check"))


def clean_sales(spark, sf):
    return _cleaned(spark, sf).rows.drop("source_file")


def dq_report(spark, sf):
    return CL.quality_report(_cleaned(spark, sf))


def lineage_columns(spark, sf):
    path = exports.export_path(spark, sf, compression="none")  # file names end with .csv
    c = CL.clean_export(files.read_csv(spark, path, with_lineage=True), "gofrugal", P)
    return c.rows.select("invoice_number", F.col("source_file").endswith(".csv").alias("from_csv"),
                         F.col("loaded_at").isNotNull().alias("stamped"))


def load_replace_append(spark, sf, name: str = "ll_sales_raw"):
    """Load the clean rows as a table (replace), append them again, read back.  The
    rows appended are those just loaded, so cleaning is evaluated once."""
    rows = clean_sales(spark, sf)
    loc = shared_path(spark, "tables")
    ok1 = tables.load_table(rows, name, "replace", path=f"{loc}/{name}")
    ok2 = ok1 and tables.load_table(spark.table(name), name, "append", path=f"{loc}/{name}")
    return spark.table(name).withColumn("load_ok", F.lit(ok1 and ok2))


def table_preview(spark, sf):
    """Five rows of a loaded table, whichever they are: how many there are, and
    how many of them the table holds.  Only the table's rows that equal one of them
    are compared; the five are written, as another look may find five others."""
    load_replace_append(spark, sf, "ll_sales_preview")
    some = tables.written(tables.preview(spark, "ll_sales_preview", 5), "preview")
    shown = some.agg(F.count("*").alias("rows_shown"))
    held = tables.rows_like(spark.table("ll_sales_preview"), some)
    return shown.withColumn("all_held", F.lit(some.exceptAll(held).isEmpty()))


def staging_kaggle(spark, sf):
    """A Kaggle-layout export: under last-wins collapse it loses the id, date,
    price and total, so it is mapped with every name a column feeds
    (``collapse=False``): PRICEEACH is both price and cost, ORDERDATE both sale
    and due date."""
    from ledgerlens.operators.staging import stage_sales
    clean = CL.clean_export(_read(spark, sf, "kaggle"), "kaggle", P, collapse=False).rows.drop("source_file")
    return stage_sales(clean, P, with_loaded_at=False)


def staging_tally(spark, sf):
    """A Tally-layout export cleaned and staged: no invoice number, cost,
    status or due date in that layout, so staging takes the id as invoice
    and typed nulls for the rest (the bill's first line survives the dedupe)."""
    from ledgerlens.operators.staging import stage_sales
    clean = CL.clean_export(_read(spark, sf, "tally"), "tally", P).rows.drop("source_file")
    return stage_sales(clean, P, with_loaded_at=False)


QUERIES = {
    "staging_tally": staging_tally,
    "staging_kaggle": staging_kaggle,
    "csv_scan": csv_scan,
    "csv_scan_encoding": csv_scan_encoding,
    "csv_scan_latin1": csv_scan_latin1,
    "detect_source": detect_source,
    "landing_manifest": landing_manifest,
    "column_rename": column_rename,
    "clean_sales_renamed": clean_sales_renamed,
    "clean_mixed_folder": clean_mixed_folder,
    "missing_fields": missing_fields,
    "clean_numeric": clean_numeric,
    "clean_dates": clean_dates,
    "dedupe_first": dedupe_first,
    "dq_filter": dq_filter,
    "clean_sales": clean_sales,
    "dq_report": dq_report,
    "lineage_columns": lineage_columns,
    "load_replace_append": load_replace_append,
    "table_preview": table_preview,
}

# ---------------------------------------------------------------------------
# DuckDB oracles: the export text rebuilt from the tables, then the same steps
# ---------------------------------------------------------------------------

_D = "(CASE WHEN o_orderkey % 307 = 0 THEN CAST(o_orderdate AS DATE) + INTERVAL 400 DAY ELSE CAST(o_orderdate AS DATE) END)"
_CENTS = "CAST(FLOOR(l_extendedprice * 100 / l_quantity) AS BIGINT)"
_PRICE = f"CAST({_CENTS} * 0.01 AS DECIMAL(18,2))"
_TOTAL = f"CAST(CAST(l_quantity AS BIGINT) * {_CENTS} * 0.01 AS DECIMAL(18,2))"
def _fields(currency: str = "₹") -> dict[str, str]:
    f = dict(EXPORT_FIELDS)
    f["unit_price"] = f["unit_price"].replace("'₹' ||", f"'{currency}' ||")
    return f


EXPORT_FIELDS = {
    "transaction_id": "CAST(o_orderkey AS VARCHAR)",
    "transaction_date": f"""CASE WHEN o_orderkey % 211 = 0 THEN NULL
        WHEN o_orderkey % 223 = 0 THEN 'not a date'
        WHEN o_orderkey % 11 = 0 THEN strftime(CAST({_D} AS DATE), '%d/%m/%Y')
        WHEN o_orderkey % 17 = 0 THEN CAST(CAST({_D} AS DATE) AS VARCHAR) || ' 10:30:00'
        WHEN o_orderkey % 23 = 0 AND day(CAST({_D} AS DATE)) > 12 THEN strftime(CAST({_D} AS DATE), '%m/%d/%Y')
        WHEN o_orderkey % 29 = 0 THEN strftime(CAST({_D} AS DATE), '%d-%b-%Y')
        ELSE CAST(CAST({_D} AS DATE) AS VARCHAR) END""",
    "customer_id": "'C' || CAST(c_custkey AS VARCHAR)",
    "customer_name": """CASE WHEN c_custkey % 97 = 0 THEN NULL
        WHEN c_custkey % 13 = 0 THEN chr(9) || c_name || chr(160)
        WHEN c_custkey % 19 = 0 THEN c_name || ' Café Müller' ELSE c_name END""",
    "product_id": "'P' || CAST(p_partkey AS VARCHAR)",
    "product_name": """p_name || ' #' || CAST(p_partkey AS VARCHAR)
        || CASE WHEN p_partkey % 31 = 0 THEN ' 2" steel, long' ELSE '' END""",
    "quantity": "CASE WHEN o_orderkey % 89 = 0 THEN '0' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END",
    "unit_price": f"""CASE WHEN o_orderkey % 83 = 0 THEN 'abc'
        WHEN o_orderkey % 7 = 0 THEN '₹' || format('{{:,.2f}}', CAST({_PRICE} AS DOUBLE))
        ELSE CAST({_PRICE} AS VARCHAR) END""",
    "cost_price": "CASE WHEN p_size = 50 THEN NULL ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END",
    "total_amount": f"CAST({_TOTAL} AS VARCHAR)",
    "tax_amount": f"CAST(CAST(round({_TOTAL} * 0.18, 2) AS DECIMAL(18,2)) AS VARCHAR)",
    "payment_status": "CASE WHEN o_orderstatus = 'F' THEN 'Paid' WHEN o_orderstatus = 'P' THEN 'Partial' ELSE 'Unpaid' END",
    "payment_due_date": f"CAST(CAST({_D} + INTERVAL 30 DAY AS DATE) AS VARCHAR)",
}


def export_sql(system: str = "gofrugal", currency: str = "₹") -> str:
    fields = _fields(currency)
    cols, seen = [], set()
    for uni, src in C.ERP_MAPPINGS[system]["sales_transactions"].items():
        if src in seen:
            continue
        seen.add(src)
        cols.append(f"{fields[uni]} AS \"{src}\"")
    return (f"SELECT {', '.join(cols)}, l_orderkey AS _k1, l_linenumber AS _k2, l_partkey AS _k3, "
            f"l_quantity AS _k4, l_extendedprice AS _k5\n"
            "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
            "JOIN part ON l_partkey = p_partkey")


_DATE_FMTS = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%d/%m/%Y", "%m/%d/%Y", "%d-%b-%Y")
_WSCH = "'" + C.UNICODE_WHITESPACE + "'"


def _parse_date(x: str) -> str:
    return "coalesce(" + ", ".join(f"CAST(try_strptime({x}, '{f}') AS DATE)" for f in _DATE_FMTS) + ")"


def _num(x: str) -> str:
    t = f"trim(regexp_replace({x}, '[₹,]', '', 'g'), {_WSCH})"
    return f"CASE WHEN regexp_full_match({t}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN TRY_CAST({t} AS DOUBLE) END"


def _mapped(collapse: bool = True, system: str = "gofrugal") -> str:
    """Export columns under the universal names (collapse: BillNo -> invoice_number only)."""
    m = C.ERP_MAPPINGS[system]["sales_transactions"]
    by_src: dict[str, list[str]] = {}
    for uni, src in m.items():
        if collapse:
            by_src[src] = [uni]
        else:
            by_src.setdefault(src, []).append(uni)
    sel = []
    for src, unis in by_src.items():
        for u in unis:
            if u == "transaction_date":
                expr = f"strftime({_parse_date(chr(34) + src + chr(34))}, '%Y-%m-%d')"
            elif u in C.NUMERIC_COLUMNS:
                expr = _num(f'"{src}"')
            else:
                expr = f'"{src}"'
            sel.append(f"{expr} AS {u}")
    fut = f"coalesce({_parse_date(chr(34) + m['transaction_date'] + chr(34))} > {AS_OF}, false)"
    text = chr(34) + m['transaction_date'] + chr(34)
    bad = f"({text} IS NOT NULL AND {_parse_date(text)} IS NULL)"
    return f"SELECT {', '.join(sel)}, {fut} AS _future, {bad} AS _unparsed, _k1, _k2, _k3, _k4, _k5 FROM export"


_REQ_COLLAPSE = [f for f in C.CLEANER_REQUIRED if f != "transaction_id"]


def _tag(required, with_dup: bool) -> str:
    parts = (["WHEN NOT _is_first THEN 'duplicate'"] if with_dup else [])
    parts += [f"WHEN {f} IS NULL THEN 'null_{f}'" for f in required]
    parts += ["WHEN quantity IS NULL OR quantity <= 0 THEN 'invalid_quantity'",
              "WHEN unit_price IS NULL OR unit_price <= 0 THEN 'invalid_price'"]
    return "CASE " + " ".join(parts) + " END"


_TAGGED = f"SELECT *, {_tag(_REQ_COLLAPSE, False)} AS dq_check FROM mapped WHERE NOT _future"
_BASE = [("export", export_sql()), ("mapped", _mapped())]
_CLEAN_COLS = ("invoice_number, transaction_date, customer_id, customer_name, product_id, product_name, quantity, "
               "unit_price, cost_price, total_amount, tax_amount, payment_status, payment_due_date")


def _report_sql() -> str:
    checks = [f"null_{f}" for f in _REQ_COLLAPSE] + ["invalid_quantity", "invalid_price"]
    agg = [("future_date", "removed_before_validation", "count_if(_future)"),
           ("input_rows", "counted", "count_if(NOT _future)")]
    agg += [(c, "removed", f"count_if(NOT _future AND dq_check = '{c}')") for c in checks]
    clean = "NOT _future AND dq_check IS NULL"
    agg += [("unparsed_date", "warned", "count_if(NOT _future AND _unparsed)"), ("cost_above_price", "warned",
             f"count_if({clean} AND cost_price IS NOT NULL AND cost_price > unit_price)"),
            ("rows_removed", "counted", f"count_if(NOT _future) - count_if({clean})"),
            ("final_rows", "counted", f"count_if({clean})")]
    one = "SELECT " + ", ".join(f"{e} AS \"{n}\"" for n, _, e in agg) + " FROM tagged"
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", '{a}' AS action, CAST(\"{n}\" AS BIGINT) AS \"rows\", input_rows AS _input FROM one"
        for n, a, _ in agg)
    rows += " UNION ALL SELECT 'missing_field:transaction_id', 'warned', NULL, input_rows FROM one"
    return with_(_BASE + [("tagged", f"SELECT *, {_tag(_REQ_COLLAPSE, False)} AS dq_check FROM mapped"),
                          ("one", one), ("rep", rows)],
                 "SELECT \"check\", action, \"rows\", CASE WHEN _input > 0 THEN round(\"rows\" * 100.0 / _input, 1) END "
                 "AS pct_of_input FROM rep")


def _detect_sql() -> str:
    heads = []
    for s in MP.SYSTEMS:
        seen = []
        for src in C.ERP_MAPPINGS[s]["sales_transactions"].values():
            if src not in seen:
                seen.append(src)
        heads += [f"('{s}', '{c}')" for c in seen]
    maps = [f"('{s}', {i}, '{src}')" for i, s in enumerate(MP.SYSTEMS)
            for src in C.ERP_MAPPINGS[s]["sales_transactions"].values()]
    return f"""WITH h(export, col) AS (VALUES {', '.join(heads)}),
m(system, system_order, source) AS (VALUES {', '.join(maps)}),
e AS (SELECT system, system_order, count(*) AS entries FROM m GROUP BY system, system_order),
pairs AS (SELECT DISTINCT h.export, e.system, e.system_order, e.entries FROM h, e),
hits AS (SELECT h.export, m.system, count(*) AS matches FROM m JOIN (SELECT DISTINCT export, col FROM h) h
         ON m.source = h.col GROUP BY h.export, m.system),
scored AS (SELECT p.export, p.system, p.system_order, CAST(p.entries AS BIGINT) AS entries,
           CAST(coalesce(hits.matches, 0) AS BIGINT) AS matches FROM pairs p
           LEFT JOIN hits ON p.export = hits.export AND p.system = hits.system),
ranked AS (SELECT *, row_number() OVER (PARTITION BY export ORDER BY matches DESC, system_order) AS rk FROM scored)
SELECT export, system, matches, entries, round(matches / entries, 4) AS confidence,
       matches / entries < {C.LOW_CONFIDENCE} AS low_confidence FROM ranked WHERE rk = 1"""


def _missing_sql() -> str:
    rows = []
    for s in MP.SYSTEMS:
        got = set(C.ERP_MAPPINGS[s]["sales_transactions"])
        # under collapse a source column listed twice keeps only its last name
        last: dict[str, str] = {}
        for uni, src in C.ERP_MAPPINGS[s]["sales_transactions"].items():
            last[src] = uni
        got = set(last.values())
        rows += [f"({i}, '{f}', '{s}')" for i, f in enumerate(C.CLEANER_REQUIRED) if f not in got]
    return f"SELECT CAST(ord AS INTEGER) AS ord, field, system FROM (VALUES {', '.join(rows)}) t(ord, field, system)"


def _export_cols(system: str = "gofrugal") -> str:
    seen = []
    for src in C.ERP_MAPPINGS[system]["sales_transactions"].values():
        if src not in seen:
            seen.append(src)
    return ", ".join(f'"{c}"' for c in seen)


_KEEP_ALL = _mapped(collapse=False)

def _export_staging_sql(system: str, collapse: bool) -> str:
    """Export of ``system`` -> mapped -> keep-first and quality checks -> staging."""
    from ledgerlens.plans import oracle as O
    m = C.ERP_MAPPINGS[system]["sales_transactions"]
    names = set(m) if not collapse else {u for u in {src: u for u, src in m.items()}.values()}
    has_id = "transaction_id" in names
    req = [f for f in C.CLEANER_REQUIRED if f in names]
    first = ("row_number() OVER (PARTITION BY transaction_id ORDER BY _k1, _k2, _k3, _k4, _k5) = 1" if has_id
             else "true")
    tagged = (f"SELECT *, {_tag(req, has_id)} AS dq_check FROM ("
              f"SELECT *, {first} AS _is_first FROM mapped WHERE NOT _future) t")

    def col(name: str, typ: str) -> str:
        return name if name in names else f"CAST(NULL AS {typ})"
    inv = "invoice_number" if "invoice_number" in names else "transaction_id"
    raw = (f"SELECT {inv} AS invoice_number, transaction_date, customer_name, product_name, quantity, unit_price, "
           f"{col('cost_price', 'DOUBLE')} AS cost_price, total_amount, {col('payment_status', 'VARCHAR')} AS payment_status, "
           f"{col('payment_due_date', 'VARCHAR')} AS payment_due_date FROM tagged WHERE dq_check IS NULL")
    return with_([("export", export_sql(system)), ("mapped", _mapped(collapse, system)), ("tagged", tagged),
                  ("raw", raw), ("stg", O.STG)], "SELECT * FROM stg")


def _mixed_sql() -> str:
    parts = []
    for system, _, currency in MIXED:
        req = [f for f in C.CLEANER_REQUIRED if f in C.ERP_MAPPINGS[system]["sales_transactions"]]
        tagged = (f"SELECT *, {_tag(req, True)} AS dq_check FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id "
                  "ORDER BY _k1, _k2, _k3, _k4, _k5) = 1 AS _is_first FROM mapped WHERE NOT _future) t")
        one = with_([("export", export_sql(system, currency)), ("mapped", _mapped(False, system)), ("tagged", tagged)],
                    f"SELECT '{system}' AS {', '.join(MIXED_COLUMNS)} FROM tagged WHERE dq_check IS NULL")
        parts.append(f"SELECT * FROM ({one}) AS {system}")
    return " UNION ALL ".join(parts)


ORACLE = {
    "clean_mixed_folder": _mixed_sql(),
    "csv_scan": with_([("export", export_sql())], f"SELECT {_export_cols()} FROM export"),
    "csv_scan_encoding": with_([("export", export_sql(currency=""))], f"SELECT {_export_cols()} FROM export"),
    "csv_scan_latin1": with_([("export", export_sql(currency=""))], f"SELECT {_export_cols()} FROM export"),
    "detect_source": _detect_sql(),
    "column_rename": with_([("export", export_sql())],
                           "SELECT " + ", ".join(f'"{src}" AS {uni}' for src, uni in
                                                 {s: u for u, s in GOFRUGAL.items()}.items()) + " FROM export"),
    "missing_fields": _missing_sql(),
    "landing_manifest": "SELECT * FROM (VALUES " + ", ".join(
        f"('{s}', 'UTF-8', '{s}', 1::BIGINT, {len(set(C.ERP_MAPPINGS[s]['sales_transactions'].values()))}::BIGINT, true, true)" for s in MP.SYSTEMS)
        + ") t(export, encoding, system, layouts, n_columns, sized, dated)",
    "clean_numeric": with_(_BASE, "SELECT invoice_number, quantity, unit_price, cost_price, total_amount, tax_amount FROM mapped"),
    "clean_dates": with_(_BASE, "SELECT invoice_number, customer_id, product_id, transaction_date FROM mapped WHERE NOT _future"),
    "dedupe_first": with_([("export", export_sql()), ("mapped", _KEEP_ALL)],
                          "SELECT transaction_id, customer_id, product_id, quantity, unit_price, total_amount FROM ("
                          "SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _k1, _k2, _k3, _k4, _k5) AS rn "
                          "FROM mapped WHERE NOT _future) t WHERE rn = 1"),
    "dq_filter": with_(_BASE + [("tagged", _TAGGED)], "SELECT invoice_number, product_id, dq_check FROM tagged"),
    "clean_sales": with_(_BASE + [("tagged", _TAGGED)], f"SELECT {_CLEAN_COLS} FROM tagged WHERE dq_check IS NULL"),
    "clean_sales_renamed": with_(_BASE + [("tagged", _TAGGED)], f"SELECT {_CLEAN_COLS} FROM tagged WHERE dq_check IS NULL"),
    "dq_report": _report_sql(),
    "staging_tally": _export_staging_sql("tally", True),
    "staging_kaggle": _export_staging_sql("kaggle", False),
    "lineage_columns": with_(_BASE + [("tagged", _TAGGED)], "SELECT invoice_number, true AS from_csv, true AS stamped FROM tagged WHERE dq_check IS NULL"),
    "table_preview": with_(_BASE + [("tagged", _TAGGED)],
                           "SELECT least(5, 2 * count(*))::BIGINT AS rows_shown, true AS all_held FROM tagged WHERE dq_check IS NULL"),
    "load_replace_append": with_(_BASE + [("tagged", _TAGGED)],
                                 f"SELECT {_CLEAN_COLS}, true AS load_ok FROM tagged WHERE dq_check IS NULL "
                                 f"UNION ALL SELECT {_CLEAN_COLS}, true FROM tagged WHERE dq_check IS NULL"),
}
