import shutil
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens.streaming import critical, entities
from ledgerlens.sources import fixture

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_stream_equals_batch(spark, sf):
    streamed = critical.read_alerts(spark, critical.run_available_now(spark, sf))
    lines = fixture.table(spark, sf, "lineitem").select(*critical.LINE_COLUMNS)
    batch = critical.critical_alerts(lines, spark, sf)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"alert_type", "severity", "entity", "metric_value", "message", "action"} <= set(df.columns)


FAST_KEYS = ["staging", "customer_metrics", "mart_dead_stock", "mart_low_margin", "mart_credit_risk",
             "balanced_alerts", "digest_lines", "clean_sales", "dq_report", "detect_source", "credit_score",
             "indian_number_format", "seasonal_expectation", "stream_critical_alerts", "stream_entity_alerts"]


@pytest.mark.parametrize("key", FAST_KEYS)
def test_matches_duckdb_oracle(spark, sf, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    sdf = E.queries()[key](spark, sf)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = sorted(sdf.columns)

    def norm(v):
        if isinstance(v, float):
            return round(v, 9)
        return v

    s_rows = sorted((tuple(norm(r[c]) for c in order) for r in sdf.collect()), key=repr)
    idx = [rel.columns.index(c) for c in order]
    d_rows = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert s_rows == d_rows


def test_every_sql_key_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_continuous_stream_resumes_from_checkpoint(spark, sf):
    import tempfile
    base = tempfile.mkdtemp(prefix="ll-stream-")
    out, ckpt = base + "/out", base + "/ckpt"
    q = critical.start(spark, sf, out, ckpt, every="1 second")
    q.processAllAvailable()
    q.stop()
    first = critical.read_alerts(spark, out).count()
    # a restart on the same checkpoint finds nothing new: no duplicate output
    q2 = critical.start(spark, sf, out, ckpt, every="1 second")
    q2.processAllAvailable()
    q2.stop()
    assert critical.read_alerts(spark, out).count() == first > 0


@pytest.fixture()
def pieces(spark, sf, tmp_path):
    """The lines in eight files, one micro-batch each."""
    lines = fixture.table(spark, sf, "lineitem")
    folder = tmp_path / "lines"
    folder.mkdir()
    for n in range(8):
        part = tmp_path / f"part{n}"
        lines.where(f"pmod(hash(l_orderkey, l_linenumber), 8) = {n}").coalesce(1).write.parquet(str(part))
        (file,) = part.glob("*.parquet")
        shutil.copyfile(file, folder / f"lineitem_{n}.parquet")
    return folder


def _batch(spark, sf):
    return critical.critical_alerts(fixture.table(spark, sf, "lineitem").select(*critical.LINE_COLUMNS), spark, sf)


def _same(got, want):
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_eight_files_one_per_batch_equal_the_batch(spark, sf, pieces):
    out = critical.run_available_now(spark, sf, lines_dir=str(pieces), max_files_per_trigger=1)
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 8
    _same(critical.read_alerts(spark, out), _batch(spark, sf))


def test_a_file_sent_again_in_a_later_batch_gives_no_alert(spark, sf, pieces, tmp_path):
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    late = {n: (pieces / f"lineitem_{n}.parquet").read_bytes() for n in range(8)}
    for n in range(1, 8):
        (pieces / f"lineitem_{n}.parquet").unlink()
    for n in range(8):  # from the fourth batch on, the first file comes again under a new name
        (pieces / f"lineitem_{n}.parquet").write_bytes(late[n])
        if n >= 3:
            (pieces / f"lineitem_again{n}.parquet").write_bytes(late[0])
        critical.run_available_now(spark, sf, out_path=out, checkpoint=ckpt, lines_dir=str(pieces))
    _same(critical.read_alerts(spark, out), _batch(spark, sf))


def test_two_equal_lines_of_an_invoice_give_two_alerts(spark, sf, tmp_path):
    one = fixture.table(spark, sf, "lineitem").join(_batch(spark, sf).selectExpr("CAST(transaction_id AS BIGINT) AS l_orderkey").distinct(),
                                                    "l_orderkey", "left_semi").limit(40)
    twice = one.unionByName(one.withColumn("l_linenumber", F.expr("CAST(l_linenumber + 100 AS INT)"))).select(
        *[F.col(f.name).cast(f.dataType) for f in fixture.table(spark, sf, "lineitem").schema])
    twice.coalesce(1).write.parquet(str(tmp_path / "t"))
    (file,) = (tmp_path / "t").glob("*.parquet")
    (tmp_path / "lines").mkdir()
    shutil.copyfile(file, tmp_path / "lines" / "lineitem_0.parquet")
    got = critical.read_alerts(spark, critical.run_available_now(spark, sf, lines_dir=str(tmp_path / "lines")))
    assert got.groupBy(*got.columns).count().where("count % 2 = 1").isEmpty() and got.count() > 0


def test_lines_wait_for_their_order(spark, sf, pieces, tmp_path):
    tables = tmp_path / "tables"
    tables.mkdir()
    for t in ("lineitem", "customer", "part", "orders"):
        shutil.copyfile(f"{sf}/{t}.parquet", tables / f"{t}.parquet")
    whole = (tables / "orders.parquet").read_bytes()
    few = tmp_path / "few"
    fixture.table(spark, sf, "orders").where("o_orderkey % 3 = 0").coalesce(1).write.parquet(str(few))
    (file,) = few.glob("*.parquet")
    shutil.copyfile(file, tables / "orders.parquet")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    last = pieces / "lineitem_7.parquet"
    held = last.read_bytes()
    last.unlink()
    critical.run_available_now(spark, str(tables), out_path=out, checkpoint=ckpt, lines_dir=str(pieces), max_files_per_trigger=2)
    spark.catalog.clearCache()
    before = critical.read_alerts(spark, out).count()
    (tables / "orders.parquet").write_bytes(whole)
    last.write_bytes(held)
    critical.run_available_now(spark, str(tables), out_path=out, checkpoint=ckpt, lines_dir=str(pieces))
    assert before < _batch(spark, sf).count()
    _same(critical.read_alerts(spark, out), _batch(spark, sf))


def _critical_marts(spark, sf, p):
    """The batch marts' CRITICAL rows in the stream's columns."""
    from ledgerlens.operators import marts as M
    from ledgerlens.plans.jobs import staging_from_fixture
    stg = staging_from_fixture(spark, sf, p)
    credit, dead = M.credit_risk(stg, p, False), M.dead_stock(stg, p, False)
    rows = credit.where("alert_severity = 'CRITICAL'").select(
        F.lit("CREDIT_RISK").alias("alert_type"), "customer_id", "customer_name", "total_overdue_amount", "max_days_overdue", "oldest_unpaid_date",
        "recommended_action").collect()
    rows += dead.where("alert_severity = 'CRITICAL'").select(
        F.lit("DEAD_STOCK").alias("alert_type"), "product_id", "product_name", "total_quantity_ever_sold", "days_since_last_sale", "last_sale_date",
        "recommended_action").collect()
    return sorted(map(tuple, rows))


def _standing(spark, out):
    return sorted(map(tuple, entities.standing_alerts(spark, out).drop("as_of").collect()))


@pytest.mark.parametrize("per_batch, compact", [(1, 3), (3, 16), (64, 16)])
def test_entity_alerts_equal_the_marts_for_every_split(spark, sf, pieces, tmp_path, monkeypatch, per_batch, compact):
    monkeypatch.setattr(entities, "COMPACT", compact)
    out = str(tmp_path / "entities")
    critical.run_available_now(spark, sf, lines_dir=str(pieces), max_files_per_trigger=per_batch, entities_path=out,
                               out_path=str(tmp_path / "o"), checkpoint=str(tmp_path / "c"))
    want = _critical_marts(spark, sf, critical.DEFAULT)
    assert _standing(spark, out) == want and {r[0] for r in want} == {"CREDIT_RISK", "DEAD_STOCK"}
    assert not (tmp_path / "c-state" / "DEAD_STOCK" / "snapshot").exists() or compact == 3


def test_entity_alerts_after_a_restart_and_another_day(spark, sf, pieces, tmp_path, monkeypatch):
    """Half of the lines, a restart, the others; then a day passes: keys without a new line are judged again."""
    import datetime as dt
    from dataclasses import replace
    monkeypatch.setattr(entities, "COMPACT", 2)
    out, o, ckpt = (str(tmp_path / x) for x in ("entities", "o", "c"))
    p = critical.DEFAULT
    early = p.as_of - dt.timedelta(days=400)
    later = {n: (pieces / f"lineitem_{n}.parquet").read_bytes() for n in range(3, 8)}
    for n in later:
        (pieces / f"lineitem_{n}.parquet").unlink()
    run = dict(lines_dir=str(pieces), max_files_per_trigger=1, entities_path=out, out_path=o, checkpoint=ckpt)
    critical.run_available_now(spark, sf, p, today=lambda: early, **run)
    before = _standing(spark, out)
    for n in (3, 4, 5, 6):
        (pieces / f"lineitem_{n}.parquet").write_bytes(later[n])
    critical.run_available_now(spark, sf, p, today=lambda: early, **run)
    (pieces / "lineitem_7.parquet").write_bytes(later[7])
    critical.run_available_now(spark, sf, p, today=lambda: p.as_of, **run)
    assert _standing(spark, out) == _critical_marts(spark, sf, p) != before
    kinds = {r[0] for r in entities.read_events(spark, out).select("event").distinct().collect()}
    assert {"raised", "changed"} <= kinds
    # the last file's batch run again, with the same lines, replaces its own output
    deltas = tmp_path / "c-state" / "DEAD_STOCK" / "delta"
    batch = max(int(d.name) for d in deltas.iterdir() if not spark.read.schema("product_id string").parquet(str(d)).isEmpty())
    staged = critical.staged_lines(spark.read.parquet(str(pieces / "lineitem_7.parquet")).select(*critical.LINE_COLUMNS), spark, sf, p)

    def events():
        return sorted(map(tuple, entities.read_events(spark, out).where(f"batch_id = {batch}").collect()))
    first = events()
    entities.update(spark, staged, batch, f"{ckpt}-state", out, p, today=lambda: early)
    assert events() == first != []


def test_a_new_sale_clears_a_dead_product(spark, tmp_path):
    import datetime as dt
    p = critical.DEFAULT
    store, out = str(tmp_path / "s"), str(tmp_path / "e")
    schema = ("transaction_date date, customer_id string, product_id string, quantity decimal(18,4), total_amount decimal(18,4), "
              "payment_status string, payment_due_date date")

    def lines(*rows):
        return spark.createDataFrame([(d, c, i, Decimal(1), Decimal(amount), s, due) for d, c, i, amount, s, due in rows], schema)
    old = p.as_of - dt.timedelta(days=500)
    entities.update(spark, lines((old, "A", "P", 10, "UNPAID", old), (old, None, None, 5, "PAID", None)), 0, store, out, p)
    got = {(r.alert_type, r.entity_id) for r in entities.standing_alerts(spark, out).collect()}
    assert got == {("CREDIT_RISK", "A"), ("DEAD_STOCK", "P"), ("DEAD_STOCK", None)}
    entities.update(spark, lines((p.as_of, "B", "P", 10, "PAID", None)), 1, store, out, p)
    entities.update(spark, lines().limit(0), 2, store, out, p)
    got = {(r.alert_type, r.entity_id) for r in entities.standing_alerts(spark, out).collect()}
    assert got == {("CREDIT_RISK", "A"), ("DEAD_STOCK", None)}


def test_lines_without_a_key_are_rejected_not_kept_waiting(spark, sf, tmp_path):
    whole = fixture.table(spark, sf, "lineitem")
    bad = whole.limit(5).withColumn("l_orderkey", F.lit(None).cast(whole.schema["l_orderkey"].dataType))
    whole.limit(50).unionByName(bad).select(*[F.col(f.name).cast(f.dataType) for f in whole.schema]).coalesce(1).write.parquet(str(tmp_path / "t"))
    (file,) = (tmp_path / "t").glob("*.parquet")
    (tmp_path / "lines").mkdir()
    shutil.copyfile(file, tmp_path / "lines" / "lineitem_0.parquet")
    critical.run_available_now(spark, sf, lines_dir=str(tmp_path / "lines"), out_path=str(tmp_path / "o"), checkpoint=str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c-rejected")).count() >= 1
    assert spark.read.parquet(str(tmp_path / "c-pending")).where("l_orderkey IS NULL").isEmpty()


def test_a_folder_of_another_checkpoint_is_refused(spark, sf, tmp_path):
    out = critical.run_available_now(spark, sf, out_path=str(tmp_path / "out"), checkpoint=str(tmp_path / "a"))
    with pytest.raises(ValueError, match="checkpoint"):
        critical.run_available_now(spark, sf, out_path=out, checkpoint=str(tmp_path / "b"))


def test_waiting_lines_are_read_once(spark, tmp_path):
    """Lines whose order, customer or part is missing, with keys that repeat or are null; the lines go through one chain of joins."""
    from ledgerlens.streaming import critical
    spark.createDataFrame([(1, 1, "O", "1995-01-01"), (1, 1, "F", "1995-01-01"), (2, 9, "O", "1995-01-01"), (None, 1, "O", "1995-01-01")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(5, "p", 1, 1.0), (5, "q", 1, 1.0), (None, "r", 1, 1.0)],
                          "p_partkey long, p_name string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    rows = [(1, 5, 1), (1, 5, 1), (1, 6, 2), (2, 5, 3), (3, 5, 4), (None, 5, 5), (1, None, 6), (3, 5, 4)]
    lines = spark.createDataFrame([(o, p, 1.0, 1.0, n) for o, p, n in rows],
                                  "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_linenumber int")
    got = critical.waiting_lines(lines, spark, str(tmp_path))
    assert got.columns == lines.columns
    assert sorted(r.l_linenumber for r in got.collect()) == [2, 3, 4, 4, 5, 6]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_a_batch_joins_its_lines_to_the_tables_once_for_all_alerts(spark, sf, tmp_path, monkeypatch):
    from ledgerlens.streaming import critical
    calls = []
    staged = critical.staged_lines
    monkeypatch.setattr(critical, "staged_lines", lambda *a: calls.append(1) or staged(*a))
    critical.run_available_now(spark, sf, out_path=f"{tmp_path}/out", checkpoint=f"{tmp_path}/ckpt", entities_path=f"{tmp_path}/entities")
    assert len(calls) == len(list((tmp_path / "out").glob("batch_id=*"))) > 0
