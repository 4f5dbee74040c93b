"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3, after one warm-up), BENCH_KEYS (comma list, optional).
Each query is run to the ``noop`` sink, so the full plan executes and nothing
is collected to the driver."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans import catalog  # noqa: E402
from ledgerlens.session import get_session  # noqa: E402

HEADLINE = ("staging", "sales_enriched", "mart_dead_stock", "mart_low_margin", "mart_credit_risk",
            "balanced_alerts", "daily_digest", "dq_report", "clean_sales", "daily_job")


def daily_job(spark, sf_dir):
    """The whole daily run as production does it: staging written once as a table
    and shared by the three marts, marts saved as tables under the shared folder,
    alerts and the digest read from the saved marts."""
    from ledgerlens.config import DEFAULT
    from ledgerlens.operators import alerts as A
    from ledgerlens.plans import jobs
    from ledgerlens.session import shared_path
    from ledgerlens.sources import fixture, tables
    m = jobs.build_marts(spark, fixture.raw_sales(spark, sf_dir), DEFAULT, materialize="table")
    loc = shared_path(spark, "bench-marts")
    for name, mart in (("credit_risk", m.credit_risk), ("dead_stock", m.dead_stock), ("low_margin_sales", m.low_margin)):
        assert tables.load_table(mart, f"bench_mart_{name}", path=f"{loc}/{name}")
    alerts = jobs.alerts_from_tables(spark, DEFAULT, prefix="bench_mart_")
    A.daily_digest(spark, A.balanced_alerts(alerts, DEFAULT)).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = [k for k in os.environ.get("BENCH_KEYS", ",".join(HEADLINE)).split(",") if k]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2)
    qs = catalog.queries()
    out = {}
    for k in keys:
        if k not in qs and k != "daily_job":
            continue
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            if k == "daily_job":
                daily_job(spark, sf_dir)
            else:
                qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                times.append(time.perf_counter() - t0)
        out[k] = round(statistics.median(times), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "median_query_seconds_total", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "runs": runs, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
