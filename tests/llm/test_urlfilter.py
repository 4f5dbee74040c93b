import math
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerlens.llm import queries
from ledgerlens.llm import urlfilter as U


def split(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    end = min([len(rest), *(rest.find(c) for c in "/?#" if c in rest)])
    host, tail = rest[:end], rest[end:]
    path = tail[: min([len(tail), *(tail.find(c) for c in "?#" if c in tail)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    best = None
    for act, h, p in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[1])):
            best = act, h + p
    return best


def brute_model(counts, order):
    """Witten-Bell smoothed log ratio of every (order+1)-gram, by recursion."""
    n = [defaultdict(lambda: [0, 0]) for _ in range(order + 2)]
    for g, (a, r) in counts.items():
        for size in range(1, order + 2):
            n[size][g[-size:]][0] += a
            n[size][g[-size:]][1] += r
    kinds = len(n[1])

    def p(g, k):
        if not g:
            return 1 / (kinds + 1)
        peers = [v[k] for h, v in n[len(g)].items() if h[:-1] == g[:-1]]
        total, seen = sum(peers), sum(v > 0 for v in peers)
        return (n[len(g)][g][k] + seen * p(g[1:], k)) / (total + seen) if total + seen else p(g[1:], k)

    return {g: math.log(p(g, 0)) - math.log(p(g, 1)) for g in counts}


def test_query_rules(spark, sf):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op6_url_filter(spark, sf).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(urls)
    for r in rows:
        host, path = split(urls[r["page_id"]])
        rule = ruled(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[1])
        assert r["verdict"] in ("allow", "block") and (rule is None or r["verdict"] == rule[0])


def test_model_against_recursion(spark):
    counts = {"\u0002\u0002a": (3, 0), "\u0002ab": (2, 1), "abc": (1, 1), "bca": (0, 2), "\u0002aa": (0, 0), "caa": (5, 0), "aab": (0, 4), "xab": (0, 0)}
    df = spark.createDataFrame([(g, a, r) for g, (a, r) in counts.items()], "g string, n_a long, n_r long")
    got = {r["g"]: r["d"] for r in U.model(df, 2).collect()}
    want = brute_model(counts, 2)
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-9 for g in want)


def test_scores_of_a_small_table_by_brute_force(spark, tmp_path):
    urls = [f"http://{'good' if i % 2 else 'evil'}-{i % 7}.{'org/fr/' if i % 2 else 'net/x/'}{i}" for i in range(60)] + ["http://good-1.org/de/1", "ftp://q"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r for r in U.judge(df).collect()}
    fold = {r["page_id"]: r["k"] for r in df.select("page_id", (F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(5)) == 0).alias("k")).collect()}
    grams = [[(U.START * 4 + u + U.END)[i: i + 5] for i in range(len(u) + 1)] for u in urls]
    counts = {}
    for i, gs in enumerate(grams):
        rule = ruled(*split(urls[i]))
        for g in gs:
            c = counts.setdefault(g, [0, 0])
            if rule and not fold[i]:
                c[rule[0] == "block"] += 1
    d = brute_model(counts, 4)
    for i, gs in enumerate(grams):
        assert abs(got[i]["score"] - sum(d[g] for g in gs) / len(gs)) < 1e-6
    assert got[60]["verdict"] == "allow"


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.Example.NET/en/x?y#z"), (6, "http://net"), (7, "http://net/"), (8, "x://y.org?/fr/"),
            (9, "http://ÄB.org/fr/é\U0001f600"), (9, "http://ÄB.org/fr/é\U0001f600"), (None, "http://a.example.com/de/"), (10, "http://a.org/fr/" + "x" * 20_000)]
    df = spark.createDataFrame([(i, u, "h", "p", "t") for i, u in rows], "page_id long, url string, host string, score string, rid string")
    got = U.judge(df).collect()
    assert len(got) == len(rows)
    for r in got:
        urls = [u for i, u in rows if i == r["page_id"]]
        assert (r["host"], r["path"]) in [split(u) for u in urls]
    rule = {r["page_id"]: r["rule"] for r in got}
    assert rule[5] == "example.net/en/" and rule[6] is None and rule[7] == "net/" and rule[8] is None and rule[None] == "example.com/de/"
    assert U.judge(df.limit(0)).collect() == []
