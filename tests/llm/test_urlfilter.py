import pytest

from shoplake.llm.queries import RULES, op2_url_rules
from shoplake.llm.urlfilter import judged

URLS = [
    None, "", "no scheme", "http://", "http://example.com", "http://example.com/", "HTTP://WWW.Example.COM/en/x?y#z",
    "https://example.com/en/", "https://a.example.com/en/q", "https://badexample.com/en/", "https://shop.net/es/a",
    "https://net/fr/", "ftp://x.org/://y.com/", "http://a.b.c.d.e.com/x", "http://example.com?/en/", "http://example.com#/en/",
    "x://EXAMPLE.com/EN/", "http://example.com:80/en/", "http://.com/", "http://com./", "http://" + "a." * 5000 + "com/" + "d/" * 5000,
]


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


@pytest.mark.parametrize(
    "rules", [RULES, [], [("com", "", "block"), ("b.c.d.e.com", "/", "allow"), ("net", "/f", "block"), ("com", "/e", "allow")]]
)
def test_against_each_rule_by_itself(spark, rules):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(1, ""), (None, URLS[6])], "page_id long, url string")
    pages = pages.selectExpr("*", "'x' as host", "'y' as count", "'z' as rule")
    got = judged(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    want = [(i, *brute(u, rules)) for i, u in enumerate(URLS)] + [(1, *brute("", rules)), (None, *brute(URLS[6], rules))]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_no_rows(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judged(pages, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect() == []


def test_query_reads_two_columns(spark, sf_dir):
    plan = op2_url_rules(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "html" not in plan.split("Relation")[0]


def test_copies_come_back_run_by_run(spark, monkeypatch):
    monkeypatch.setattr("shoplake.llm.urlfilter.COPIES", 4)
    pages = spark.createDataFrame([(i, "http://a.com/") for i in range(5) for _ in range(3 * i + 1)], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert sorted(r.page_id for r in judged(pages, rules).collect()) == sorted(r.page_id for r in pages.collect())
