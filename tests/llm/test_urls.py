from comarca.llm import queries, urls

URLS = [
    None, "", "no scheme", "http://a.example.org/en/123", "HTTPS://A.EXAMPLE.ORG/es/x?y#z", "http://example.org/es", "http://example.org",
    "http://example.com/fr/1", "http://x.com/de/", "http://xcom/de/", "http://com/de/", "http://notexample.org/en/1", "http://a.b.c.d.e.example.org/en/1",
    "x://y://z.org/", "http://h.org?x", "http://h.org#f", "http://ÄÖ.org/Ä", "http://example.org/en/1", "http://example.org/en/1", "http://.org/", "http://org:80/",
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(v, h + p) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    verdict, rule = max(fits, key=lambda f: len(f[1])) if fits else ("allow", None)
    return host, path, rule, verdict


def test_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = urls.judge(pages, urls.rule_table(spark, queries.URL_RULES)).collect()
    assert len(got) == len(URLS)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    assert {r.verdict for r in urls.judge(pages, urls.rule_table(spark, queries.URL_RULES[:1]).where("false")).collect()} == {"allow"}
    assert urls.judge(pages.where("false"), urls.rule_table(spark, queries.URL_RULES)).count() == 0


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://example.org/en/1", "x", 3)], "page_id long, url string, host string, verdict int")
    got = urls.judge(pages, urls.rule_table(spark, queries.URL_RULES)).first()
    assert (got.host, got.verdict) == ("example.org", "block")


def test_repeated_rules_two_verdicts_and_long_urls(spark):
    rules = [("allow", "org", "/a"), ("allow", "org", "/a"), ("block", "b.org", "/"), ("allow", "b.org", "/"), ("block", "c.org", "/" + "x" * 5000)]
    long = "http://" + "a." * 300 + "b.org/" + "y" * 200_000
    pages = spark.createDataFrame([(1, "http://org/a"), (2, long), (3, "http://c.org/" + "x" * 5001), (4, "http://c.org/" + "x" * 4999)], "page_id long, url string")
    got = {r.page_id: (r.rule and r.rule[:6], r.verdict, len(r.path)) for r in urls.judge(pages, urls.rule_table(spark, rules)).collect()}
    assert got == {1: ("org/a", "allow", 2), 2: ("b.org/", "block", 200_001), 3: ("c.org/", "block", 5002), 4: (None, "allow", 5000)}


def test_plan_does_not_grow_with_the_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")

    def size(n):
        rules = [("block", ".".join("h" * (i % 7 + 1)), "/" * (i % 50)) for i in range(n)]
        return urls.judge(pages, spark.createDataFrame(rules, "verdict string, rule_host string, rule_path string"))._jdf.queryExecution().optimizedPlan().toString().count("sha2")

    assert size(500) == size(5)
