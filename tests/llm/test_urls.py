import random

from tailwake.llm import urls


def brute(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def judged(spark, listed, rules):
    pages = spark.createDataFrame(list(enumerate(listed)), "page_id long, url string")
    table = urls.rules_table(spark, rules)
    return {r["page_id"]: tuple(r)[1:] for r in urls.judge_urls(pages, table).collect()}


def test_contract_rules(spark):
    listed = [
        None, "", "no scheme", "http://NET/", "http://a.net/x?y", "https://www.Example.NET/en/1#t",
        "http://example.net/eng", "http://notnet/", "http://example.com/de/1", "http://example.com/de",
        "http://org/fr/?q", "http://a.b.org/FR/", "http://x.com://net/", "http://a..net/", "://net/",
        "http://net?x", "http://net#/", "http://ÄÖ.net/", "http://example.com:80/de/",
    ]
    found = judged(spark, listed, urls.RULES)
    for i, url in enumerate(listed):
        assert found[i] == brute(url, urls.RULES), url


def test_nested_rules_against_brute_force(spark):
    rng = random.Random(2)
    labels = ["a", "b", "c", "com", "net", "co-op", "x1"]

    def host():
        return ".".join(rng.choices(labels, k=rng.randint(1, 5)))

    rules = {(host(), rng.choice(["", "/", "/p", "/p/q/"])) for _ in range(120)}
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in sorted(rules)]
    listed = [f"http://{host()}{rng.choice(['', '/', '/p', '/p/q/r', '/z?p'])}" for _ in range(600)]
    found = judged(spark, listed, rules)
    for i, url in enumerate(listed):
        assert found[i] == brute(url, rules), url


def test_odd_tables(spark):
    assert judged(spark, ["http://a.net/"], ()) == {0: ("a.net", "/", None, "allow")}
    rules = [(None, "/", "block"), ("net", None, "block"), ("net", "/", "allow"), ("net", "/", "block")]
    assert judged(spark, ["http://a.net/"] * 2, rules)[1] == ("a.net", "/", "net/", "block")
    pages = spark.createDataFrame(
        [(None, "http://a.net/", "h", 1), (None, "http://a.net/", "h", 1)],
        "page_id long, url string, host string, stack int",
    )
    table = urls.rules_table(spark)
    assert [tuple(r) for r in urls.judge_urls(pages, table).collect()] == [
        (None, "a.net", "/", "net/", "block")
    ] * 2
    assert urls.judge_urls(pages.limit(0), table).count() == 0


def test_no_python_and_no_cross_join(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    plan = urls.judge_urls(pages, urls.rules_table(spark))._jdf.queryExecution().toString()
    for word in ("Python", "Arrow", "ExistingRDD", "CartesianProduct", "NestedLoop"):
        assert word not in plan
