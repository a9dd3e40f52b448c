import random

from opinio.llm.url_rules import judge_urls


def canon(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:]
    return host, path[:next((i for i, c in enumerate(path) if c in "?#"), len(path))]


def brute(url, rules):
    host, path = canon(url)
    fit = [(len(h + (p or "")), len(h), v == "block", h + (p or ""), v) for h, p, v in rules if h is not None
           and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_matches_brute_force(spark):
    rnd = random.Random(5)
    labels = ["a", "b", "com", "net", "www", "a-b", "x1", "é", ""]
    host = lambda: ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4)))
    path = lambda: "".join(rnd.choice(["/", "a", "en/", "b"]) for _ in range(rnd.randint(0, 4)))
    rules = list({(host(), path()): rnd.choice(["allow", "block"]) for _ in range(120)}.items())
    rules = [(h, p, v) for (h, p), v in rules if h] + [("com", "", "allow"), ("com", "", "block"), (None, "/", "block"),
                                                       ("net", None, "block")]
    urls = [f"http://{host()}{path()}{rnd.choice(['', '?q=/en/', '#a'])}" for _ in range(1500)]
    urls += ["HTTP://WWW.Com/en/"] * 900 + [None, "", "no scheme", "http://", "://com", "x://com?a://b/", "a/b://com/a"]
    rows = [(i if i % 97 else None, u, "r") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = [(i, *brute(u, rules)) for i, u, _ in rows]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_no_rules_and_empty_table(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in judge_urls(df, none, default="block").collect()] == [(1, "a.com", "/", None, "block")]
    assert judge_urls(df.limit(0), none).count() == 0
