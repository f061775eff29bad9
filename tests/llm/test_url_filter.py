import random

from siltstone.llm.url_filter import RULES, filter_urls, rule_frame

KIND = "page_id long, url string, host string, short string"


def brute(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    stop = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop])
    path = rest[stop:]
    path = path[: min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def run(spark, rows, rules):
    got = filter_urls(spark.createDataFrame(rows, KIND), rule_frame(spark, rules)).collect()
    want = [(r[0], *brute(r[1], rules)) for r in rows]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def test_edges(spark):
    urls = [
        None, "", "no scheme", "http://", "http://NET/", "http://net", "http://net?x/", "http://a.Net/#/", "http://xnet/", "a://b://net/",
        "http://EXAMPLE.net/en/", "http://a.example.net/en/x?y", "http://example.net/en", "http://example.net/EN/", "https://m.example.com/de/1",
        "http://org/fr/", "http://a.b.c.org/fr/x", "http://a.org/fr", "http://é.org/fr/ü", "http://x.net\n/en/", "http://" + "a." * 300 + "net/" + "b/" * 300,
    ]
    run(spark, [(i, u, "x", "y") for i, u in enumerate(urls)] + [(1, "http://net/", "x", None)] * 40 + [(None, "http://net/", None, None)] * 3, RULES)
    run(spark, [(1, "http://net/", "x", "y")], [])
    assert filter_urls(spark.createDataFrame([], KIND), rule_frame(spark, RULES)).count() == 0


def test_against_brute_force_without_broadcast(spark):
    rng = random.Random(5)
    label, part = ["a", "b", "net", "org", "example"], ["", "x", "y", "en"]
    rules = {("block" if rng.random() < 0.5 else "allow", ".".join(rng.choices(label, k=rng.randint(1, 3))), "/" + "".join(p + "/" for p in rng.choices(part[1:], k=rng.randint(0, 2)))) for _ in range(60)}
    unique = list({(h, p): (v, h, p) for v, h, p in sorted(rules)}.values())
    rows = [(i, "http://" + ".".join(rng.choices(label, k=rng.randint(1, 5))) + "".join("/" + p for p in rng.choices(part, k=rng.randint(0, 4))), "", "") for i in range(400)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run(spark, rows, unique)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
