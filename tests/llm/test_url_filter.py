import random
from collections import Counter

from stemma.llm import url_filter as U


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[2] if best else default


ODD = [None, "", "no scheme", "://", "http://", "http://COM", "http://com/", "http://a.example.com/en", "http://a.example.com/en/x?y#z", "http://www.example.com/en/1", "http://x.www.EXAMPLE.com/en/", "http://notexample.com/en/", "http://é.net/fr/ü", "http://net/es/", "http://a.net?/es/", "http://a.net/es/#", "x://y://example.com/en/", "http://.com/", "http://" + "a." * 3000 + "com/" + "p/" * 3000]


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] * 2, "page_id bigint, url string, host string, rule string")
    got = Counter(map(tuple, U.verdicts(pages.repartition(3), U.rule_table(spark, rules)).collect()))
    assert got == Counter({(i, *brute(u, rules)): 2 for i, u in enumerate(urls)})


def test_contract_rules(spark):
    check(spark, ODD, U.RULES)


def test_random(spark):
    random.seed(6)
    part = lambda: random.choice(["a", "b", "ab", "c.a", "b.c"])
    urls = [f"http://{'.'.join(part() for _ in range(random.randint(1, 4)))}{''.join('/' + part() for _ in range(random.randint(0, 4)))}{random.choice(['', '/', '?q', '#f'])}" for _ in range(300)]
    rules = list({(part(), random.choice(["/", "/a", "/a/", "/ab", "/b/c"])): random.choice(["allow", "block"]) for _ in range(15)}.items())
    check(spark, urls, [(h, p, v) for (h, p), v in rules])


def test_many_rules_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(U, "BROADCAST_RULES", 0)
    check(spark, ODD, U.RULES)


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert U.verdicts(pages, U.rule_table(spark)).collect() == []
    one = spark.createDataFrame([(1, "http://a.com/"), (None, None)], "page_id bigint, url string")
    assert {tuple(r) for r in U.verdicts(one, U.rule_table(spark, [])).collect()} == {(1, "a.com", "/", None, "allow"), (None, "", "", None, "allow")}
