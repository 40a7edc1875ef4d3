import xxhash

from salesflow.llm import urls
from salesflow.llm.queries import URL_RULES


def test_contract_rules(spark):
    rows = [
        (1, "http://A.Example.NET/en/x?y#z"), (2, "https://example.net/de/"), (3, "ftp://b.example.com/de/1"),
        (4, "http://example.com/fr/"), (5, "http://x.org/fr/a"), (6, "http://x.org/en/"), (7, "http://myexample.net/en/"),
        (8, "http://a.net"), (9, None), (10, ""), (11, "no scheme/net/"), (12, "a://b://net/"), (13, "://net/q"),
        (14, "http://net/" + "long/" * 40_000), (14, "http://net/a\nb"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = [tuple(r) for r in urls.judge(pages, urls.rule_table(spark, URL_RULES)).drop("url", "path").collect()]
    assert got == [
        (1, "a.example.net", "example.net/en/", "allow"), (2, "example.net", "net/", "block"),
        (3, "b.example.com", "example.com/de/", "block"), (4, "example.com", None, "allow"),
        (5, "x.org", "org/fr/", "allow"), (6, "x.org", None, "allow"), (7, "myexample.net", "net/", "block"),
        (8, "a.net", None, "allow"), (9, "", None, "allow"), (10, "", None, "allow"), (11, "", None, "allow"),
        (12, "b:", None, "allow"), (13, "net", "net/", "block"), (14, "net", "net/", "block"), (14, "net", "net/", "block"),
    ]


def test_equal_keys_are_told_apart(tmp_path, monkeypatch):
    """All strings share one key: only the stored strings decide."""
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda *_: 7)
    rules = [(7, "a.com", "/", 1), (7, "b.com", "/x", 0), (7, "c.com", "", 1)]
    file = tmp_path / "rules"
    file.write_bytes(b"".join(urls._rule_bytes(iter(rules), len(rules))))
    array = urls.DigestArray(str(file))
    got = array.lookup(["z.b.com", "b.com", "c.com", "d.com", ""], ["/xy", "/", "/q", "/", "/"])
    assert got == [("b.com/x", "allow"), (None, None), ("c.com", "block"), (None, None), (None, None)]


def test_longest_rule_and_ties(spark):
    rules = [("com", "/abc", "block"), ("x.com", "/a", "allow"), ("x.com", "/abc", "block"), ("x.com", "/abc", "allow"),
             (None, "/", "block"), ("y.com", None, "block"), ("q.com", "/", None)]
    pages = spark.createDataFrame([("http://x.com/ab",), ("http://x.com/abcd",), ("http://w.y.com",), ("http://q.com/",)], "url string")
    judged = urls.judge(pages, urls.rule_table(spark, rules), default="none")
    assert [(r["rule"], r["verdict"]) for r in judged.collect()] == [
        ("x.com/a", "allow"), ("x.com/abc", "block"), ("y.com", "block"), (None, "none"),
    ]


def test_empty_tables_and_clashing_names(spark):
    rules = urls.rule_table(spark, URL_RULES)
    none = spark.createDataFrame([], "url string, rule int")
    assert urls.judge(none, rules).count() == 0
    pages = spark.createDataFrame([("http://a.net/", 1, 2, "k")], "url string, rule int, _found int, host string")
    row = urls.judge(pages, rules).first()
    assert (row["rule"], row["_found"], row["host"]) == ("net/", 2, "a.net")
    row = urls.judge(pages, rules.limit(0)).first()
    assert (row["rule"], row["verdict"]) == (None, "allow")


def test_long_urls_take_little_memory(tmp_path):
    import tracemalloc

    rules = [("example.com", "/", 1), ("com", "", 0)]
    keyed = sorted((urls.xxhash.xxh64_intdigest((h + p).encode(), 42), h, p, v) for h, p, v in rules)
    with open(tmp_path / "rules", "wb") as file:
        file.writelines(urls._rule_bytes(iter(keyed), len(keyed)))
    rules = urls.DigestArray(str(tmp_path / "rules"))
    host = "a." * 100_000
    tracemalloc.start()
    found = rules.lookup([host, host + "example.com", host + "com", host], ["/", "/" + "x." * 100_000, "", "/y"])
    assert tracemalloc.get_traced_memory()[1] < 50_000_000
    tracemalloc.stop()
    assert found == [(None, None), ("example.com/", "block"), ("com", "allow"), (None, None)]
