import pytest

from salesloom.llm.url_filter import RULES, filter_urls

CASES = [
    ("http://example.org/en/1", "example.org", "/en/1", None, "allow"),
    ("https://a.example.com/en/x?y#z", "a.example.com", "/en/x", "example.com/en/", "block"),
    ("https://WWW.Example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://x.www.example.com/en/a", "x.www.example.com", "/en/a", "www.example.com/en/", "allow"),
    ("https://www.example.com/En/", "www.example.com", "/En/", "com/", "allow"),
    ("ftp://badexample.com/en/1", "badexample.com", "/en/1", "com/", "allow"),
    ("http://com", "com", "", None, "allow"),
    ("http://com/", "com", "/", "com/", "allow"),
    ("http://a.net?/es/", "a.net", "", None, "allow"),
    ("http://a.net/es/?q=://x/fr/", "a.net", "/es/", "net/es/", "block"),
    ("http://net/fr/a://b", "net", "/fr/a://b", "net/fr/", "block"),
    ("no scheme.com/en/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http:///en/", "", "/en/", None, "allow"),
    ("x" * 200_000 + "://" + "a." * 20_000 + "net/fr/" + "p" * 100_000, "a." * 20_000 + "net", "/fr/" + "p" * 100_000, "net/fr/", "block"),
]


def test_cases_and_repeats(spark):
    rows = [(i, c[0], "own") for i, c in enumerate(CASES)] * 3 + [(None, CASES[0][0], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, Host string")
    out = filter_urls(pages)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule, r.verdict) == CASES[r.page_id][1:]
    assert filter_urls(pages.limit(0)).count() == 0


def test_other_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b.c/xy"), (2, "http://b.c"), (3, "http://c/x")], "page_id long, url string")
    rules = [("block", "C", ""), ("allow", "c", ""), ("allow", "b.c", "/x"), ("block", "a.b.c", "/xyz")]
    got = {r.page_id: (r.rule, r.verdict) for r in filter_urls(pages, rules).collect()}
    assert got == {1: ("b.c/x", "allow"), 2: ("c", "block"), 3: ("c", "block")}
    assert {r.verdict for r in filter_urls(pages, [], default="block").collect()} == {"block"}
    for bad in ([("deny", "a", "/")], [("allow", "", "/")], [("allow", "a/b", "/")], [("allow", "a", "b")]):
        with pytest.raises(ValueError):
            filter_urls(pages, bad)


def test_hot_urls_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, "http://a.example.com/en/1" if i % 3 else f"http://h{i}.net/es/") for i in range(300)]
        pages = spark.createDataFrame(rows, "page_id long, url string")
        assert {r.verdict for r in filter_urls(pages, RULES).collect()} == {"block"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
