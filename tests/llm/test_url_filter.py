from __future__ import annotations

import re

from opinara.llm.queries import URL_RULES
from opinara.llm.url_filter import Rule, filter_urls

STRICT, SOFT = ("porn", "xxx"), {"cheap": 1.0, "pills": 1.0, "pill": 1.0, "win": 0.5}


def verdicts(spark, urls, **options):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    return [r["url_filter"] for r in filter_urls(pages, **options).orderBy("page_id").collect()]


def test_terms_need_boundaries(spark):
    urls = [
        "https://porn.example/", "https://pornographic.example/", "https://a.b/my-xxx_1", "https://a.b/axxx", "https://a.b/xxx9",
        "https://a.b/cheap", "https://a.b/cheap/cheap", "https://cheap-pills.b/", "https://a.b/cheap?q=pill", "https://a.b/CHEAP-Pills",
        "https://a.b/éxxx", "https://a.b/buy%20xxx", "https://a.b/win-cheap", "https://a.b/win", "xxx", "https://a.b/cheappills",
    ]
    blocked = [0, 2, 7, 8, 9, 11, 14]
    got = verdicts(spark, urls, strict=STRICT, soft=SOFT)
    assert [k for k, r in enumerate(got) if r["verdict"] == "block"] == blocked
    assert got[7]["soft"] == ["cheap", "pills"] and got[2]["strict"] == ["xxx"] and got[6]["n_hits"] == 2
    assert [r["verdict"] for r in verdicts(spark, ["https://a.b/win-cheap"], strict=STRICT, soft=SOFT, limit=1.5)] == ["block"]


def test_terms_as_by_one_pattern_each(spark):
    parts = ["porn", "xxx", "cheap", "pills", "pill", "win", "-", "/", ".", "a", "9", "%2f", "É", "X"]
    state, urls = 7, []
    for _ in range(400):
        url = "http://h/"
        for _ in range(6):
            state = state * 1103515245 + 12345 & 0x7FFFFFFF
            url += parts[state >> 8 & 15] if (state >> 8 & 15) < len(parts) else "_"
        urls.append(url)
    for url, row in zip(urls, verdicts(spark, urls, strict=STRICT, soft=SOFT), strict=True):
        text = re.sub("%[0-9a-f]{2}", "   ", re.sub("[A-Z]", lambda m: m[0].lower(), url))
        inside = {t: len(re.findall(rf"(?<![0-9a-z\x80-\U0010ffff]){t}(?![0-9a-z\x80-\U0010ffff])", text)) for t in (*STRICT, *SOFT)}
        assert row["strict"] == sorted(t for t in STRICT if inside[t]) and row["soft"] == sorted(t for t in SOFT if inside[t])
        assert row["n_hits"] == sum(inside.values())
        bad = row["strict"] or sum(SOFT[t] for t in row["soft"]) >= 2
        assert row["verdict"] == ("block" if bad else "allow")


def test_longest_rule_wins(spark):
    cases = {
        "http://a.net/x": "net/", "http://a.net": None, "http://Example.NET/en/1?x": "example.net/en/",
        "https://m.example.net/en/": "example.net/en/", "https://badexample.net/en/": "net/", "https://m.example.net/EN/": "net/",
        "http://w.example.com/de/1#x": "example.com/de/", "http://example.com/d": None, "http://example.org/fr/": "org/fr/",
        "http://org/fr/xxx": "org/fr/", "http://a.org?x=/fr/": None, "http://a.net:80/": None, "net/": None,
    }
    got = verdicts(spark, list(cases), rules=URL_RULES)
    assert [r["rule"] for r in got] == list(cases.values())
    by_name = {r.host + r.path: r.verdict for r in URL_RULES}
    assert all(r["verdict"] == by_name[r["rule"]] for r in got if r["rule"])
    assert (got[2]["host"], got[2]["path"]) == ("example.net", "/en/1")


def test_equal_rules(spark):
    rules = [Rule("allow", "b.c", "/x"), Rule("block", "a.b.c"), Rule("allow", "q.r", "/"), Rule("block", "q.r", "/")]
    got = verdicts(spark, ["http://a.b.c/x", "http://q.r/"], rules=rules)
    assert [(r["rule"], r["verdict"]) for r in got] == [("a.b.c", "block"), ("q.r/", "block")]


def test_odd_rows(spark):
    long = "http://h/" + "a-" * 100_000 + "xxx"
    rows = [(1, None), (2, ""), (3, "no scheme"), (3, "no scheme"), (None, "x://"), (6, long), (7, "://H?://b/"), (8, "a://b\nc/d\ne")]
    pages = spark.createDataFrame([(*r, "r", 1) for r in rows], "page_id long, url string, row string, url_filter int")
    found = filter_urls(pages, URL_RULES)
    assert found.columns == ["page_id", "url", "row", "url_filter"]
    got = [r["url_filter"] for r in found.collect()]
    assert [(r["host"], r["path"]) for r in got if r["path"] is not None and len(r["path"]) < 99] == [
        ("", ""), ("", ""), ("", ""), ("", ""), ("", ""), ("h", ""), ("b\nc", "/d\ne"),
    ]
    assert [r["verdict"] for r in got] == ["allow"] * 5 + ["block"] + ["allow"] * 2
    assert filter_urls(pages.where("false")).collect() == []
    assert {r["verdict"] for r in verdicts(spark, ["http://xxx/", "http://b/"], strict=["", "xxx"], soft={"": 9.0, "XXX": 1.0})} == {"block", "allow"}
    assert verdicts(spark, ["http://xxx/"], strict=(), soft={})[0]["verdict"] == "allow"
