"""URL judgements against a plain reading of the rules."""

import re

from vacancia.llm import url_filter
from vacancia.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "http://ORG", "http://org/", "http://example.org/es/1", "https://a.Example.org/en/1?x#y",
    "http://example.org/en/2", "http://notexample.org/es/1", "x://y.com/fr/", "x://com/de", "ftp://com/de/z", "http://com?/de/",
    "http://a.com#/fr/", "http://example.org:80/es/", "http://..org/", "http://org./", "a://b://org/", "http://e.org/é\n/", "http://com/fr/de/",
    "http://www.example.org/en/12345" + "x" * 5000,
]


def judged(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(h + p), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[2] if fits else None, max(fits)[1] if fits else "allow"


def rules_df(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def test_equals_reading_the_rules(spark):
    rules = [*URL_RULES, ("example.org", "/en/1", "allow"), ("a.b.c.org", "", "block"), ("e.org", "/é", "block")]
    rows = [(i, u, "clash", "clash") for i, u in enumerate(URLS + URLS)] + [(None, URLS[6], "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule_id string, short string")
    got = url_filter.judge(pages.select("page_id", "url"), rules_df(spark, rules)).collect()
    want = [(i, *judged(u, rules)) for i, u, *_ in rows]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=key) == sorted(want, key=key)


def test_no_rules_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://org/")], "page_id long, url string")
    assert url_filter.judge(pages, rules_df(spark, [])).first().verdict == "allow"
    assert url_filter.judge(pages, rules_df(spark, [(None, "/", "block"), ("org", "/", None)])).first().rule is None
    assert url_filter.judge(pages.limit(0), rules_df(spark, URL_RULES)).collect() == []


def test_many_rules_are_joined(spark):
    rules = [(f"h{i}.org", f"/p{i % 7}", "block") for i in range(5000)]
    pages = spark.createDataFrame([(i, f"http://x.h{i}.org/p{i % 5}") for i in range(300)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, rules_df(spark, rules)).collect()}
    assert got == {i: "block" if i % 5 == i % 7 else "allow" for i in range(300)}
