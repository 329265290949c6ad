from __future__ import annotations

import pytest

from basketlens.llm import components, url_filter
from tools.check_oracles import differences

SCHEMA = "page_id bigint, url string, html string, host int, rule string, node string, verdict int, free int"


def canonical(url):
    return f'<head><link rel="canonical" href="{url}"></head>'


def refresh(url):
    return f'<head><meta http-equiv="refresh" content="0; url={url}"></head>'


# Pages, and the rule and verdict each should get.
PAGES = [
    (1, "http://a.org/1", canonical("http://spam.net/es/1"), None, "block"),
    (2, "http://a.org/2", canonical("http://a.org/1"), None, "block"),
    (3, "http://b.org/x", refresh("http://a.org/2"), None, "block"),
    (4, "http://shop.com/1", canonical("http://b.org/x"), "com/", "allow"),
    (5, "http://c.org/", canonical("http://shop.com/2"), None, "allow"),
    (6, "http://d.org/", "<p>none</p>", None, "allow"),
    (7, "http://X.Example.com/en/q?a=1#t", "", "example.com/en/", "block"),
    (8, "https://www.example.com/en/q", None, "www.example.com/en/", "allow"),
    (9, "https://m.www.example.com/en/", None, "www.example.com/en/", "allow"),
    (10, "https://notexample.com/en/", None, "com/", "allow"),
    (11, "http://example.com", None, None, "allow"),
    (12, "http://com/", None, "com/", "allow"),
    (13, "http://net/fr/", None, "net/fr/", "block"),
    (14, None, canonical("http://spam.net/es/1"), None, "allow"),
    (15, "no scheme", canonical("http://spam.net/es/1"), None, "allow"),
    (16, "", "", None, "allow"),
    (None, "http://a.org/1#part", "", None, "block"),
    (None, "http://a.org/1#part", "", None, "block"),
    (17, "HTTP://A.org/1", "", None, "block"),
    (18, "http://e.org/1?x=2", canonical("http://spam.net/fr/?q#z"), None, "block"),
    (19, "http://e.org/1", "", None, "allow"),
    (20, "http://f.org/1", f"<!-- {canonical('http://spam.net/es/1')} -->", None, "allow"),
    (21, "http://y.com?u=http://z.net/es/", "", None, "allow"),
]


def rows(pages=PAGES):
    return [(i, u, h, 1, "r", "n", 2, 3) for i, u, h, _, _ in pages]


def verdicts(df, **options):
    return sorted(((r.page_id, r.rule, r.verdict) for r in url_filter.url_filter(df, **options).collect()), key=repr)


def test_planted_pages(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    assert verdicts(df) == sorted(((i, r, v) for i, _, _, r, v in PAGES), key=repr)


def test_equals_sql(given):
    df, con = given("pages", rows(), SCHEMA)
    assert differences(url_filter.url_filter_query(df), con, url_filter.URL_FILTER_SQL) == []
    names = {r.page_id: (r.host, r.path) for r in url_filter.url_filter_query(df).collect()}
    assert names[7] == ("x.example.com", "/en/q") and names[14] == ("", "") and names[11] == ("example.com", "")


def test_without_links_or_rows(given):
    df, con = given("pages", [r for r in rows() if r[0] in (6, 7, 8)], SCHEMA)
    assert differences(url_filter.url_filter_query(df), con, url_filter.URL_FILTER_SQL) == []
    assert url_filter.url_filter_query(df.limit(0)).count() == 0


def test_redirect_table(spark):
    df = spark.createDataFrame(rows(PAGES[5:6]), SCHEMA)
    hops = [("http://d.org/", "http://t.org/1"), ("http://u.net/fr/", "http://t.org/1"), (None, "x"), ("y", None)]
    redirects = spark.createDataFrame(hops, "source string, target string")
    assert verdicts(df, redirects=redirects) == [(6, None, "block")]


@pytest.mark.parametrize(
    "html,targets",
    [
        ("<LINK HREF='/q?a=1&amp;b=2' REL='alternate Canonical'>", ["http://h.org/q?a=1&b=2"]),
        ("<link rel=canonical href=//o.org/x>", ["http://o.org/x"]),
        ("<link rel=canonical href='../up'>", ["http://h.org/up"]),
        ("<link rel=canonical><link rel=canonical href=' '>", []),
        ("<link rel=stylesheet href=/s>", []),
        ("<link rel=canonical href='http://[bad'>", []),
        ("<link rel=canonical href='mailto:x'>", []),
        ("<script>'<link rel=canonical href=/no>'</script><link rel=canonical href=/yes>", ["http://h.org/yes"]),
        ("<style><link rel=canonical href=/no>", []),
        ("<meta HTTP-EQUIV=Refresh content=\"5;URL='/n'\">", ["http://h.org/n"]),
        ("<meta http-equiv=refresh content=5>", []),
        ("<!-- <link rel=canonical href=/no>", []),
    ],
)
def test_links_of_a_page(html, targets):
    assert url_filter.link_targets("http://h.org/a/b", html) == targets


def test_long_pages_take_time_in_proportion():
    for part in ("<link ", "<!--", "<script", 'a="', "<link rel=", "<meta " + "a" * 50):
        url_filter.link_targets("http://h.org/", part * 200_000)


def test_every_page_of_a_hot_class_is_blocked(spark):
    pages = [(i, f"http://s{i}.org/", canonical("http://hub.org/"), 1, "", "", 1, 1) for i in range(3000)]
    pages += [(9999, "http://hub.org/", canonical("http://bad.net/es/"), 1, "", "", 1, 1)]
    pages += [(20_000 + i, "http://hub.org/", "", 1, "", "", 1, 1) for i in range(500)]
    result = url_filter.url_filter_query(spark.createDataFrame(pages, SCHEMA))
    assert result.where("verdict = 'block'").count() == result.count() == 3501


def test_rules_of_equal_length(spark):
    rules = [("allow", "b.org", "/"), ("block", "org", "/aa/"), ("block", "b.org", "/")]
    df = spark.createDataFrame([(1, "http://b.org/aa/", "", 1, "", "", 1, 1)], SCHEMA)
    assert verdicts(df, rules=rules) == [(1, "org/aa/", "block")]


def test_least_value_of_spread_keys(spark):
    df = spark.createDataFrame([(i % 3, i, i * 7 % 101) for i in range(900)] + [(None, 1, 1)], "k int, s int, v int")
    got = components.with_least(df, "k", "v", "s").collect()
    least = {k: min(i * 7 % 101 for i in range(900) if i % 3 == k) for k in range(3)}
    assert len(got) == 900 and all(r.m == least[r.k] for r in got)
