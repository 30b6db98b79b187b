import nasty  # noqa: F401
import pytest

from streamlytics.llm.url_rules import judge_urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("x.net", "/a", "allow"),
         ("x.net", "/ab", "block"), ("", "/", "block"), (None, "/", "block"), ("q.org", None, "block")]
CASES = [
    ("http://Example.NET/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
    ("http://a.b.example.net/de?x#y", "a.b.example.net", "/de", "net/", "block"),
    ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("https://x.net/abc", "x.net", "/abc", "x.net/ab", "block"),
    ("https://x.net/ac", "x.net", "/ac", "x.net/a", "allow"),
    ("https://x.net", "x.net", "", None, "allow"),
    ("https://q.org", "q.org", "", "q.org", "block"),
    ("http://a?b", "a", "", None, "allow"),
    ("no scheme.net/", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("http://ÄB.net/" + "p/" * 5000, "Äb.net", "/" + "p/" * 5000, "net/", "block"),
]


@pytest.fixture
def rules(spark):
    return spark.createDataFrame(RULES, "host string, path string, action string")


def test_longest_rule_decides(spark, rules):
    rows = [(i, c[0], "own") for i, c in enumerate(CASES)]
    rows.append(rows[0])
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string")
    got = sorted(tuple(r) for r in judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect())
    assert got == sorted([(i, *c[1:]) for i, c in enumerate(CASES)] + [(0, *CASES[0][1:])])


def test_empty_tables(spark, rules):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert [r.verdict for r in judge_urls(pages, rules.limit(0), default="block").collect()] == ["block"]


def test_host_and_path_do_not_run_together(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (2, "http://a.com/zz"), (3, "http://a.co/x")], "page_id int, url string")
    rules = spark.createDataFrame([("a.co", "m/", "block"), ("a.co", "/x", "block")], "host string, path string, action string")
    got = {r.page_id: (r.verdict, r.rule) for r in judge_urls(pages, rules).collect()}
    assert got == {1: ("allow", None), 2: ("allow", None), 3: ("block", "a.co/x")}
