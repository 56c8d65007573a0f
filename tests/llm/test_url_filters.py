"""URL filters: parsing, precedence, nulls, repeated rows, many rules."""

import random
import time

import pytest

from larkspur.llm import common, url_filters

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block")]


def judge(spark, urls, rules=RULES, **more):
    pages = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule int")
    found = url_filters.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, action string"), **more)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    return {r.page_id: tuple(r)[1:] for r in found.collect()}


def test_parts_and_precedence(spark):
    urls = ["http://A.Example.COM/en/77?x#y", "https://example.com/en/8", "x://net/de/", "http://notexample.com/en/7", "ftp://b.example.net/de/81", "no scheme", None, "", "http://", "http://example.com?/en/7", "http://h#f/://q", "http://com/EN/"]
    got = judge(spark, urls)
    assert got[0] == ("a.example.com", "/en/77", "example.com/en/7", "allow")
    assert got[1] == ("example.com", "/en/8", "com/en/", "block")
    assert got[2] == ("net", "/de/", "net/de/", "allow")
    assert got[3] == ("notexample.com", "/en/7", "com/en/", "block")
    assert got[4] == ("b.example.net", "/de/81", "example.net/de/8", "block")
    assert all(got[i] == ("", "", None, "allow") for i in (5, 6, 7, 8))
    assert got[9] == ("example.com", "", None, "allow") and got[10][:2] == ("h", "") and got[11][2] is None


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_many_rules_like_brute_force(spark, broadcast):
    rng = random.Random(4)
    host = lambda: ".".join(rng.choice("ab") for _ in range(rng.randint(1, 4)))
    path = lambda: "".join(rng.choice("/x") for _ in range(rng.randint(0, 4)))
    rules = list({(h, "/" + p if p else ""): (h, "/" + p if p else "", rng.choice(["allow", "block"])) for h, p in ((host(), path()) for _ in range(60))}.values())
    urls = [f"http://{host()}/{path()}" for _ in range(200)] + ["http://a.b/x"] * 50
    got = judge(spark, urls, rules, default="block", broadcast_rules=broadcast)
    for i, u in enumerate(urls):
        h, _, p = u[7:].partition("/")
        fits = [r for r in rules if (h == r[0] or h.endswith("." + r[0])) and ("/" + p).startswith(r[1])]
        best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
        assert got[i] == (h, "/" + p, best and best[0] + best[1], best[2] if best else "block")


def test_thousands_of_rules_and_shapes(spark):
    rules = [(".".join("ab"[k >> i & 1] for i in range(1 + k % 6)), "/" + "x" * (k % 600), "block") for k in range(3000)]
    urls = ["http://" + "a.b." * 40 + "b.a/" + "x" * 700, "http://c/", None]
    began = time.perf_counter()
    got = judge(spark, urls, rules)
    fits = [h + p for h, p, _ in rules if ("." + urls[0][7:].split("/")[0]).endswith("." + h) and ("/" + "x" * 700).startswith(p)]
    assert len(got[0][2]) == max(map(len, fits)) and got[1][2] is None and got[2] == ("", "", None, "allow")
    assert time.perf_counter() - began < 10


def test_shared_urls_are_no_hot_key(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    urls = ["http://a.example.com/en/7"] * 300 + [None] * 300 + ["http://example.com/en/8"] * 50
    for broadcast in (0, 100):
        got = judge(spark, urls, broadcast_rules=broadcast)
        assert [got[i][2] for i in (0, 299, 300, 600)] == ["example.com/en/7"] * 2 + [None, "com/en/"]
        assert len(got) == 650


def test_empty_tables_and_odd_rules(spark):
    assert judge(spark, []) == {}
    assert judge(spark, ["http://a/b"], [])[0] == ("a", "/b", None, "allow")
    odd = [(None, "/", "block"), ("", "/", "block"), ("a", None, "block"), ("a", "/b", "maybe"), ("a", "/c", "allow"), ("a", "/c", "block")]
    got = judge(spark, ["http://a/b", "http://a/c"], odd)
    assert got[0][2:] == ("a", "block") and got[1][2:] == ("a/c", "block")


def test_no_python_in_the_plan(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    p = url_filters.judge_urls(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in p and "MapIn" not in p and "ReadSchema: struct<page_id:bigint,url:string>" in p
