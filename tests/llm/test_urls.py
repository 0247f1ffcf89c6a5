import re

from pyspark.sql import functions as F

from wattline.llm import urls
from wattline.llm.common import table
from wattline.llm.queries import URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_all_pages(spark):
    pages = table(spark, "/root/testdata/sf0.1", "pages")
    want = {r["page_id"]: r["url"] for r in pages.collect()}
    got = urls.judge(pages, URL_RULES).collect()
    assert sorted(r["page_id"] for r in got) == sorted(want)
    for r in got:
        host, path = split(want[r["page_id"]])
        rule = ruled(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.name)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")


def test_odd_urls(spark):
    odd = [None, "", "no scheme/net/", "http://", "HTTP://EXAMPLE.NET/en/1?x#y", "http://exämple.NET/EN/", "x://a.net?b/en/", "x://net/",
           "x://notnet/", "http://a://b/c", "x://example.com/de/" + "1" * 100_000, "x://h.org/" + "a/" * 5000, "x://h.org/fr/\n/q", "x://h.org/fr/\n/q"]
    pages = spark.createDataFrame([(i, u, "p") for i, u in enumerate(odd)], "page_id long, url string, path string")
    got = {r["page_id"]: r for r in urls.judge(pages, URL_RULES).collect()}
    assert len(got) == len(odd)
    for i, u in enumerate(odd):
        host, path = split(u)
        rule = ruled(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule and rule.name), u
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0


def test_templates_learn_what_labels_say(spark):
    rows = []
    for i in range(200):
        rows += [(f"http://h.x/buy/{i}", 1 if i % 2 else None), (f"http://h.x/news/item-{i}.html", 0 if i % 2 else None),
                 (f"http://h.x/tag/word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}u{'xy'[i // 100]}/", 0 if i % 3 else None)]
    pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    got = urls.judge(pages, [], label=F.col("bad")).collect()
    assert all(r["verdict"] == ("block" if r["path"].startswith("/buy/") else "allow") for r in got)
    assert all(r["rule"] is None for r in got)
    by = {r["path"].split("/")[1]: r["template"] for r in got}
    assert by["buy"] == "/buy/{n}" and by["news"] != by["buy"]
    assert len({r["template"] for r in got if r["path"].startswith("/tag/")}) == 1          # variable words are one wildcard


def test_small_sections_and_deep_paths_are_told_apart(spark):
    sections = ["de", *["abcdefghijklmnopqrs"[i] * 2 for i in range(19)]]
    rows = [(f"http://h.x/{s}/{i}", 1 if s == "de" and i % 2 else None) for s in sections for i in range(100)]
    rows += [(f"http://d.x/a/b/c/d/e/f/{s}/{i}", (1 if s == "bad" else 0) if i % 2 else None) for s in ("bad", "good") for i in range(100)]
    pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    got = urls.judge(pages, [], label=F.col("bad")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["verdict"] == ("block" if "/de/" in r["path"] or "/bad/" in r["path"] else "allow"), r


def test_a_host_with_and_without_a_slash_gives_a_row_a_page(spark):
    rows = [(1, "http://a.com"), (2, "http://a.com/"), (3, "http://a.com//"), (4, "http://a.com/x"), (5, "a.com"), (6, None), (7, "http://a.com?q")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), []).collect()
    assert sorted(r["page_id"] for r in got) == [1, 2, 3, 4, 5, 6, 7]
    assert {r["page_id"]: r["path"] for r in got} == {1: "", 2: "/", 3: "//", 4: "/x", 5: "", 6: "", 7: ""}
