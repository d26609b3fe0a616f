from datetime import datetime, timedelta

from pyspark.sql import functions as F

from leafmill.config import Settings
from leafmill.functions import values
from leafmill.operators import cache, fetch, navigate
from leafmill.plans import read


def test_settings_are_clamped():
    s = Settings.of({"max_chars": "100", "timeout_ms": None, "spa_render": "false", "paginate": False, "max_links": 500, "user_agent": " "})
    assert (s.max_chars, s.timeout_ms, s.spa_render, s.paginate, s.max_links, s.user_agent) == (500, 15000, True, False, 50, "leafmill")
    assert Settings.of(None) == Settings()


def test_race(spark):
    rows = [("a", "x", 5.0, True, 1), ("a", "y", 1.0, False, 2), ("b", "x", 1.0, False, 2), ("b", "y", 2.0, False, 1)]
    out = {r.url: r for r in fetch.race(spark.createDataFrame(rows, "url string, channel string, ms double, ok boolean, n int"), "url", "ms", "ok", ["channel"], "n").collect()}
    assert (out["a"].won, out["a"].channel, out["a"].errors) == (True, "x", None)
    assert (out["b"].won, out["b"].channel, out["b"].errors) == (False, None, ["y", "x"])


def test_lookup(spark):
    pages = spark.createDataFrame([("http://A.example.com/x#f", "one"), ("http://a.example.com/x", "two")], "url string, html string")
    asked = spark.createDataFrame([(1, "http://a.example.com/x#y"), (2, "http://a.example.com/none"), (3, "ftp://a/"), (4, None)], "n int, url string")
    out = {r.n: (r.html, r.error) for r in fetch.lookup(asked, pages).collect()}
    assert out == {1: ("one", None), 2: (None, "HTTP 404 Not Found"), 3: (None, "Only http/https URLs are supported"), 4: (None, "Only http/https URLs are supported")}


def test_cache_times_run_from_the_miss(spark):
    at = datetime(2024, 1, 1)
    rows = [("k", at + timedelta(seconds=s), i) for i, s in enumerate((0, 200, 299, 300, 500, 700))] + [("j", at, 9)]
    out = {r.i: r.cached for r in cache.replay(spark.createDataFrame(rows, "k string, ts timestamp, i int"), "k", "ts", "i").collect()}
    assert [out[i] for i in range(6)] == [False, True, True, False, True, False]
    assert out[9] is False


def _site(spark, rows):
    return spark.createDataFrame([(f"http://e.example.com{p}", [f"http://e.example.com{x}" if x.startswith("/") else x for x in to], p) for p, to in rows], "norm string, links array<string>, title string")


def test_crawl(spark):
    pages = _site(spark, [("/", ["/a", "/b", "http://o.example.com/", "/login", "/logo.png", "/a"]), ("/a", ["/c", "/"]), ("/b", ["/c"]), ("/c", ["/d"]), ("/d", [])])
    start = spark.createDataFrame([("http://e.example.com/",), ("http://gone.example.com/",)], "entry string")
    walk = lambda n, d: sorted((r.entry[7:8], r.depth, r.title, r.error) for r in navigate.crawl(start, pages, n, d).collect())
    gone = ("g", 0, None, "HTTP 404 Not Found")
    assert walk(10, 2) == [("e", 0, "/", None), ("e", 1, "/a", None), ("e", 1, "/b", None), ("e", 2, "/c", None), gone]
    assert walk(2, 2) == [("e", 0, "/", None), ("e", 1, "/a", None), gone]
    assert walk(10, 1) == [("e", 0, "/", None), ("e", 1, "/a", None), ("e", 1, "/b", None), gone]


def test_paginate_stops_at_loops_and_other_hosts(spark):
    rows = [("http://e.example.com/1", "a" * 25, "http://e.example.com/2"), ("http://e.example.com/2", "b" * 25, "http://e.example.com/1"), ("http://e.example.com/9", "c" * 25, "http://o.example.com/2"), ("http://o.example.com/2", "d" * 25, None)]
    pages = spark.createDataFrame(rows, "norm string, text string, next string")
    out = {r.url[-1]: (r.text, r.n_pages) for r in navigate.paginate(pages.filter("norm like '%e.example%'").selectExpr("norm as url"), pages, 5).collect()}
    assert out == {"1": ("a" * 25 + "\n\n" + "b" * 25, 2), "2": ("b" * 25 + "\n\n" + "a" * 25, 2), "9": ("c" * 25, 1)}


def test_session_stores_are_bounded(spark):
    at = datetime(2024, 1, 1)
    keys = [("a", True), ("b", True), ("a", True), ("c", True), ("a", True), ("b", True), ("x", False), ("x", True), ("y", False), ("z", False), ("x", True)]
    rows = [("s", k, at + timedelta(seconds=i), i, good) for i, (k, good) in enumerate(keys)]
    out = cache.replay_sessions(spark.createDataFrame(rows, "s string, k string, ts timestamp, i int, ok boolean"), "s", "k", "ts", "i", "ok", most=2, most_failures=2)
    got = {r.i: r.cached for r in out.collect()}
    # c drops a, then a drops b, then b drops c; z drops x
    assert [got[i] for i in range(11)] == [None, None, "page", None, None, None, None, "error", None, None, None]


def test_reads_by_content_type(spark):
    rows = [("http://e.example.com/a", '{"b": 1, "a": [1, 2.0]}', "application/json"), ("http://e.example.com/f", "<rss ><title>F</title><item><title>A</title></item></rss>", "application/rss+xml"), ("http://e.example.com/h", "<title>T</title><article ><h1>Head</h1><p>Text <b>bold</b></p></article>", "text/html")]
    pages = spark.createDataFrame(rows, "url string, html string, type string")
    docs = {r.url[-1]: (r.kind, r.title, r.text, r.mode) for r in read.documents(pages, "markdown", 5, F.col("type")).collect()}
    assert docs == {"a": ("json", "", '{"b":1,"a":[1,2]}', "json"), "f": ("feed", "F", "- A", "feed"), "h": ("html", "T", "# Head\n\nText **bold**", "markdown")}
    cut = {r.url[-1]: (r.text, r.truncated, r.site_name) for r in read.read(pages.drop("type"), 6, mode="markdown").filter("url like '%/h'").collect()}
    assert cut == {"h": ("# Head", True, "e.example.com")}


def _fetched(spark):
    html = "<title>T</title><article ><p>{}</p></article>"
    shell = "<body >" + "<script >x</script>" * 5 + "</body>"
    rows = [
        ("http://e.example.com/a", 200, "text/html", html.format("First page of the text.") + '<a href="/b">next</a>', None),
        ("http://e.example.com/b", 200, "text/html", html.format("Second page of the text."), None),
        ("http://e.example.com/c", 200, "text/html", html.format("Third page, which goes on as no page of HTML.") + '<link rel="next" href="/j">', None),
        ("http://e.example.com/j", 200, "application/json", '{"a": [1.0, "text that is long enough"]}', None),
        ("http://e.example.com/s", 200, "text/xml", "<urlset ></urlset>", None),
        ("http://e.example.com/x", 200, "text/html", shell, html.format("What the scripts have drawn.")),
        ("http://e.example.com/y", 200, "text/html", shell, "Just a moment... " + html.format("long enough text of a challenge")),
        ("http://e.example.com/z", 200, "text/html", shell, "<p></p>"),
        ("http://e.example.com/g", 503, "text/html", "", None),
    ]
    return spark.createDataFrame([(u, s, "", t, bytearray(b.encode()), r) for u, s, t, b, r in rows], "url string, status int, reason string, content_type string, body binary, rendered string")


def test_whole_reads(spark):
    docs = {r.url[-1]: r for r in read.whole(_fetched(spark), include_links=True).collect()}
    assert len(docs) == 9
    assert (docs["a"].text, docs["a"].pages) == ("First page of the text.\n\nSecond page of the text.", 2)
    assert [(x.title, x.url) for x in docs["a"].links] == [("next", "http://e.example.com/b")]
    assert (docs["c"].text, docs["c"].pages) == ("Third page, which goes on as no page of HTML.", 1)
    assert (docs["j"].text, docs["j"].kind, docs["j"].charset) == ('{"a":[1,"text that is long enough"]}', "json", "json")
    assert (docs["s"].error, docs["s"].text) == ("Unsupported content (XML sitemap)", None)
    assert (docs["x"].text, docs["x"].is_rendered) == ("What the scripts have drawn.", True)
    assert (docs["y"].text, docs["y"].is_rendered, docs["y"].spa_hint) == ("", False, values.HINT_BLOCKED_EMPTY)
    assert (docs["z"].is_rendered, docs["z"].spa_hint) == (False, values.HINT_RENDERED_EMPTY)
    assert docs["g"].error == "HTTP 503 "


def test_an_extractor_takes_the_place_of_the_heuristics(spark):
    pages = _fetched(spark).filter("url like '%/a'")
    clean = lambda html: F.when(html.contains("First"), "<p>Clean <b>text</b></p>")
    assert [r.text for r in read.whole(pages, extractor=clean).collect()] == ["Clean text"]
    assert [r.text for r in read.whole(pages, "markdown", extractor=clean).collect()] == ["Clean **text**"]


def test_reports_of_requests(spark):
    docs = read.whole(_fetched(spark))
    at = datetime(2024, 1, 1)
    rows = [(1, "s", "http://e.example.com/b#x", at, 0), (2, "s", "http://e.example.com/b", at + timedelta(seconds=9), 7), (3, "t", "http://e.example.com/b", at + timedelta(seconds=9), 0), (4, "s", "http://e.example.com/s", at, 0)]
    got = {r.request: (r.cached, r.report) for r in read.reports(spark.createDataFrame(rows, "request int, session string, url string, at timestamp, offset int"), docs).collect()}
    assert got[1] == (False, "title: T\n(chars 24)\n\nSecond page of the text.")
    assert got[2] == (True, "title: T\n(chars 7+24/24 · offset 续读 · cached)\n\nSecond page of the text.")
    assert got[3][0] is False
    assert got[4] == (False, "Error: Unsupported content (XML sitemap)")


def test_a_site_report_has_its_head_and_failures(spark):
    rows = [("http://e.example.com/", "http://e.example.com/", 0, 1, None, "Home", 4, "text"), ("http://e.example.com/", "http://e.example.com/b", 1, 2, None, "", 0, ""), ("http://e.example.com/", "http://e.example.com/a", 1, 1, "HTTP 404 Not Found", None, None, None)]
    walk = spark.createDataFrame(rows, "entry string, url string, depth int, place long, error string, title string, chars int, text string")
    assert [r.report for r in navigate.site_report(walk).collect()] == ["站点: e.example.com · 爬取 2/3 页 · 1 页失败\n[0] Home (4 字符)  http://e.example.com/\n   text\n  [1] http://e.example.com/b (0 字符)  http://e.example.com/b\n[失败] http://e.example.com/a — HTTP 404 Not Found"]
