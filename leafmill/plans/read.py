"""Whole reads: from a table of pages to sliced, rendered documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.config import Settings
from leafmill.functions import html as H
from leafmill.functions import render, urls
from leafmill.functions import values as V
from leafmill.functions.text import parse_feed, payload_kind, smart_truncate
from leafmill.operators import cache, navigate
from leafmill.operators.decode import decode
from leafmill.operators.fetch import accept_render, gate, lookup, needs_render
from leafmill.operators.jsonx import compact_json
from leafmill.operators.markdown import with_markdown
from leafmill.operators.stage import cut


def documents(pages: DataFrame, mode: str = "text", max_links: int = 0, content_type: Column | None = None) -> DataFrame:
    """The full document of every page: (url, title, site_name, lang, published, author, text, mode, kind, links ...).

    ``pages`` has url and html; other columns are kept.  JSON and feeds are
    told by content type, if there is one; a sitemap is an error, without text.
    """
    kind = payload_kind(content_type, F.col("html")) if content_type is not None else F.lit("html")
    out = pages.withColumn("kind", kind)
    if mode == "markdown":
        out = with_markdown(out, out="_body")
    body = F.col("_body") if mode == "markdown" else H.body_text(F.col("html"))
    out = out.withColumn("_x", H.extract(F.col("html"), body))
    if content_type is not None:
        out = out.withColumn("_f", F.when(F.col("kind") == "feed", parse_feed(F.col("html"), 20)))
        text = F.when(F.col("kind") == "json", compact_json(F.when(F.col("kind") == "json", F.col("html")))).when(F.col("kind") == "feed", F.col("_f.text")).otherwise(F.col("_x.text"))
        head = F.when(F.col("kind") == "feed", F.col("_f.title")).when(F.col("kind") == "json", "").otherwise(F.col("_x.title"))
    else:
        text, head = F.col("_x.text"), F.col("_x.title")
    cols = [F.col(f"_x.{c}").alias(c) for c in ("site_name", "lang", "published", "author", "used_description")]
    shown = F.when(F.col("kind") == "html", F.lit(mode)).otherwise(F.col("kind"))
    bad = F.when(F.col("kind") == "unsupported", V.SITEMAP)
    text = F.when(bad.isNull(), text)
    found = urls.links(F.col("html"), F.col("url"), max_links) if max_links else F.lit(None).cast("array<struct<pos:int,title:string,url:string>>")
    return out.select(*pages.columns, "kind", head.alias("title"), text.alias("text"), shown.alias("mode"), *cols, found.alias("links"), bad.alias("error"))


#: A column of cleaner HTML made of a page's HTML, to be read in place of what the heuristics find.
Extractor = Callable[[Column], Column]


def extracted(pages: DataFrame, html: str, mode: str, out: str, extractor: Extractor | None = None) -> DataFrame:
    """``pages`` with ``out``: the struct that ``H.extract`` makes of a column of HTML, in text or Markdown; null for null."""
    clean = H.or_else(extractor(F.col(html)), F.lit(None)) if extractor else None
    if mode == "markdown":
        pages = with_markdown(pages, html, "_md")
        body = F.col("_md")
        if clean is not None:
            # what an extractor gives is a main part already
            pages = with_markdown(pages.withColumn("_clean", F.concat(F.lit("<article >"), clean, F.lit("</article>"))), "_clean", "_md2").drop("_clean")
            body = F.coalesce(F.col("_md2"), body)
    else:
        body = H.body_text(F.col(html))
        if clean is not None:
            body = F.coalesce(H.trim(F.regexp_replace(H.text_only(clean), " +", " ")), body)
    return pages.withColumn(out, F.when(F.col(html).isNotNull(), H.extract(F.col(html), body))).drop("_md", "_md2")


def whole(fetched: DataFrame, mode: str = "text", settings: Settings | None = None, include_links: bool = False, extractor: Extractor | None = None) -> DataFrame:
    """The full document of every fetched page, all steps of a read in one plan.

    ``fetched`` has url, status, reason, content_type, body (bytes) and, if
    there are renderings, rendered (HTML, null if a page has none).  Gates,
    decoding, dispatch by payload, extraction, the rendering in place of a
    thin static read, continuation pages, links.  Returns (url, error, kind,
    title, site_name, lang, published, author, text, mode, charset,
    feed_count, pages, is_rendered, spa_hint, links), one row per row of
    ``fetched``; a row that can't be read has its error and nulls.
    """
    s = settings or Settings()
    c = F.col
    x = fetched.withColumn("error", gate(c("status"), c("reason"), c("content_type"), c("body"), s.max_bytes))
    x = x.withColumn("_d", F.when(c("error").isNull(), decode(c("body"), c("content_type"))))
    x = x.withColumn("kind", F.when(c("error").isNull(), payload_kind(c("content_type"), c("_d.text"))))
    x = x.withColumn("error", F.coalesce("error", F.when(c("kind") == "unsupported", V.SITEMAP)))
    x = x.withColumn("_html", F.when((c("kind") == "html") & c("error").isNull(), c("_d.text")))
    x = x.withColumn("_shown", c("rendered") if "rendered" in fetched.columns and s.spa_render else F.lit(None).cast("string"))
    # what is read twice is written once, which also keeps each plan small
    x = cut(extracted(cut(x.drop("body", "rendered")), "_html", mode, "_static", extractor))
    asked = F.coalesce(needs_render(c("_html"), c("_static.text")), F.lit(False)) & c("_shown").isNotNull()
    x = x.withColumn("_shown", F.when(asked, c("_shown")))
    x = cut(extracted(x, "_shown", mode, "_drawn", extractor))
    taken = F.coalesce(accept_render(c("_static.text"), c("_shown"), c("_drawn.text")), F.lit(False))
    blocked = H.looks_like_challenge(c("_shown"))
    hint = F.when(~c("_taken") & blocked, F.when(c("_static.text") != "", V.HINT_BLOCKED).otherwise(V.HINT_BLOCKED_EMPTY)).when(~c("_taken") & c("_shown").isNotNull() & (c("_static.text") == ""), V.HINT_RENDERED_EMPTY)
    x = x.withColumn("_taken", taken).withColumn("spa_hint", F.coalesce(hint, F.lit("")))
    # links and next pages come from a rendering that isn't a challenge, whether or not its text is taken
    x = x.withColumn("_x", F.when(c("_taken"), c("_drawn")).otherwise(c("_static"))).withColumn("_dom", F.when(c("_shown").isNotNull() & ~blocked, c("_shown")).otherwise(c("_html")))
    x = x.withColumn("_f", F.when((c("kind") == "feed") & c("error").isNull(), parse_feed(c("_d.text"), s.max_links)))
    x = x.withColumn("_json", compact_json(F.when(c("kind") == "json", c("_d.text"))))
    x = cut(x.drop("_static", "_drawn", "_shown"))
    # a chain's further pages are static ones
    chain = x.filter("_html is not null").select("url", urls.normalize(c("url")).alias("norm"), c("_x.text").alias("text"), urls.next_link(c("_dom"), c("url")).alias("next"), "content_type")
    joined = navigate.paginate(chain.select("url"), chain.dropDuplicates(["norm"]), s.paginate_max if s.paginate else 1).select(c("url").alias("_u"), c("text").alias("_joined"), c("n_pages").alias("_n"))
    x = x.join(joined.dropDuplicates(["_u"]), x["url"] == c("_u"), "left")
    of_kind = lambda html, feed, json: F.when(c("kind") == "html", html).when(c("kind") == "feed", feed).when(c("kind") == "json", json)
    page = lambda name: of_kind(c(f"_x.{name}"), F.lit(""), F.lit(""))
    none = F.lit(None).cast("array<struct<title:string,url:string>>")
    plain = lambda a: F.transform(a, lambda z: F.struct(z["title"].alias("title"), z["url"].alias("url")))
    links = of_kind(plain(urls.links(c("_dom"), c("url"), s.max_links)), plain(c("_f.items")), none) if include_links else none
    ok = c("error").isNull()
    out = {
        "kind": c("kind"),
        "title": of_kind(c("_x.title"), c("_f.title"), F.lit("")),
        "site_name": of_kind(c("_x.site_name"), urls.host_of(c("url")), urls.host_of(c("url"))),
        "lang": page("lang"),
        "published": page("published"),
        "author": page("author"),
        "text": of_kind(F.coalesce("_joined", "_x.text"), c("_f.text"), c("_json")),
        "mode": of_kind(F.lit(mode), F.lit("feed"), F.lit("json")),
        "charset": of_kind(c("_d.charset"), F.lit("feed"), F.lit("json")),
        "feed_count": F.coalesce(c("_f.count"), F.lit(0)),
        "pages": F.coalesce(c("_n"), F.lit(1)),
        "is_rendered": c("_taken"),
        "spa_hint": c("spa_hint"),
        "links": links,
    }
    return x.select("url", "error", *[F.when(ok, v).alias(k) for k, v in out.items()])


def reports(requests: DataFrame, documents: DataFrame, max_chars: int = 6000) -> DataFrame:
    """(request, cached, report) for requests (request, session, url, at, offset) against the whole documents.

    Requests of a session go through its bounded stores in order of time; a
    slice starts at the request's offset.
    """
    known = documents.withColumn("_norm", urls.normalize(F.col("url"))).dropDuplicates(["_norm"]).withColumnRenamed("url", "_url")
    asked = requests.withColumn("_norm", urls.normalize(F.col("url")))
    x = asked.join(known, "_norm", "left").withColumn("error", F.when(F.col("_url").isNull(), F.lit("HTTP 404 Not Found")).otherwise(F.col("error")))
    seen = cache.replay_sessions(x.select("request", "session", F.col("_norm").alias("page"), "at", F.col("error").isNull().alias("ok")), "session", "page", "at", "request", "ok").select("request", "cached")
    x = x.withColumn("s", smart_truncate(F.col("text"), max_chars, F.col("offset"))).join(seen, "request")
    names = ("title", "site_name", "lang", "charset", "mode", "published", "author", "feed_count", "pages", "spa_hint", "error")
    r = F.struct(F.col("_url").alias("url"), *[F.col(n) for n in names], F.col("is_rendered").alias("rendered"), F.col("cached").isNotNull().alias("cached"), *[F.col(f"s.{n}") for n in ("text", "truncated", "chars_total", "chars_returned", "chars_start")])
    return x.withColumn("r", r).select("request", F.col("cached").isNotNull().alias("cached"), render.result(F.col("r"), F.col("links")).alias("report"))


def read(pages: DataFrame, max_chars: int = 6000, offset: int = 0, mode: str = "text", max_links: int = 0) -> DataFrame:
    """Documents cut to a slice, site names defaulting to the host."""
    docs = documents(pages, mode, max_links)
    docs = docs.withColumn("s", smart_truncate(F.col("text"), max_chars, offset))
    return docs.select(*[c for c in docs.columns if c not in ("text", "s", "site_name", "html")], render_site(F.col("site_name"), F.col("url")).alias("site_name"), "s.*")


def render_site(site: Column, url: Column) -> Column:
    return F.coalesce(F.nullif(site, F.lit("")), urls.host_of(url))


def batch(requests: DataFrame, pages: DataFrame, max_chars: int = 3000, most: int = 10, max_links: int = 0) -> DataFrame:
    """Reads of many URLs: of the non-blank ones of each request the first ``most``; failures stay rows of their own.

    ``requests`` has request and urls (an array).  Returns (request, pos, url,
    title, chars, text, error, links), without links where none are asked for.
    """
    wanted = F.slice(F.filter(F.transform("urls", lambda u: H.trim(u)), lambda u: u != ""), 1, most)
    asked = requests.select("request", F.posexplode(wanted).alias("pos", "url"))
    found = lookup(asked, pages)
    text = F.when(F.col("error").isNull(), smart_truncate(H.body_text(F.col("html")), max_chars)["text"])
    return found.select("request", "pos", "url", F.when(F.col("error").isNull(), H.title(F.col("html"))).alias("title"), F.length(text).alias("chars"), text.alias("text"), "error", (F.when(F.col("error").isNull(), urls.links(F.col("html"), F.col("final_url"), max_links)) if max_links else F.lit(None).cast("array<struct<pos:int,title:string,url:string>>")).alias("links"))


def batch_summary(reads: DataFrame) -> DataFrame:
    """(request, total, succeeded, failed) of batch reads."""
    return reads.groupBy("request").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def batch_report(reads: DataFrame) -> DataFrame:
    """(request, report): the text form of each request's reads, in order; at most ten rows meet per request."""
    lines = F.struct("pos", render.batch_page(F.col("url"), F.col("title"), F.col("text"), F.col("error"), F.col("links")).alias("line"))
    both = reads.groupBy("request").agg(F.count_if(F.col("error").isNull()).alias("ok"), F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(lines)).alias("lines"))
    return both.select("request", F.concat_ws("\n", render.batch_head(F.col("ok"), F.col("n")), F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).alias("report"))
