"""Traversals over the snapshot: pages of one text, and the link graph of sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafmill.functions import render
from leafmill.functions import values as V
from leafmill.functions.text import join_pages
from leafmill.functions.urls import host_of, is_noise, normalize, same_host
from leafmill.operators.stage import cut


def paginate(starts: DataFrame, pages: DataFrame, most: int = 3, least_chars: int = 20) -> DataFrame:
    """Follow next links from each start: (url, text, n_pages).

    ``pages`` has norm, text and next (a URL or null), and content_type, if
    known; ``starts`` has url.  A hop needs the same host, a page of HTML not
    seen in this chain and enough text; ``most`` counts the first page.  Unrolled as ``most - 1`` left joins of the
    checkpointed pages.
    """
    typed = F.coalesce(F.col("content_type"), F.lit("")).rlike("(?i)html") if "content_type" in pages.columns else F.lit(True)
    pages = cut(pages.select("norm", "text", "next", typed.alias("html")))  # read once, however many hops follow
    page = lambda: pages.select(F.col("norm").alias("at"), F.col("text").alias("more"), F.col("next").alias("then"), "html")
    out = starts.select("url", normalize(F.col("url")).alias("at")).join(page(), "at").select("url", F.array("at").alias("seen"), F.col("more").alias("text"), F.col("then").alias("next"), F.lit(1).alias("n_pages"))
    for _ in range(most - 1):
        hop = F.when(same_host(F.col("next"), host_of(F.col("url"))), normalize(F.col("next")))
        out = out.withColumn("at", F.when(~F.array_contains("seen", F.coalesce(hop, F.lit(""))), hop))
        out = out.join(page().filter((F.length("more") >= least_chars) & F.col("html")).drop("html"), "at", "left")
        on = F.col("more").isNotNull()
        out = out.select(
            "url",
            F.when(on, F.concat("seen", F.array("at"))).otherwise(F.col("seen")).alias("seen"),
            F.when(on, join_pages(F.col("text"), F.col("more"))).otherwise(F.col("text")).alias("text"),
            F.when(on, F.col("then")).alias("next"),
            (F.col("n_pages") + on.cast("int")).alias("n_pages"),
        )
    return out.select("url", "text", "n_pages")


def crawl(entries: DataFrame, pages: DataFrame, max_pages: int = 10, max_depth: int = 2) -> DataFrame:
    """Breadth-first walks of many sites at once: (entry, url, depth, place, error, page columns).

    ``entries`` has entry; ``pages`` has norm, links (array of URLs) and more.
    One join per level; the visited set is an anti-join.  Within a site, pages
    come in order of discovery until ``max_pages`` have been read; failures
    take no budget.  Of a page the first links count, and of a level as many
    pages as a queue of a fixed length for each page of the budget holds.
    Each level, and the visited set, is checkpointed, so that lineage doesn't
    grow with depth.
    """
    extra = [c for c in pages.columns if c not in ("norm", "links")]
    level = entries.select("entry", F.col("entry").alias("url"), normalize(F.col("entry")).alias("norm"), F.lit(0).cast("long").alias("place"))
    visited, read, out = None, None, None
    for depth in range(max_depth + 1):
        found = level.join(pages, "norm", "left").withColumn("error", F.when(F.col("links").isNull(), "HTTP 404 Not Found"))
        before = F.sum(F.col("error").isNull().cast("int")).over(W.partitionBy("entry").orderBy("place").rowsBetween(W.unboundedPreceding, -1))
        found = found.withColumn("_n", F.coalesce(before, F.lit(0)))
        if read is not None:
            found = found.join(read, "entry", "left").withColumn("_n", F.col("_n") + F.coalesce("n_read", F.lit(0))).drop("n_read")
        found = cut(found.filter(F.col("_n") < max_pages).drop("_n").withColumn("depth", F.lit(depth)))
        part = found.select("entry", "url", "depth", "place", "error", *extra)
        out = part if out is None else out.unionByName(part)
        if depth == max_depth:
            break
        own = found.select("entry", "norm")
        visited = own.distinct() if visited is None else cut(visited.unionByName(own).distinct())
        count = found.filter("error is null").groupBy("entry").agg(F.count(F.lit(1)).alias("n_read"))
        read = count if read is None else read.unionByName(count).groupBy("entry").agg(F.sum("n_read").alias("n_read"))
        link = F.posexplode(F.slice("links", 1, V.CRAWL_LINKS)).alias("pos", "url")
        nxt = found.filter("error is null").select("entry", F.col("place").alias("_from"), link)
        nxt = nxt.filter(same_host(F.col("url"), host_of(F.col("entry"))) & ~is_noise(F.col("url"))).withColumn("norm", normalize(F.col("url")))
        nxt = nxt.join(visited, ["entry", "norm"], "left_anti")
        # of several ways to a page the first found counts
        nxt = nxt.groupBy("entry", "norm").agg(F.min(F.struct("_from", "pos", "url")).alias("f"))
        order = W.partitionBy("entry").orderBy("f._from", "f.pos")
        level = cut(nxt.select("entry", F.col("f.url").alias("url"), "norm", F.row_number().over(order).cast("long").alias("place")).filter(F.col("place") <= max_pages * V.CRAWL_QUEUE))
    return out


def site_summary(walk: DataFrame) -> DataFrame:
    """Counts per site: total, succeeded, failed."""
    return walk.groupBy("entry").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def site_report(walk: DataFrame) -> DataFrame:
    """(entry, report): the text form of each walk of (entry, url, depth, place, error, title, chars, text).

    Pages come in the order they were read, then the failures; at most the
    page budget and the queue's length meet per site.
    """
    good = F.col("error").isNull()
    page = F.struct("depth", "place", render.site_page(F.col("url"), F.col("depth"), F.col("title"), F.col("chars"), F.col("text")).alias("line"))
    bad = F.struct("depth", "place", render.site_failure(F.col("url"), F.col("error")).alias("line"))
    both = walk.groupBy("entry").agg(
        F.count_if(good).alias("ok"),
        F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_list(F.when(good, page))).alias("pages"),
        F.sort_array(F.collect_list(F.when(~good, bad))).alias("failures"),
    )
    lines = F.transform(F.concat("pages", "failures"), lambda x: x["line"])
    return both.select("entry", F.array_join(F.concat(F.array(render.site_head(host_of(F.col("entry")), F.col("ok"), F.col("n"))), lines), "\n").alias("report"))
