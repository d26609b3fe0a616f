"""Compact text forms of results, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions import values as V
from leafmill.functions.urls import host_of


def some(c: Column) -> Column:
    """Null for ''."""
    return F.nullif(c, F.lit(""))


def _when(condition: Column, *parts) -> Column:
    return F.when(condition, F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]))


def links_list(links: Column) -> Column:
    return F.array_join(F.transform(links, lambda x: F.concat(F.lit("- "), x["title"], F.lit(" — "), x["url"])), "\n")


def result(r: Column, links: Column | None = None) -> Column:
    """One read page: title, facts, flags, body, links.

    ``r`` has url, title, site_name, lang, charset, mode, published, author,
    feed_count, pages, rendered, spa_hint, truncated, chars_total,
    chars_returned, chars_start, cached, text and error.
    """
    charset = F.when(r["charset"].isin("utf-8", "json", "feed"), None).otherwise(some(r["charset"]))
    facts = F.concat_ws(
        " · ",
        F.when(r["site_name"] != host_of(r["url"]), some(r["site_name"])),
        some(r["lang"]),
        _when(charset.isNotNull(), "charset ", charset),
        some(r["published"]),
        _when(r["author"] != "", "by ", r["author"]),
        _when(r["feed_count"] > 0, "feed · ", r["feed_count"].cast("string"), " 条"),
        F.when(r["mode"] == "json", "json"),
    )
    n = lambda c: r[c].cast("string")
    flags = F.concat_ws(
        " · ",
        F.when(r["chars_start"] > 0, F.concat(F.lit("chars "), n("chars_start"), F.lit("+"), n("chars_returned"), F.lit("/"), n("chars_total"), F.lit(" · offset 续读")))
        .when(r["truncated"], F.concat(F.lit("chars "), n("chars_returned"), F.lit("/"), n("chars_total"), F.lit(" · 截断 · offset 续读")))
        .otherwise(F.concat(F.lit("chars "), n("chars_total"))),
        F.when(r["cached"], "cached"),
        _when(r["pages"] > 1, "已拼接", n("pages"), "页"),
        F.when(r["rendered"], "rendered"),
    )
    hint = F.when((r["chars_start"] > 0) & ~r["truncated"], V.HINT_END).otherwise(F.concat(F.lit("(无可读内容 — "), F.coalesce(some(r["spa_hint"]), F.lit(V.HINT_EMPTY)), F.lit(")")))
    shown = F.concat_ws(
        "\n",
        _when(r["title"] != "", "title: ", r["title"]),
        some(facts),
        _when(flags != "", "(", flags, ")"),
        F.when(r["text"] == "", hint),
        F.lit(""),
        r["text"],
        _when(F.size(links) > 0, "\nlinks:\n", links_list(links)) if links is not None else F.lit(None).cast("string"),
    )
    return F.coalesce(_when(r["error"].isNotNull(), "Error: ", r["error"]), shown)


def link_report(url: Column, links: Column) -> Column:
    n = F.size(links)
    return F.when(n == 0, F.concat(F.lit("No links found on "), url)).otherwise(F.concat(n.cast("string"), F.lit(" link(s) on "), url, F.lit(":\n"), links_list(links)))


def batch_head(ok: Column, total: Column) -> Column:
    bad = total - ok
    return F.concat(F.lit("读取 "), ok.cast("string"), F.lit("/"), total.cast("string"), F.lit(" 页成功"), F.when(bad > 0, F.concat(F.lit("，"), bad.cast("string"), F.lit(" 页失败"))).otherwise(""))


def batch_page(url: Column, title: Column, text: Column, error: Column, links: Column | None = None, cached: Column | None = None) -> Column:
    """One page of a batch; of its links the first six, then their number."""
    mark = F.when(cached, " · cached").otherwise("") if cached is not None else F.lit("")
    good = F.concat(F.lit("\n--- "), F.coalesce(some(title), url), F.lit(" ("), F.length(text).cast("string"), F.lit(" 字符"), mark, F.lit(") ---\n"), F.coalesce(some(text), F.lit(V.NOTHING)))
    if links is not None:
        shown = F.array_join(F.transform(F.slice(links, 1, V.BATCH_LINKS), lambda x: F.concat(x["title"], F.lit(" — "), x["url"])), " | ")
        more = F.when(F.size(links) > V.BATCH_LINKS, F.concat(F.lit(" …共"), F.size(links).cast("string"), F.lit("个"))).otherwise("")
        good = F.concat(good, F.coalesce(_when(F.size(links) > 0, "\nlinks: ", shown, more), F.lit("")))
    return F.when(error.isNotNull(), F.concat(F.lit("\n[失败] "), url, F.lit(" — "), error)).otherwise(good)


def site_head(host: Column, ok: Column, total: Column) -> Column:
    bad = total - ok
    return F.concat(F.lit("站点: "), host, F.lit(" · 爬取 "), ok.cast("string"), F.lit("/"), total.cast("string"), F.lit(" 页"), F.when(bad > 0, F.concat(F.lit(" · "), bad.cast("string"), F.lit(" 页失败"))).otherwise(""))


def site_failure(url: Column, error: Column) -> Column:
    return F.concat(F.lit("[失败] "), url, F.lit(" — "), error)


def site_page(url: Column, depth: Column, title: Column, chars: Column, text: Column | None = None) -> Column:
    indent = F.repeat(F.lit("  "), depth)
    line = F.concat(indent, F.lit("["), depth.cast("string"), F.lit("] "), F.coalesce(some(title), url), F.lit(" ("), chars.cast("string"), F.lit(" 字符)  "), url)
    return line if text is None else F.concat(line, F.when(text != "", F.concat(F.lit("\n"), indent, F.lit("   "), F.left(text, F.lit(80)))).otherwise(""))
