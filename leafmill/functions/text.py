"""Column functions on plain text: slices, joins, feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions import values as V
from leafmill.functions.html import decode_entities, defuse, first, let, squeeze, trim, untag


def _while_fits(parts: Column, limit: Column, gap: str) -> Column:
    """Join parts with ``gap`` as long as the whole stays within ``limit``; the first that doesn't ends it."""
    zero = F.struct(F.lit("").alias("text"), F.lit(False).alias("full"))

    def step(a: Column, p: Column) -> Column:
        more = F.when(a["text"] == "", p).otherwise(F.concat(a["text"], F.lit(gap), p))
        full = a["full"] | (F.length(more) > limit)
        return F.struct(F.when(full, a["text"]).otherwise(more).alias("text"), full.alias("full"))

    return F.aggregate(parts, zero, step, lambda a: a["text"])


def smart_truncate(text: Column, limit: int | Column, offset: int | Column = 0) -> Column:
    """A slice that ends with a paragraph, else a sentence: struct of text, truncated, chars_total, chars_returned, chars_start.

    The paragraph that holds the offset is given from its start, if it fits.
    """
    limit, offset = (x if isinstance(x, Column) else F.lit(x) for x in (limit, offset))
    return let(text, lambda t: _truncated(t, limit, offset))


def _truncated(text: Column, limit: Column, offset: Column) -> Column:
    total = F.length(text)
    paragraphs = F.split(text, "\n{2,}", -1)
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.lit(-1).alias("first"))

    def seek(a: Column, p: Column) -> Column:
        hit = (a["first"] < 0) & (a["at"] + F.length(p) > offset)
        found = F.when(hit, a["i"]).otherwise(a["first"])
        return F.struct(F.when(found >= 0, a["at"]).otherwise(a["at"] + F.length(p) + 2).alias("at"), (a["i"] + 1).alias("i"), found.alias("first"))

    def cut(paragraphs: Column, place: Column) -> Column:
        start = F.greatest(place["first"], F.lit(0))
        # an empty first part adds nothing, as in a join that skips it
        whole = _while_fits(F.slice(paragraphs, start + 1, F.greatest(F.size(paragraphs) - start, F.lit(0))), limit, "\n\n")
        p, skip = F.get(paragraphs, start), F.greatest(offset - place["at"], F.lit(0))
        rest = F.when(F.length(p) > skip, F.substring(p, skip + 1, F.length(p))).otherwise(F.substring(text, offset + 1, total))

        def by_sentence(r: Column) -> Column:
            found = let(F.regexp_extract_all(r, F.lit(V.SENTENCE), F.lit(0)), lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(r)))
            return F.coalesce(F.nullif(_while_fits(found, limit, ""), F.lit("")), F.left(r, limit))

        return F.coalesce(F.nullif(whole, F.lit("")), let(rest, by_sentence))

    body = let(paragraphs, lambda p: let(F.aggregate(p, zero, seek), lambda place: cut(p, place)))
    shown = F.when(offset >= total, F.lit("")).when((total <= limit) & (offset == 0), text).otherwise(body)
    # the slice is made once, then measured
    facts = lambda s: F.struct(s.alias("text"), ((offset < total) & (offset + F.length(s) < total)).alias("truncated"), total.alias("chars_total"), F.length(s).alias("chars_returned"), offset.cast("int").alias("chars_start"))
    return let(shown, facts)


def join_pages(a: Column, b: Column) -> Column:
    """Two pages of one text; what ends the first and starts the second again (30 to 300 characters) is dropped once."""
    return let(F.struct(a.alias("a"), b.alias("b")), lambda x: _joined(x["a"], x["b"]))


def _joined(a: Column, b: Column) -> Column:
    most = F.least(F.lit(V.OVERLAP_MAX), F.length(a), F.length(b))
    sizes = F.when(most >= V.OVERLAP_MIN, F.sequence(F.lit(V.OVERLAP_MIN), most)).otherwise(F.array().cast("array<int>"))

    def joined(n: Column) -> Column:
        rest = trim(F.substring(b, F.coalesce(n, F.lit(0)) + 1, F.length(b)))
        return F.when(n.isNull(), F.concat(a, F.lit("\n\n"), b)).when(rest == "", a).otherwise(F.concat(a, F.lit("\n\n"), rest))

    # only the ends can overlap, so only they are compared
    ends = F.struct(F.right(a, F.lit(V.OVERLAP_MAX)).alias("a"), F.left(b, F.lit(V.OVERLAP_MAX)).alias("b"))
    overlap = let(ends, lambda e: F.array_max(F.filter(sizes, lambda k: F.right(e["a"], k) == F.left(e["b"], k))))
    return let(overlap, joined)


def xml_text(c: Column) -> Column:
    """Text of an XML value: CDATA opened, then tags and entities taken off up to three times, as long as there are any."""

    def bared(t: Column, rounds: int) -> Column:
        more = let(decode_entities(untag(t)), lambda x: bared(x, rounds - 1)) if rounds > 1 else decode_entities(untag(t))
        return F.when(t.contains("<") | t.contains("&"), more).otherwise(t)

    opened = let(c, lambda t: F.when(t.contains("<![CDATA["), F.regexp_replace(t, "(?s)<!\\[CDATA\\[(.*?)\\]\\]>", "$1")).otherwise(t))
    return squeeze(let(opened, lambda t: bared(t, 3)))


def parse_feed(xml: Column, limit: int) -> Column:
    """Struct of title, count, items (title, url, summary) and text of an RSS or Atom feed."""
    return let(defuse(xml), lambda x: _feed(x, limit))


def _feed(xml: Column, limit: int) -> Column:
    atom = xml.rlike("(?i)<feed[\\s>]")
    every = F.when(atom, F.regexp_extract_all(xml, F.lit("(?is)<entry[\\s>].*?</entry\\s*>"), F.lit(0))).otherwise(F.regexp_extract_all(xml, F.lit("(?is)<item[\\s>].*?</item\\s*>"), F.lit(0)))

    def item(x: Column) -> Column:
        href = F.regexp_extract(x, "(?i)<link[^>]+href=[\"']([^\"']+)[\"']", 1)
        link = F.coalesce(F.nullif(xml_text(F.regexp_extract(x, "(?is)<link[^>]*>(.*?)</link>", 1)), F.lit("")), href)
        about = F.regexp_extract(x, "(?is)<(?:description|summary|content)[^>]*>(.*?)</(?:description|summary|content)>", 1)
        return F.struct(
            F.left(xml_text(F.regexp_extract(x, "(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(V.FEED_TITLE_CHARS)).alias("title"),
            link.alias("url"),
            F.left(xml_text(about), F.lit(V.FEED_SUMMARY_CHARS)).alias("summary"),
        )

    some = lambda i: (i["title"] != "") | (i["url"] != "") | (i["summary"] != "")
    none = F.array().cast("array<struct<title:string,url:string,summary:string>>")
    # items behind the last one that is shown aren't read
    items = F.aggregate(every, none, lambda out, x: F.when(F.size(out) >= limit, out).otherwise(let(item(x), lambda i: F.when(some(i), F.concat(out, F.array(i))).otherwise(out))))
    line = lambda i: F.concat(F.lit("- "), i["title"], F.when(i["url"] != "", F.concat(F.lit(" — "), i["url"])).otherwise(""), F.when(i["summary"] != "", F.concat(F.lit("\n  "), i["summary"])).otherwise(""))
    head = xml_text(F.regexp_extract(xml, "(?is)<title[^>]*>(.*?)</title>", 1))
    return let(items, lambda own: F.struct(head.alias("title"), F.size(own).alias("count"), own.alias("items"), F.array_join(F.transform(own, line), "\n").alias("text")))


def json_like(text: Column) -> Column:
    """Whether a text can be read as a JSON object or array."""
    t = trim(text)
    return (t.startswith("{") | t.startswith("[")) & F.try_parse_json(t).isNotNull()


def payload_kind(content_type: Column, text: Column) -> Column:
    """json, feed, html or unsupported, by content type first, then by content."""
    kind = F.lower(F.trim(F.get(F.split(F.coalesce(content_type, F.lit("")), ";"), F.lit(0))))
    xml = kind.rlike("[+/]xml\\z")
    return (
        F.when(kind.endswith("json") & F.try_parse_json(text).isNotNull(), "json")
        .when(xml & text.rlike("(?i)<(?:urlset|sitemapindex)[\\s>]"), "unsupported")
        .when(xml & text.rlike("(?i)<(?:rss|feed)[\\s>]"), "feed")
        .otherwise("html")
    )


def first_line(c: Column) -> Column:
    return first(c, "^([^\\n]*)")
