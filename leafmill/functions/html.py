"""Column functions from HTML to text: all stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions import values as V

_ATTR = f"{{0,{V.ATTRIBUTES}}}"
_ATTR1 = f"{{1,{V.ATTRIBUTES}}}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used; keeps expressions from growing with depth."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{V.SPACE}]+|[{V.SPACE}]+\\z", "")


def squeeze(c: Column) -> Column:
    """White space runs become one blank; both ends are trimmed."""
    return trim(F.regexp_replace(c, f"[{V.SPACE}]+", " "))


def first(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def defuse(c: Column) -> Column:
    """A '<' after which no '>' comes can't open a tag: blank it in long tails, so that tag patterns stay linear."""

    def blanked(h: Column) -> Column:
        tail = F.substring_index(h, ">", -1)
        return F.when((F.length(tail) >= V.STRAY_TAIL) & tail.contains("<"), F.concat(F.left(h, F.length(h) - F.length(tail)), F.translate(tail, "<", " "))).otherwise(h)

    return let(c, blanked)


def _entity(part: Column) -> Column:
    """What follows an ampersand, with the entity at its start, if any, decoded."""
    table = F.create_map(*[F.lit(x) for kv in V.ENTITIES.items() for x in kv])

    def value(named: Column) -> Column:
        # leading zeros don't count
        name = F.regexp_replace(named, "^(#x?)0+(?=[0-9a-f])", "$1")
        digits = F.when(name.startswith("#x"), F.conv(F.substring(name, 3, 10), 16, 10)).otherwise(F.substring(name, 2, 11)).cast("decimal(20,0)")
        code = F.when((F.length(name) <= 12) & (digits <= 0x10FFFF), digits.cast("int"))
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(name.startswith("#"), char).otherwise(F.try_element_at(table, name))

    def one(found: Column) -> Column:
        rest = F.substring(part, F.length(found) + 1, F.length(part))
        decoded = let(F.lower(F.regexp_replace(found, ";", "")), value)
        return F.when(found == "", F.lit(None)).otherwise(F.concat(decoded, rest))

    return F.coalesce(let(F.regexp_extract(part, f"(?i){V.ENTITY}", 0), one), F.concat(F.lit("&"), part))


def decode_entities(c: Column) -> Column:
    """Decode entities in one pass: no entity holds an ampersand, so the pieces between them are independent."""

    def done(parts: Column) -> Column:
        return F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), _entity), ""))

    return let(c, lambda t: F.when(t.contains("&"), let(F.split(t, "&", -1), done)).otherwise(t))


def untag(c: Column, by: str = " ") -> Column:
    return F.regexp_replace(c, f"<[^>]{_ATTR1}>", by)


#: A pattern that matches nowhere.
_NEVER = "(?!)"


def closing(html: Column) -> Column:
    """The names of all closing tags, in lower case, each once."""
    return F.array_distinct(F.regexp_extract_all(F.lower(html), F.lit("</([a-z][a-z0-9]*)"), F.lit(1)))


def drop_pairs(html: Column, tags: tuple[str, ...], closed: Column, end: str) -> Column:
    """Drop ``tags`` with all up to the next closing tag of theirs, which ``end`` ends; ``html`` is cheap to read again.

    Tags that are never closed aren't searched for, and nothing behind the
    last closing tag is searched, since nothing can pair there.
    """
    own = F.array_join(F.array_intersect(F.array(*map(F.lit, tags)), closed), "|")
    either = F.when(own != "", own).otherwise(_NEVER)
    head = F.coalesce(F.regexp_substr(html, F.concat(F.lit("(?is)^.*</(?:"), either, F.lit(f"){end}"))), F.lit(""))
    pair = F.concat(F.lit("(?is)<("), either, F.lit(f")[\\s>].*?</\\1{end}"))
    return F.concat(F.regexp_replace(head, pair, F.lit(" ")), F.substring(html, F.length(head) + 1, F.length(html)))


def text_only(html: Column) -> Column:
    """The text of a fragment; entities are decoded after trimming, so edge blanks of theirs stay."""

    def unshown(x: Column) -> Column:
        # nothing pairs behind the last closing tag
        head = F.coalesce(F.regexp_substr(x["html"], F.lit(f"(?is)^.*</(?:{'|'.join(V.TEXT_TAGS)})\\s*>")), F.lit(""))
        c = head
        for tag in V.TEXT_TAGS:
            end = "\\s*>" if tag == "textarea" else ">"
            c = F.regexp_replace(c, F.when(F.array_contains(x["closed"], tag), f"(?is)<{tag}[\\s>].*?</{tag}{end}").otherwise(_NEVER), F.lit(" "))
        return F.concat(c, F.substring(x["html"], F.length(head) + 1, F.length(x["html"])))

    bare = let(F.regexp_replace(defuse(html), "(?s)<!--.*?-->", " "), lambda h: let(F.struct(h.alias("html"), closing(h).alias("closed")), lambda x: F.when(F.size(F.array_intersect(x["closed"], F.array(*map(F.lit, V.TEXT_TAGS)))) > 0, unshown(x)).otherwise(x["html"])))
    return decode_entities(trim(F.regexp_replace(untag(bare), "[ \\t\\r\\n]+", " ")))


def reveal_escaped(html: Column) -> Column:
    """Escaped tags become tags; an escaped '<' before anything else stays."""
    c = F.regexp_replace(html, "(?i)&lt;(?=/?[a-zA-Z!])", "<")
    return F.regexp_replace(F.regexp_replace(c, "(?i)&gt;", ">"), "(?i)&quot;", '"')


def strip_noise(html: Column) -> Column:
    """Drop comments, raw and boxed containers, and tags whose class names an advert or the like.

    Only tags with a closing tag somewhere can pair; the others aren't searched for.
    """
    words = "|".join(V.NOISE_CLASSES)
    rest = f"""[^>]{_ATTR1}class=["'][^"']{{0,300}}(?:{words})[^"']{{0,300}}["'][^>]{_ATTR}>.*?</\\1>"""

    def cleaned(x: Column) -> Column:
        # names in falling order: a longer one comes before those it starts with
        named = F.array_join(F.sort_array(x["closed"], asc=False), "|")
        noisy = (named != "") & x["html"].rlike(f"""(?i)class=["'][^"']{{0,300}}(?:{words})""")
        pattern = F.when(noisy, F.concat(F.lit("(?is)<("), named, F.lit(f"){rest}"))).otherwise(_NEVER)
        raw = drop_pairs(x["html"], V.RAW_TAGS, x["closed"], "\\s*>")
        return let(raw, lambda h: F.regexp_replace(drop_pairs(h, V.BOX_TAGS, x["closed"], ">"), pattern, F.lit(" ")))

    return let(F.regexp_replace(html, "(?s)<!--.*?-->", " "), lambda h: let(F.struct(h.alias("html"), closing(h).alias("closed")), cleaned))


def link_text_length(html: Column) -> Column:
    anchors = F.regexp_extract_all(html, F.lit("(?is)<a[\\s>].*?</a\\s*>"), F.lit(0))
    return F.when(html.rlike("(?i)</a"), F.aggregate(anchors, F.lit(0), lambda n, a: n + F.length(text_only(a)))).otherwise(F.lit(0))


def density_filter(html: Column) -> Column:
    """Drop the blocks of a body whose text is mostly links."""
    mark = "\u0002"

    def keep(s: Column) -> Column:
        return let(F.length(text_only(s)), lambda n: (n >= V.SEGMENT_MIN) & ((n >= V.SEGMENT_SHORT) | (link_text_length(s) <= n * V.LINK_SHARE)))

    def body(h: Column, parts: Column) -> Column:
        kept = F.filter(parts, lambda s: (s != "") & keep(s))
        return let(F.array_join(kept, ""), lambda k: F.when((F.size(parts) < 3) | (k == ""), h).otherwise(k))

    opened = lambda h: F.regexp_replace(h, f"(?i)(<(?:{'|'.join(V.BLOCK_TAGS)})\\b[^>]{_ATTR}>)", mark + "$1")
    return let(html, lambda h: let(F.split(opened(h), mark, -1), lambda parts: body(h, parts)))


def balanced_block(html: Column, tag: str) -> Column:
    """From an opening tag at the start of ``html`` through its balanced closing tag; null if it isn't balanced."""
    pattern = f"(?i)</?{tag}(?=[\\s>])"
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("end"))

    def step(a: Column, t: Column) -> Column:
        at = a["at"] + F.length(t["gap"])
        depth = a["depth"] + F.when(F.substring(t["tag"], 2, 1) == "/", -1).otherwise(1)
        return F.struct(depth.alias("depth"), (at + F.length(t["tag"])).alias("at"), F.when((a["end"] < 0) & (depth == 0), at).otherwise(a["end"]).alias("end"))

    def cut(h: Column, at: Column) -> Column:
        close = F.instr(F.substring(h, at + 1, F.length(h)), ">")
        return F.when((at >= 0) & (close > 0), F.left(h, at + close))

    def end(h: Column) -> Column:
        tags, gaps = F.regexp_extract_all(h, F.lit(pattern), F.lit(0)), F.split(h, pattern, -1)
        rows = let(gaps, lambda g: F.transform(tags, lambda t, i: F.struct(t.alias("tag"), F.get(g, i).alias("gap"))))
        return F.aggregate(rows, zero, step, lambda a: a["end"])

    return let(html, lambda h: let(end(h), lambda at: cut(h, at)))


def _from(html: Column, pattern: str) -> Column:
    """``html`` from the first match on; null if there is none."""
    found = F.regexp_extract(html, f"(?is){pattern}.*\\z", 0)
    return F.nullif(found, F.lit(""))


def pick_main(html: Column) -> Column:
    """The main part: all articles, else what is marked as main, else the body without link blocks."""
    def by_mark(h: Column) -> Column:
        role = F.when(h.rlike("""(?i)role=["']main["']"""), _from(h, f"""<(?:main|div)[^>]{_ATTR}role=["']main["'][\\s>]"""))
        marked = let(role, lambda r: F.when(F.lower(F.substring(r, 2, 4)) == "main", balanced_block(r, "main")).otherwise(balanced_block(r, "div")))
        body = let(_from(h, "<body[\\s>]"), lambda b: F.coalesce(F.get(F.split(b, "(?i)</body>", 2), F.lit(0)), h))
        return F.coalesce(marked, balanced_block(_from(h, "<main[\\s>]"), "main"), density_filter(body))

    def by_article(h: Column, found: Column) -> Column:
        enough = ~h.rlike("(?i)<main[\\s>]") | (F.length(text_only(F.array_join(found, ""))) >= V.ARTICLE_MIN)
        return F.when((F.size(found) > 0) & enough, F.array_join(found, "\n")).otherwise(by_mark(h))

    # behind the last closing tag nothing can pair
    paired = lambda h: F.regexp_extract(h, "(?is)^.*</article\\s*>", 0)
    articles = lambda h: F.when(h.rlike("(?i)</article"), F.regexp_extract_all(paired(h), F.lit("(?is)<article[\\s>].*?</article\\s*>"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return let(html, lambda h: let(articles(h), lambda found: by_article(h, found)))


def body_text(html: Column) -> Column:
    """The text of the main part, without noise."""
    main = strip_noise(reveal_escaped(strip_noise(pick_main(defuse(html)))))
    return trim(F.regexp_replace(text_only(main), " +", " "))


def main_html(html: Column) -> Column:
    """The main part, without noise, as HTML."""
    return strip_noise(reveal_escaped(strip_noise(pick_main(defuse(html)))))


def title(html: Column) -> Column:
    """The title element's text, else og:title; '' without either."""
    def one(h: Column) -> Column:
        raw = F.regexp_extract(h, f"(?is)<title[^>]{_ATTR}>(.*?)</title>", 1)
        og = F.regexp_extract(h, f"""(?i)<meta[^>]{_ATTR1}property=["']og:title["'][^>]{_ATTR1}content=["']([^"']+)["']""", 1)
        return F.when(h.rlike(f"(?is)<title[^>]{_ATTR}>.*?</title>"), raw).otherwise(og)

    return let(let(defuse(html), one), lambda raw: F.coalesce(F.nullif(text_only(raw), F.lit("")), trim(raw)))


def site_name(html: Column) -> Column:
    return F.regexp_extract(html, f"""(?i)<meta[^>]{_ATTR1}property=["']og:site_name["'][^>]{_ATTR1}content=["']([^"']+)["']""", 1)


def language(html: Column) -> Column:
    return F.regexp_extract(html, f"""(?i)<html[^>]{_ATTR1}lang=["']([A-Za-z0-9_-]+)["']""", 1)


def meta(html: Column, names: tuple[str, ...]) -> Column:
    """The content of the first of the named meta tags that is there (name before content); '' without any."""
    found = [first(html, f"""(?i)<meta[^>]{_ATTR1}(?:property|name)=["']{n}["'][^>]{_ATTR1}content=["']([^"']+)["']""") for n in names]
    return F.coalesce(F.left(squeeze(untag(decode_entities(F.coalesce(*found)))), F.lit(V.META_CHARS)), F.lit(""))


def byline_author(text: Column) -> Column:
    return F.left(trim(F.regexp_extract(F.left(text, F.lit(V.BYLINE_HEAD)), V.BYLINE_AUTHOR, 1)), F.lit(V.BYLINE_CHARS))


def byline_date(text: Column) -> Column:
    return F.left(squeeze(F.regexp_extract(F.left(text, F.lit(V.BYLINE_HEAD)), f"(?i){V.BYLINE_DATE}", 1)), F.lit(V.BYLINE_CHARS))


def or_else(c: Column, other: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), other)


def extract(html: Column, text: Column | None = None) -> Column:
    """Struct of title, site_name, lang, published, author, text, used_description; ``text`` replaces the plain body text."""
    body = body_text(html) if text is None else text

    def fields(page: Column, body: Column, described: Column, shown: Column) -> Column:
        return F.struct(
            title(page).alias("title"),
            site_name(page).alias("site_name"),
            language(page).alias("lang"),
            or_else(meta(page, V.PUBLISHED), byline_date(shown)).alias("published"),
            or_else(meta(page, V.AUTHOR), byline_author(shown)).alias("author"),
            shown.alias("text"),
            ((body == "") & (described != "")).alias("used_description"),
        )

    return let(
        F.struct(defuse(html).alias("page"), body.alias("body")),
        lambda x: let(meta(x["page"], V.DESCRIPTION), lambda d: let(or_else(x["body"], d), lambda shown: fields(x["page"], x["body"], d, shown))),
    )


def looks_like_spa(html: Column) -> Column:
    return F.coalesce(F.regexp_count(html, F.lit("(?i)<script[\\s>]")) >= V.SPA_SCRIPTS, F.lit(False))


def looks_like_challenge(html: Column) -> Column:
    return F.coalesce(html.rlike(f"(?i){V.CHALLENGE}"), F.lit(False))
