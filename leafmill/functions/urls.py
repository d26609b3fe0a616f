"""Column functions on URLs and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions import values as V
from leafmill.functions.html import first, let, text_only, trim

#: Characters that a path, a query and a fragment can't hold as they are.
_UNSAFE_PATH, _UNSAFE_QUERY, _UNSAFE_FRAGMENT = "[^!#-;=?-_a-z|~]", "[^!$-&(-;=?-~]", "[^!#-;=?-_a-~]"


def escaped(c: Column, unsafe: str = _UNSAFE_PATH) -> Column:
    """Percent-encode what a part of a URL can't hold as it is."""
    one = lambda ch: F.when(ch == "'", "%27").otherwise(F.replace(F.url_encode(ch), F.lit("+"), F.lit("%20")))
    each = lambda t: F.transform(F.split(t, ""), lambda ch: F.when(ch.rlike(unsafe), one(ch)).otherwise(ch))
    return let(c, lambda t: F.when(t.rlike(unsafe), F.array_join(each(t), "")).otherwise(t))


def _user(url: Column) -> Column:
    """The user part of a URL with its sign; '' without any."""
    found = F.regexp_extract(url, "(?i)^https?://([^/?#\\\\]*@)", 1)
    return F.when(found.isin("@", ":@"), "").otherwise(found)


def origin(url: Column) -> Column:
    """Scheme and authority in lower case, without a default port; null for what isn't http(s)."""
    o = F.lower(first(url, "(?i)^(https?://[^/?#\\\\]+)"))
    o = F.regexp_replace(o, "^(https?://)[^@]*@", "$1")
    return F.regexp_replace(F.regexp_replace(o, "^(http://[^:]+):80\\z", "$1"), "^(https://[^:]+):443\\z", "$1")


def _dots(path: Column) -> Column:
    """Resolve the segments '.' and '..' of a path."""
    steps = F.aggregate(
        F.slice(F.split(path, "/", -1), 2, F.greatest(F.size(F.split(path, "/", -1)) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda a, s: F.when(s == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).when(s == ".", a).otherwise(F.concat(a, F.array(s))),
    )
    tail = F.when(path.rlike("/\\.{1,2}\\z"), "/").otherwise("")
    done = F.concat(F.lit("/"), F.array_join(steps, "/"), tail)
    return F.when(path.rlike("/\\.{1,2}(/|\\z)"), F.regexp_replace(done, "/+\\z", "/")).otherwise(path)


def absolute(url: Column) -> Column:
    """An absolute http(s) URL in its normal form (fragment kept); null if it isn't one."""
    return let(url, _absolute)


def _absolute(url: Column) -> Column:
    rest = F.regexp_extract(url, "(?is)^https?://[^/?#\\\\]+(.*)\\z", 1)
    path = F.translate(F.regexp_extract(rest, "(?s)^[^?#]*", 0), "\\", "/")
    query, fragment = F.regexp_extract(rest, "(?s)^[^?#]*(\\?[^#]*)", 1), F.regexp_extract(rest, "(?s)^[^#]*(#.*)\\z", 1)
    place = F.concat(F.regexp_extract(origin(url), "^(https?://)", 1), _user(url), F.regexp_extract(origin(url), "^https?://(.*)\\z", 1))
    return F.concat(place, escaped(let(path, lambda p: _dots(F.when(p == "", "/").otherwise(p)))), escaped(query, _UNSAFE_QUERY), escaped(fragment, _UNSAFE_FRAGMENT))


def resolve(href: Column, base: Column) -> Column:
    """A reference against the page's URL; null if that gives no http(s) URL."""
    return let(F.struct(trim(href).alias("h"), base.alias("b")), lambda x: _resolve(x["h"], x["b"]))


def _resolve(h: Column, base: Column) -> Column:
    page = F.regexp_replace(base, "(?s)#.*\\z", "")
    path = F.regexp_replace(page, "(?s)\\?.*\\z", "")
    folder = F.when(path.rlike("^https?://[^/]+\\z"), F.concat(path, F.lit("/"))).otherwise(F.regexp_replace(path, "[^/]*\\z", ""))
    return absolute(
        F.when(h.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(F.regexp_extract(base, "(?i)^(https?:)", 1), h))
        .when(h.startswith("/"), F.concat(origin(base), h))
        .when(h.startswith("?"), F.concat(path, h))
        .when(h.startswith("#"), F.concat(page, h))
        .otherwise(F.concat(folder, h))
    )


def host_of(url: Column) -> Column:
    """Host name in lower case; '' if there is none."""
    return F.coalesce(F.regexp_replace(F.regexp_replace(origin(url), "^https?://", ""), ":[0-9]+\\z", ""), F.lit(""))


def normalize(url: Column) -> Column:
    """The normal form without the fragment; null if it can't be read."""
    return absolute(F.regexp_replace(trim(url), "(?s)#.*\\z", ""))


def same_host(url: Column, host: Column) -> Column:
    return F.coalesce(F.nullif(host_of(url), F.lit("")) == host, F.lit(False))


def is_noise(url: Column) -> Column:
    return url.rlike(f"(?i){V.NOISE_FILES}") | url.rlike(f"(?i){V.NOISE_PATHS}")


def fetchable_scheme(url: Column) -> Column:
    return F.coalesce(url.rlike("(?i)^https?://"), F.lit(False))


def links(html: Column, base: Column, limit: int) -> Column:
    """Array of (pos, title, url): links in order, the first of each URL, blank titles left out after that, at most ``limit``."""
    tags = F.slice(F.regexp_extract_all(html, F.lit("(?is)<a[^>]+href=[\"']([^\"']+)[\"'][^>]*>.*?</a>"), F.lit(0)), 1, limit * 4)
    pattern = "(?is)^<a[^>]+href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
    rows = F.transform(tags, lambda t, i: F.struct(i.alias("pos"), F.left(text_only(F.regexp_extract(t, pattern, 2)), F.lit(V.TITLE_CHARS)).alias("title"), resolve(F.regexp_extract(t, pattern, 1), base).alias("url"), trim(F.regexp_extract(t, pattern, 1)).alias("href")))
    rows = F.filter(rows, lambda r: r["url"].isNotNull() & (r["href"] != "") & ~r["href"].rlike("(?i)^(javascript|mailto|tel|data):"))
    # a URL is taken by its first link, even if that has no title
    kept = let(rows, lambda own: let(F.transform(own, lambda r: r["url"]), lambda seen: F.filter(own, lambda r, i: (F.array_position(seen, r["url"]) == i + 1) & (r["title"] != ""))))
    return F.transform(F.slice(kept, 1, limit), lambda r: F.struct(r["pos"].alias("pos"), r["title"].alias("title"), r["url"].alias("url")))


def next_link(html: Column, base: Column) -> Column:
    """The next page: rel=next, else the first short anchor whose whole text says so."""
    rel = F.regexp_extract(html, "(?is)<(?:link|a)\\b[^>]+rel=[\"']next[\"'][^>]*>", 0)
    marked = resolve(first(rel, "(?i)href=[\"']([^\"']+)[\"']"), base)
    pattern = "(?is)<a\\b[^>]+href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a\\s*>"
    tags = F.slice(F.regexp_extract_all(html, F.lit(pattern.replace("(.*?)", ".*?")), F.lit(0)), 1, V.NEXT_SCANS)
    shown = F.transform(tags, lambda t: F.struct(text_only(F.regexp_extract(t, pattern, 2)).alias("t"), resolve(F.regexp_extract(t, pattern, 1), base).alias("u")))
    fits = F.filter(shown, lambda r: (F.length(r["t"]) <= V.NEXT_TEXT_CHARS) & r["t"].rlike(f"(?i){V.NEXT_TEXT}") & r["u"].isNotNull())
    return F.coalesce(marked, F.get(fits, F.lit(0))["u"])
