"""The registered queries on the snapshot tables, each with its DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import html as H
from leafmill.functions import render, text, urls
from leafmill.functions import values as V
from leafmill.operators import cache, decode, fetch, jsonx, markdown, navigate
from leafmill.plans import read
from leafmill.plans import sql as Q
from leafmill.sources.pages import read_pages, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
c = F.col


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        @functools.wraps(f)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = f(spark, folder)
            # counts and lengths have one type in the results, that of their SQL
            return out.withColumns({n: c(n).cast("long") for n, kind in out.dtypes if kind == "int"})

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- pages to text -----------------------------------------------------------------


@query(f"select page_id, url, {Q.title('html')} as title, {Q.language('html')} as lang, length({Q.body_text('html')}) as chars, {Q.body_text('html')} as text from pages")
def read_text(spark, folder):
    """Every page as plain text."""
    x = read_pages(spark, folder).select("page_id", "url", H.title(c("html")).alias("title"), H.language(c("html")).alias("lang"), H.body_text(c("html")).alias("text"))
    return x.select("page_id", "url", "title", "lang", F.length("text").alias("chars"), "text")


@query(f"select page_id, {Q.text_only('html')} as text from pages")
def text_only(spark, folder):
    return read_pages(spark, folder).select("page_id", H.text_only(c("html")).alias("text"))


@query(f"select page_id, {Q.strip_noise('html')} as html from pages")
def strip_noise(spark, folder):
    return read_pages(spark, folder).select("page_id", H.strip_noise(c("html")).alias("html"))


_BOXED = """'<div id="x" class="top-' || (case page_id % 3 when 0 then 'banner' when 1 then 'hero' else 'share box' end) || '">' || left(html, 40) || '</div><template>t</template><p class="thread-x">q</p><svg >s</svg>' || html"""


@query(f"select page_id, {Q.strip_noise('x')} as html from (select page_id, {_BOXED} as x from pages)")
def strip_noise_class(spark, folder):
    """Containers named by their class, templates and drawings."""
    x = F.expr(_BOXED.replace("'<div id", "'<div id"))
    return read_pages(spark, folder).select("page_id", H.strip_noise(x).alias("html"))


_TAIL = "html || repeat(' a < b ', 100 + (page_id % 2)::int)"


@query(f"select page_id, {Q.defuse('x')} as html from (select page_id, case when page_id % 2 = 0 then html || ' a < b' else html || repeat(' a < b ', 100) end as x from pages)")
def defuse_lt(spark, folder):
    x = F.when(c("page_id") % 2 == 0, F.concat("html", F.lit(" a < b"))).otherwise(F.concat("html", F.lit(" a < b " * 100)))
    return read_pages(spark, folder).select("page_id", H.defuse(x).alias("html"))


_ENTITY_TEXT = "replace(replace(text, ' ', '&nbsp;'), '.', (case doc_id % 9 when 0 then '&amp;lt;' when 1 then '&#8364;' when 2 then '&#x20AC' when 3 then '&copy2026' when 4 then '&Prime;' when 5 then '&mdash' when 6 then '&frac12;' when 7 then '&unknown;' else '&#99999999;' end))"


@query(f"select doc_id, {Q.decode_entities('x')} as text from (select doc_id, {_ENTITY_TEXT} as x from documents)")
def decode_entities(spark, folder):
    x = table(spark, folder, "documents").select("doc_id", F.expr(_ENTITY_TEXT).alias("x"))
    return x.select("doc_id", H.decode_entities(c("x")).alias("text"))


@query(f"select page_id, {Q.reveal_escaped('x')} as html from (select page_id, replace(replace(html, '<p>', '&lt;p&gt;'), ' the ', ' &lt; &quot;') as x from pages)")
def reveal_escaped(spark, folder):
    x = F.expr("replace(replace(html, '<p>', '&lt;p&gt;'), ' the ', ' &lt; &quot;')")
    return read_pages(spark, folder).select("page_id", H.reveal_escaped(x).alias("html"))


_SEGMENT = f"length({Q.text_only('s')}) as n, list_sum(list_transform(regexp_extract_all(s, '(?is)<a[\\s>].*?</a\\s*>'), lambda a: length({Q.text_only('a')}))) as l"
_BLOCKS = "|".join(V.BLOCK_TAGS)


@query(
    f"""with b as (select page_id, regexp_extract(html, '(?is)<body[\\s>].*', 0) as b from pages),
    d as (select page_id, string_split_regex(b, '(?i)</body>')[1] as b from b),
    p as (select page_id, b, string_split(regexp_replace(b, '(?i)(<(?:{_BLOCKS})\\b[^>]{{0,1000}}>)', chr(2) || '\\1', 'g'), chr(2)) as parts from d),
    s as (select page_id, unnest(parts) as s, generate_subscripts(parts, 1) as i from p),
    k as (select page_id, s, i, {_SEGMENT} from s where s <> '')
    select page_id, coalesce(string_agg(s, '' order by i) filter (where n >= 2 and (n >= 300 or coalesce(l, 0) <= n * 0.65)), max(b)) as html from k join p using (page_id) group by page_id"""
)
def density_filter(spark, folder):
    """Bodies without their link blocks."""
    body = F.get(F.split(F.regexp_extract("html", "(?is)<body[\\s>].*\\z", 0), "(?i)</body>", 2), F.lit(0))
    return read_pages(spark, folder).select("page_id", body.alias("b")).select("page_id", H.density_filter(c("b")).alias("html"))


_NESTED = """'<body><div class="w"><div id="m" role="main">' || '<div><p>' || page_id || '</p></div>' || repeat('<div>x</div>', (page_id % 4)::int) || '<i>end</i></div><div>after</div></div></body>'"""


@query(
    """select page_id, '<div id="m" role="main">' || '<div><p>' || page_id || '</p></div>' || repeat('<div>x</div>', (page_id % 4)::int) || '<i>end</i></div>' as html from pages"""
)
def balanced_block(spark, folder):
    """The main block among nested ones, through its own closing tag."""
    x = F.expr(_NESTED.replace("(page_id % 4)::int", "cast(page_id % 4 as int)"))
    return read_pages(spark, folder).select("page_id", H.pick_main(x).alias("html"))


_TINY = """'<body ><article >' || repeat('ab ', 64 + page_id % 6) || '</article><main ><p>' || page_id || '</p></main ><article >c</article></body>'"""


@query("""select page_id, (case when 3 * (64 + page_id % 6) - 1 + 2 >= 200 then '<article >' || repeat('ab ', (64 + page_id % 6)::int) || '</article>' || chr(10) || '<article >c</article>' else '<main ><p>' || page_id || '</p></main >' end) as html from pages""")
def tiny_article(spark, folder):
    """Articles of fewer than 200 characters give way to the main element."""
    x = F.expr(_TINY.replace("64 + page_id % 6)", "cast(64 + page_id % 6 as int))"))
    return read_pages(spark, folder).select("page_id", H.pick_main(x).alias("html"))


_META = """'<html lang="de"><head><title></title>' || (case page_id % 3 when 0 then '<meta property="og:title" content="T">' else '' end) || '<meta property="og:site_name" content="Site &amp; Co"><meta name="author" content=" A &amp;amp; <b>B</b> ' || page_id || '">' || (case page_id % 2 when 0 then '<meta name="pubdate" content="2024-01-0' || (page_id % 9 + 1) || '">' else '<meta content="x" name="date">' end) || '<meta name="description" content="' || repeat('d', 100) || '"></head>' || html"""


@query(
    f"""select page_id, {Q.meta('x', V.PUBLISHED)} as published, {Q.meta('x', V.AUTHOR)} as author, {Q.meta('x', V.DESCRIPTION)} as description,
    regexp_extract(x, '(?i)property="og:site_name" content="([^"]+)"', 1) as site_name, {Q.language('x')} as lang from (select page_id, {_META} as x from pages)"""
)
def page_meta(spark, folder):
    x = read_pages(spark, folder).select("page_id", F.expr(_META).alias("x"))
    return x.select("page_id", H.meta(c("x"), V.PUBLISHED).alias("published"), H.meta(c("x"), V.AUTHOR).alias("author"), H.meta(c("x"), V.DESCRIPTION).alias("description"), H.site_name(c("x")).alias("site_name"), H.language(c("x")).alias("lang"))


_BYLINE = "(case doc_id % 4 when 0 then '作者：王' || doc_id || ' 日期：2026年8月2' || (doc_id % 10) || '日 ' when 1 then 'published on 2024-03-0' || (doc_id % 9 + 1) || 'T10:30 editor: Anna' || doc_id || ' ' when 2 then repeat('x', 600) || '作者：late ' else '' end) || text"


@query(
    f"""select doc_id, left({Q.trim("regexp_extract(left(x, 600), " + Q.lit(V.BYLINE_AUTHOR) + ", 1)")}, 40) as author, left({Q.squeeze("regexp_extract(left(x, 600), " + Q.lit('(?i)' + V.BYLINE_DATE) + ", 1)")}, 40) as published
    from (select doc_id, {_BYLINE} as x from documents)"""
)
def byline(spark, folder):
    x = table(spark, folder, "documents").select("doc_id", F.expr(_BYLINE).alias("x"))
    return x.select("doc_id", H.byline_author(c("x")).alias("author"), H.byline_date(c("x")).alias("published"))


@query(f"select page_id, (case when {Q.body_text('x')} = '' then {Q.meta('x', V.DESCRIPTION)} else {Q.body_text('x')} end) as text, ({Q.body_text('x')} = '') as used_description from (select page_id, case when page_id % 2 = 0 then '<meta name=\"description\" content=\"about ' || page_id || '\"><article > </article>' else html end as x from pages)")
def description_fallback(spark, folder):
    """Pages without text show their description."""
    x = F.expr("""case when page_id % 2 = 0 then '<meta name="description" content="about ' || page_id || '"><article > </article>' else html end""")
    e = H.extract(x)
    return read_pages(spark, folder).select("page_id", e.alias("e")).select("page_id", "e.text", "e.used_description")


@query()
def read_markdown(spark, folder):
    """Every page as Markdown."""
    return markdown.with_markdown(read_pages(spark, folder)).select("page_id", "markdown")


_PLAIN = "regexp_replace(translate(text, '&<>', '+()'), '[ \\t\\r\\n]+', ' ', 'g')"
_MD = "'<article ><h2>' || lang || '</h2><p>' || x || ' <b>bold</b> <a href=\"/u\">a <em>link</em></a><img alt=\"pic\" src=\"/p.png\"><img alt=\"\" src=\"/q\"></p><ul><li>one</li><li><strong>two</strong></li></ul><ol><li>a_b</li><li>c</li></ol><blockquote><p>q1</p><p>q2</p></blockquote><pre><code class=\"language-py\">x = [' || doc_id || ']</code></pre><table><tr><th>k|k</th><th>v</th></tr><tr><td>' || doc_id || '</td><td><code>z</code></td></tr></table><hr></hr><section>end &amp; more</section></article>'"


@query(
    f"""select doc_id, '## ' || lang || n || n || {Q.trim(r"regexp_replace(x, '([\\`*_\[\]])', '\\\1', 'g')")} || ' **bold** [a *link*](/u)![pic](/p.png)' || n || n || '- one' || n || '- **two**' || n || n || '1. a\\_b' || n || '2. c' || n || n || '> q1' || n || '> ' || n || '> q2' || n || n || '```py' || n || 'x = [' || doc_id || ']' || n || '```' || n || n || '| k\\|k | v |' || n || '| ' || doc_id || ' | `z` |' || n || '|--|--|---|' || n || n || '---' || n || n || 'end & more' as markdown
    from (select doc_id, lang, chr(10) as n, {_PLAIN} as x from documents where lang is not null)"""
)
def markdown_blocks(spark, folder):
    """Headings, paragraphs, links, images, lists, quotes, code, tables, lines and sections made of every document."""
    x = table(spark, folder, "documents").filter("lang is not null").select("doc_id", "lang", F.expr(_PLAIN.replace(", 'g')", ")")).alias("x"))
    return markdown.with_markdown(x.select("doc_id", F.expr(_MD).alias("html"))).select("doc_id", "markdown")


# --- slices ----------------------------------------------------------------------------------


@query(f"select doc_id, {Q.sliced('text', 500)} as text, length(text) > length({Q.sliced('text', 500)}) as truncated, length(text) as chars_total, length({Q.sliced('text', 500)}) as chars_returned from documents")
def truncate_sentence(spark, folder):
    """Slices of texts without blank lines: whole sentences, else a hard cut."""
    s = text.smart_truncate(c("text"), 500)
    return table(spark, folder, "documents").select("doc_id", s.alias("s")).select("doc_id", "s.text", "s.truncated", "s.chars_total", "s.chars_returned")


def _paragraphs(offset: int, limit: int) -> str:
    return f"""with d as (select doc_id as id, replace(text, chr(10), chr(10) || chr(10)) as x from documents),
    p as (select id, x, string_split_regex(x, '\\n\\n+') as ps from d),
    u as (select id, unnest(ps) as t, generate_subscripts(ps, 1) as i from p),
    a as (select id, t, i, coalesce(sum(length(t) + 2) over (partition by id order by i rows between unbounded preceding and 1 preceding), 0) as pos from u),
    s as (select id, min(i) as i0 from a where pos + length(t) > {offset} group by id),
    w as (select a.id, a.t, a.i, sum(length(a.t) + 2) over (partition by a.id order by a.i) - 2 as n from a join s on s.id = a.id and a.i >= s.i0),
    k as (select id, string_agg(t, chr(10) || chr(10) order by i) as t from w where n <= {limit} group by id),
    h as (select a.id, a.t as p, greatest(0, {offset} - a.pos)::bigint as rel from a join s on s.id = a.id and s.i0 = a.i),
    r as (select d.id, case when length(h.p) > h.rel then substr(h.p, h.rel + 1) else substr(d.x, {offset} + 1) end as rest from d left join h on h.id = d.id)
    select d.id as doc_id, case when {offset} >= length(x) then '' when {offset} = 0 and length(x) <= {limit} then x else coalesce(nullif(k.t, ''), {Q.sentences('r.rest', limit)}) end as text
    from d left join k on k.id = d.id left join r on r.id = d.id"""


@query(_paragraphs(0, 1500))
def truncate_paragraph(spark, folder):
    """Slices that end with a paragraph, else a sentence."""
    return _sliced(spark, folder, 0, 1500)


@query(_paragraphs(700, 1500))
def truncate_offset(spark, folder):
    """The same from an offset on: the paragraph that holds it comes whole."""
    return _sliced(spark, folder, 700, 1500)


def _sliced(spark, folder, offset, limit):
    x = F.replace(c("text"), F.lit("\n"), F.lit("\n\n"))
    return table(spark, folder, "documents").select("doc_id", text.smart_truncate(x, limit, offset).alias("s")).select("doc_id", "s.text")


@query(
    f"""with recursive t as (select conv_id, text, row_number() over (partition by conv_id order by turn, text) as n from conversations),
    r as (select conv_id, text as x, 1 as n from t where n = 1
    union all select conv_id, {Q.join_pages('x', 'y')} as x, n from (select r.conv_id, r.x, t.n, case when t.n % 2 = 0 then right(r.x, 40) || t.text else t.text end as y from r join t on t.conv_id = r.conv_id and t.n = r.n + 1))
    select conv_id, arg_max(x, n) as text, max(n)::bigint as n_pages from r group by conv_id"""
)
def join_pages(spark, folder):
    """All turns of each conversation joined in order; every other one repeats the end of what was before."""
    turns = table(spark, folder, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"))
    first = F.struct(F.element_at("t", 1)["text"].alias("x"), F.lit(1).alias("n"))

    def step(a, r):
        again = F.when((a["n"] + 1) % 2 == 0, F.concat(F.right(a["x"], F.lit(40)), r["text"])).otherwise(r["text"])
        return F.struct(text.join_pages(a["x"], again).alias("x"), (a["n"] + 1).alias("n"))

    joined = F.aggregate(F.slice("t", 2, F.size("t")), first, step)
    return turns.select("conv_id", joined.alias("j")).select("conv_id", c("j.x").alias("text"), c("j.n").alias("n_pages"))


# --- gates -----------------------------------------------------------------------------------


@query(
    f"""select page_id, (len(regexp_extract_all(x, '(?i)<script[\\s>]')) >= 5) as spa, regexp_matches(x, {Q.lit('(?i)' + V.CHALLENGE)}) as challenge from
    (select page_id, repeat('<script >', (page_id % 7)::int) || (case page_id % 5 when 0 then 'Just a Moment' else '' end) || html as x from pages)"""
)
def page_gates(spark, folder):
    """Script-built pages and challenge pages."""
    x = F.expr("repeat('<script >', cast(page_id % 7 as int)) || (case page_id % 5 when 0 then 'Just a Moment' else '' end) || html")
    return read_pages(spark, folder).select("page_id", H.looks_like_spa(x).alias("spa"), H.looks_like_challenge(x).alias("challenge"))


_TYPES = ("text/html; charset=utf-8", "application/pdf", "application/json", "application/ld+json", "application/rss+xml", "", "image/png", "text/plain")
_TYPE = "(case event_id % 8 " + " ".join(f"when {i} then '{t}'" for i, t in enumerate(_TYPES)) + " end)"


@query(
    f"""select event_id, (case when status < 200 or status > 299 then 'HTTP ' || status || ' ' || event_type when not (t = '' or regexp_matches(t, '(?i){V.CONTENT_TYPES}')) then 'Unsupported content-type: ' || t when length(props) > 9 then 'Page exceeds 9 bytes' end) as error
    from (select event_id, event_type, props, {_TYPE} as t, 200 + 100 * (event_id % 4) as status from events)"""
)
def content_gate(spark, folder):
    """Errors of attempts by status, content type and size."""
    x = table(spark, folder, "events").select("event_id", "event_type", "props", F.expr(_TYPE).alias("t"), F.expr("200 + 100 * (event_id % 4)").alias("status"))
    return x.select("event_id", fetch.gate(c("status"), c("event_type"), c("t"), F.encode("props", "UTF-8"), 9).alias("error"))


_RETRY = "(case event_id % 5 when 0 then cast(event_id % 9 as varchar(9)) when 1 then '-1' when 2 then 'soon' when 3 then '1.5' else null end)"


@query(f"select event_id, (case when try_cast({_RETRY} as double) >= 0 then least(try_cast({_RETRY} as double) * 1000, 5000.0) end) as wait_ms from events")
def retry_after(spark, folder):
    return table(spark, folder, "events").select("event_id", fetch.retry_after_ms(F.expr(_RETRY.replace("varchar(9)", "string"))).alias("wait_ms"))


@query("select doc_id, doc_id % 5 in (1, 2) as is_binary from documents")
def binary_gate(spark, folder):
    """Bodies with a NUL, with more and with fewer control characters than may be, behind the bytes that are looked at, and text."""
    body, controls = F.encode("text", "UTF-8"), lambda n: F.lit(b"\x01" * n + b"a" * (512 - n))
    kinds = F.when(c("doc_id") % 5 == 1, F.concat(F.lit(b"ab\x00"), body)).when(c("doc_id") % 5 == 2, F.concat(controls(154), body)).when(c("doc_id") % 5 == 3, F.concat(controls(153), body)).when(c("doc_id") % 5 == 4, F.concat(controls(0), F.lit(b"\x00\x01"), body)).otherwise(body)
    return table(spark, folder, "documents").select("doc_id", decode.looks_binary(kinds).alias("is_binary"))


# --- URLs and links ------------------------------------------------------------------------------


@query(f"select page_id, {Q.normalize('url')} as norm, {Q.host_of('url')} as host, ({Q.host_of('url')} = 'm.ththth.example.net') as same_host from pages")
def normalize_url(spark, folder):
    u = c("url")
    return read_pages(spark, folder).select("page_id", urls.normalize(u).alias("norm"), urls.host_of(u).alias("host"), urls.same_host(u, F.lit("m.ththth.example.net")).alias("same_host"))


@query(f"select host, count(*) as n_pages, count(distinct norm) as n_urls from (select {Q.host_of('url')} as host, {Q.normalize('url')} as norm from pages) group by host")
def pages_by_host(spark, folder):
    x = read_pages(spark, folder).select(urls.host_of(c("url")).alias("host"), urls.normalize(c("url")).alias("norm"))
    return x.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"), F.countDistinct("norm").alias("n_urls"))


_NOISY = "url || (case page_id % 6 when 0 then '/logo.PNG' when 1 then '/login' when 2 then '/a.css?x' when 3 then '/feed' when 4 then '/a.pngx' else '' end)"


@query(f"select page_id, (regexp_matches(x, {Q.lit('(?i)' + V.NOISE_FILES)}) or regexp_matches(x, {Q.lit('(?i)' + V.NOISE_PATHS)})) as noise from (select page_id, {_NOISY} as x from pages)")
def noise_url(spark, folder):
    return read_pages(spark, folder).select("page_id", urls.is_noise(F.expr(_NOISY)).alias("noise"))


def _links(limit: int) -> str:
    tag = "(?is)<a[^>]+href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
    return f"""with a as (select page_id, url as base, unnest(t) as t, generate_subscripts(t, 1) - 1 as pos from (select page_id, url, regexp_extract_all(html, {Q.lit(tag)})[1:{limit * 4}] as t from pages)),
    r as (select page_id, pos, left({Q.text_only(f"regexp_extract(t, {Q.lit(tag)}, 2)")}, 80) as title, {Q.rooted(f"regexp_extract(t, {Q.lit(tag)}, 1)", 'base')} as url from a),
    o as (select *, row_number() over (partition by page_id, url order by pos) as k from r),
    n as (select *, row_number() over (partition by page_id order by pos) as m from o where k = 1 and title <> '')
    select page_id, pos, title, url from n where m <= {limit}"""


def _link_rows(spark, folder, limit):
    rows = read_pages(spark, folder).select("page_id", F.explode(urls.links(c("html"), c("url"), limit)).alias("l"))
    return rows.select("page_id", c("l.pos").cast("long").alias("pos"), "l.title", "l.url")


@query(_links(50))
def page_links(spark, folder):
    """All links of every page, the first of each URL."""
    return _link_rows(spark, folder, 50)


@query(_links(3))
def page_links_top(spark, folder):
    """The first three links of every page."""
    return _link_rows(spark, folder, 3)


_NAVIGATED = """(case page_id % 4 when 0 then '<link rel="next" href="/p/' || page_id || '">' when 1 then '<a href="/q/' || page_id || '"><b>Next page</b> »</a>' when 2 then '<a href="/r">what is next for us all</a><a href="/s/' || page_id || '">下一页</a>' else '<a href="/t">older</a>' end)"""


@query(f"select page_id, (case page_id % 4 when 0 then {Q.origin('url')} || '/p/' || page_id when 1 then {Q.origin('url')} || '/q/' || page_id when 2 then {Q.origin('url')} || '/s/' || page_id end) as next_url from pages")
def next_link(spark, folder):
    """The next page by rel, by text, or none."""
    return read_pages(spark, folder).select("page_id", urls.next_link(F.concat(F.expr(_NAVIGATED), c("html")), c("url")).alias("next_url"))


# --- feeds, JSON, bytes ----------------------------------------------------------------------------


_FEED = """'<rss><channel><title>Feed &amp;amp; ' || doc_id || '</title><item><title><![CDATA[' || text || ']]></title><link>https://e.example.com/' || doc_id || '</link><description>&lt;p&gt;' || text || '&lt;/p&gt;</description></item><item><title></title></item><item><title>B</title></item></channel></rss>'"""


def _xml_text(x: str) -> str:
    for _ in range(3):
        x = Q.decode_entities(Q.untag(x))
    return Q.squeeze(x)


@query(
    f"""with f as (select doc_id, left({_xml_text("text")}, 120) as t, left({_xml_text("'&lt;p&gt;' || text || '&lt;/p&gt;'")}, 200) as s, 'https://e.example.com/' || doc_id as u from documents)
    select doc_id, 'Feed & ' || doc_id as title, 2::bigint as count, '- ' || t || ' — ' || u || (case when s <> '' then chr(10) || '  ' || s else '' end) || chr(10) || '- B' as text from f"""
)
def feed_parse(spark, folder):
    """Feeds with CDATA, doubly escaped text and an empty item."""
    x = table(spark, folder, "documents").select("doc_id", text.parse_feed(F.expr(_FEED), 20).alias("f"))
    return x.select("doc_id", "f.title", c("f.count").cast("long").alias("count"), "f.text")


@query("""select event_id, '{"k":' || json_extract_string(props, '$.k') || ',"user":' || user_id || ',"list":[1,2]}' as json from events""")
def compact_json(spark, folder):
    x = F.expr("""'{ "k" : ' || get_json_object(props, '$.k') || ',  "user": ' || user_id || '.0, "list": [1, 2.0] }'""")
    return table(spark, folder, "events").select("event_id", jsonx.compact_json(x).alias("json"))


@query("select doc_id, (case when length(text) > 1500 then '\"' || left(text, 1500) || '…[+' || (length(text) - 1500) || ' chars]\"' else '\"' || text || '\"' end) as json from (select doc_id, replace(replace(text, chr(10), ' '), '\"', ' ') as text from documents)")
def compact_json_clip(spark, folder):
    """Long strings of JSON are cut with a mark."""
    x = F.concat(F.lit('"'), F.replace(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit('"'), F.lit(" ")), F.lit('"'))
    return table(spark, folder, "documents").select("doc_id", jsonx.compact_json(x).alias("json"))


@query("""select event_id, '{"1":"\\ud83d😀","id":' || event_id || ',"k":[' || event_id * 1000003 || ',0.5,1e-7,0.000001,1e+21,100000000000000000000,null,9007199254740992,' || (case event_id % 2 when 0 then '0' else '-' || event_id end) || ']}' as json from events""")
def compact_json_numbers(spark, folder):
    """Numbers as doubles in their shortest form, halves of a character pair, keys that are indices first."""
    x = F.concat(F.lit('{"id": '), c("event_id"), F.lit(', "k": ['), c("event_id") * 1000003, F.lit(".0, 5e-1, 1.0E-7, 1e-6, 1e21, 1e20, 1e999, 9007199254740993, "), F.when(c("event_id") % 2 == 0, "-0").otherwise(F.concat(F.lit("-"), c("event_id"), F.lit(".00"))), F.lit('], "1": "\\ud83d\\ud83d\\ude00"}'))
    return table(spark, folder, "events").select("event_id", jsonx.compact_json(x).alias("json"))


@query("select doc_id, (case doc_id % 3 when 0 then 'utf-16le' when 1 then 'utf-16be' else 'utf-8' end) as charset, text from documents union all select -1 - doc_id, ['gbk', 'shift_jis', 'utf-8', 'latin1', 'hex', 'windows-1251'][doc_id % 6 + 1], ['中文页面', '<meta charset=\"shift_jis\">日本語', '中文好', 'naïve “x”', 'plain ü', 'Привет'][doc_id % 6 + 1] from documents")
def decode_roundtrip(spark, folder):
    """Texts encoded three ways and read again by their marks; and by headers and tags, true, wrong and unknown ones."""
    marked = lambda mark, cs: F.concat(F.lit(mark), F.encode("text", cs))
    body = F.when(c("doc_id") % 3 == 0, marked(b"\xff\xfe", "UTF-16LE")).when(c("doc_id") % 3 == 1, marked(b"\xfe\xff", "UTF-16BE")).otherwise(F.encode("text", "UTF-8"))
    x = table(spark, folder, "documents").select("doc_id", body.alias("body"), F.lit("text/html").alias("kind"))
    said = [("中文页面", "gbk", "gb2312"), ('<meta charset="shift_jis">日本語', "cp932", None), ("中文好", "utf-8", "gbk"), ("naïve “x”", "cp1252", "latin1"), ("plain ü", "utf-8", "hex"), ("Привет", "cp1251", "windows-1251")]
    pick = lambda xs: F.element_at(F.array(*xs), (c("doc_id") % 6 + 1).cast("int"))
    more = x.select((-1 - c("doc_id")).alias("doc_id"), pick([F.lit(t.encode(codec)) for t, codec, _ in said]).alias("body"), pick([F.lit(f"text/html; charset={name}" if name else "text/html") for *_, name in said]).alias("kind"))
    return x.union(more).select("doc_id", decode.decode(c("body"), c("kind")).alias("d")).select("doc_id", "d.charset", "d.text")


@query("select event_id, (case event_id % 4 when 0 then 'json' when 1 then 'feed' when 2 then 'unsupported' else 'html' end) as kind from events")
def payload_kind(spark, folder):
    """Payloads told by content type and content."""
    kind, body = F.expr("case event_id % 4 when 0 then 'application/json' when 1 then 'application/rss+xml; charset=x' when 2 then 'text/xml' else 'text/html' end"), F.expr("case event_id % 4 when 0 then props when 1 then '<rss >' when 2 then '<urlset >' else '<p>' end")
    return table(spark, folder, "events").select("event_id", text.payload_kind(kind, body).alias("kind"))


# --- races, caches, batches ------------------------------------------------------------------------


@query("select user_id, count(*) filter (where event_type <> 'error') > 0 as won, arg_min(event_type, (value, event_id)) filter (where event_type <> 'error') as event_type, arg_min(event_id, (value, event_id)) filter (where event_type <> 'error') as event_id, case when count(*) filter (where event_type <> 'error') = 0 then string_agg(event_type, ',' order by event_id) end as errors from events group by user_id")
def race_winner(spark, folder):
    """The first successful attempt of each key."""
    x = table(spark, folder, "events").withColumn("ok", c("event_type") != "error").withColumn("id", c("event_id"))
    out = fetch.race(x, "user_id", "value", "ok", ["event_type", "event_id"], "id")
    return out.select("user_id", "won", "event_type", "event_id", F.array_join("errors", ",").alias("errors"))


@query(
    """with recursive e as (select event_id, user_id % 50 as k, ts, row_number() over (partition by user_id % 50 order by ts, event_id) as n from events),
    r as (select event_id, k, ts, n, ts as stored, false as cached from e where n = 1
    union all select e.event_id, e.k, e.ts, e.n, case when e.ts - r.stored < interval 3600 second then r.stored else e.ts end, e.ts - r.stored < interval 3600 second from r join e on e.k = r.k and e.n = r.n + 1)
    select event_id, cached from r"""
)
def cache_replay(spark, folder):
    """Which requests a cache answers whose entries live an hour from their miss."""
    x = table(spark, folder, "events").select("event_id", (c("user_id") % 50).alias("k"), "ts")
    return cache.replay(x, "k", "ts", "event_id", 3600).select("event_id", "cached")


@query()
def cache_sessions(spark, folder):
    """Answers of bounded caches, one for each of fifty sessions."""
    x = table(spark, folder, "events").select("event_id", "user_id", (c("event_id") % 7).alias("page"), "ts", (c("event_type") != "error").alias("ok"))
    return cache.replay_sessions(x, "user_id", "page", "ts", "event_id", "ok", 86_400, 3, 3_600, 2).select("event_id", "cached")


@query("select page_id, (n < 3 and (page_id % 7 >= 5 or (n = 0 and page_id % 7 >= 1))) as needs, (m > n and page_id % 5 <> 0) as accepts from (select page_id, page_id % 4 as n, page_id % 6 as m from pages)")
def rendered_links(spark, folder):
    """Which pages' links are taken from a rendering."""
    n, m = c("page_id") % 4, c("page_id") % 6
    scripts, challenge = F.expr("repeat('<script>', cast(page_id % 7 as int))"), F.when(c("page_id") % 5 == 0, "just a moment").otherwise("<p>")
    return read_pages(spark, folder).select("page_id", fetch.needs_rendered_links(scripts, n).alias("needs"), fetch.accept_rendered_links(n, challenge, m).alias("accepts"))


@query("select event_id, (case when event_id % 3 in (1, 2) and event_id % 2 = 0 then 'second' else 'first' end) as taken from events")
def second_attempt(spark, folder):
    """Which attempt counts, by status and Retry-After."""
    status = F.expr("case event_id % 3 when 0 then 200 when 1 then 429 else 503 end")
    wait = F.expr("case event_id % 2 when 0 then '1' else 'later' end")
    return table(spark, folder, "events").select("event_id", fetch.second_chance(F.lit("first"), F.lit("second"), status, wait).alias("taken"))


def _requests(spark, folder):
    pages = read_pages(spark, folder)
    # each page asks for itself, for a page that isn't there, for what isn't a page, and for nothing
    return pages.select(c("page_id").alias("request"), F.array(F.concat(F.lit(" "), "url"), F.lit(""), F.concat(F.lit("http://none.example.com/"), c("page_id").cast("string")), F.lit("ftp://x.example.com/")).alias("urls")), pages


@query("select page_id as request, 3::bigint as total, 1::bigint as succeeded, 2::bigint as failed from pages")
def batch_summary(spark, folder):
    """Counts of batch reads; failures don't stop the others."""
    return read.batch_summary(read.batch(*_requests(spark, folder)))


@query(
    f"""select page_id as request, '读取 1/3 页成功，2 页失败' || chr(10) || chr(10) || '--- ' || coalesce(nullif(t, ''), url) || ' (' || length(x) || ' 字符) ---' || chr(10) || coalesce(nullif(x, ''), '{V.NOTHING}') || chr(10) || chr(10) || '[失败] http://none.example.com/' || page_id || ' — HTTP 404 Not Found' || chr(10) || chr(10) || '[失败] ftp://x.example.com/ — Only http/https URLs are supported' as report
    from (select page_id, ' ' || url as url, t, {Q.sliced('x', 3000)} as x from (select page_id, url, {Q.title('html')} as t, {Q.body_text('html')} as x from pages))"""
)
def batch_report(spark, folder):
    """Text forms of batch reads."""
    return read.batch_report(read.batch(*_requests(spark, folder)))


@query(
    f"""select page_id, (case when t <> '' then 'title: ' || t || chr(10) else '' end) || coalesce(nullif(l, '') || chr(10), '') || (case when length(x) > length(s) then '(chars ' || length(s) || '/' || length(x) || ' · 截断 · offset 续读)' else '(chars ' || length(x) || ')' end) || chr(10) || (case when x = '' then '(无可读内容 — {V.HINT_EMPTY})' || chr(10) else '' end) || chr(10) || s as report
    from (select *, {Q.sliced('x', 1500)} as s from (select page_id, {Q.title('html')} as t, {Q.language('html')} as l, {Q.body_text('html')} as x from pages))"""
)
def read_report(spark, folder):
    """Text forms of single reads."""
    r = read.read(read_pages(spark, folder), 1500)
    row = F.struct(*[c(x) for x in ("url", "title", "site_name", "lang", "mode", "truncated", "chars_total", "chars_returned", "chars_start", "text")], F.lit("").alias("published"), F.lit("").alias("author"), F.lit("utf-8").alias("charset"), F.lit(0).alias("feed_count"), F.lit(1).alias("pages"), F.lit(False).alias("rendered"), F.lit("").alias("spa_hint"), F.lit(False).alias("cached"), F.lit(None).cast("string").alias("error"))
    return r.select("page_id", row.alias("r")).select("page_id", render.result(c("r")).alias("report"))


@query(
    f"""select p.page_id, coalesce(count(l.url) || ' link(s) on ' || max(p.url) || ':' || chr(10) || string_agg('- ' || l.title || ' — ' || l.url, chr(10) order by l.pos), 'No links found on ' || max(p.url)) as report from pages p left join ({_links(20)}) l on l.page_id = p.page_id group by p.page_id having count(l.url) > 0
    union all select page_id, 'No links found on ' || url from pages where page_id not in (select page_id from ({_links(20)}))"""
)
def link_report(spark, folder):
    x = read_pages(spark, folder).select("page_id", "url", urls.links(c("html"), c("url"), 20).alias("l"))
    return x.select("page_id", render.link_report(c("url"), c("l")).alias("report"))


@query(
    """select page_id, (n < 200 and (page_id % 7 >= 4 or n = 0)) as needs, (page_id % 5 <> 0 and ((m - n > 50) or (n = 0 and m >= 20))) as accepts from (select page_id, case page_id % 3 when 0 then 0 when 1 then 150 else 250 end as n, page_id % 290 as m from pages)"""
)
def render_choice(spark, folder):
    """Which reads call for rendering, and which renderings are taken."""
    x = read_pages(spark, folder)
    shown = F.expr("repeat('a', case page_id % 3 when 0 then 0 when 1 then 150 else 250 end)")
    scripts, drawn = F.expr("repeat('<script>', 1 + cast(page_id % 7 as int))"), F.expr("repeat('b', cast(page_id % 290 as int))")
    challenge = F.when(c("page_id") % 5 == 0, "just a moment").otherwise("<p>")
    return x.select("page_id", fetch.needs_render(scripts, shown).alias("needs"), fetch.accept_render(shown, challenge, drawn).alias("accepts"))


# --- traversals ----------------------------------------------------------------------------------------


@query(
    f"""with p as (select page_id, {Q.body_text('html')} as x from pages),
    a as (select page_id, x as text, 1::bigint as n from p),
    b as (select a.page_id, case when p.x is null then a.text else {Q.join_pages('a.text', 'p.x')} end as text, a.n + (p.x is not null)::bigint as n from a left join p on p.page_id = a.page_id + 1 and length(p.x) >= 20),
    d as (select b.page_id, case when p.x is null then b.text else {Q.join_pages('b.text', 'p.x')} end as text, b.n + (p.x is not null)::bigint as n from b left join p on p.page_id = b.page_id + 2 and length(p.x) >= 20 and b.n = 2)
    select 'http://chain.example.com/p/' || page_id as url, text, n as n_pages from d"""
)
def paginate(spark, folder):
    """Every page joined with the two that follow it."""
    x = read_pages(spark, folder)
    name = lambda i: F.concat(F.lit("http://chain.example.com/p/"), i.cast("string"))
    pages = x.select(name(c("page_id")).alias("norm"), H.body_text(c("html")).alias("text"), name(c("page_id") + 1).alias("next"))
    out = navigate.paginate(pages.select(c("norm").alias("url")), pages, 3)
    return out.select("url", "text", c("n_pages").cast("long").alias("n_pages"))


def _site(spark, folder, body=None):
    """Sites of fifty pages: page i of a site links to 3i+1, 3i+2, 3i+3, to itself, outside and to a picture."""
    url = lambda site, i: F.concat(F.lit("http://s"), site.cast("string"), F.lit(".example.com/"), i.cast("string"))
    site, i = F.floor(c("page_id") / 50), c("page_id") % 50
    own = [url(site, i * 3 + k) for k in (1, 2, 3)] + [url(site, i), F.lit("http://o.example.com/"), F.concat(url(site, i), F.lit(".png"))]
    return read_pages(spark, folder).select(url(site, i).alias("norm"), F.array(*own).alias("links"), H.title(c("html")).alias("title"), *([body.alias("text")] if body is not None else []))


_CRAWL = f"""with recursive p as (select page_id // 50 as site, page_id % 50 as i, {Q.title('html')} as title from pages),
    w as (select site, 0::bigint as i, 0 as depth from p where i = 0
    union all select w.site, w.i * 3 + k.k, w.depth + 1 from w join p on p.site = w.site and p.i = w.i join (values (1), (2), (3)) k(k) on true where w.depth < 3)
    select w.site, w.i, w.depth, p.title from w left join p on p.site = w.site and p.i = w.i"""


@query(f"select 'http://s' || site || '.example.com/0' as entry, 'http://s' || site || '.example.com/' || i as url, depth::bigint as depth, title, case when title is null then 'HTTP 404 Not Found' end as error from ({_CRAWL})")
def crawl_site(spark, folder):
    """Breadth-first walks of all sites to depth three."""
    pages = _site(spark, folder)
    entries = pages.filter(c("norm").endswith("/0")).select(c("norm").alias("entry"))
    walk = navigate.crawl(entries, pages, 50, 3)
    return walk.select("entry", "url", c("depth").cast("long").alias("depth"), "title", "error")


@query(f"select 'http://s' || site || '.example.com/0' as entry, count(*) as total, count(title) as succeeded, count(*) - count(title) as failed from ({_CRAWL}) group by site")
def crawl_summary(spark, folder):
    """Counts of those walks."""
    pages = _site(spark, folder)
    return navigate.site_summary(navigate.crawl(pages.filter(c("norm").endswith("/0")).select(c("norm").alias("entry")), pages, 50, 3))


@query(
    f"""with w as (select w.site, w.i, w.depth, t.title, t.x from ({_CRAWL}) w left join (select page_id, {Q.title('html')} as title, {Q.body_text('html')} as x from pages) t on t.page_id = w.site * 50 + w.i and w.title is not null),
    u as (select *, 'http://s' || site || '.example.com/' || i as url from w)
    select 'http://s' || site || '.example.com/0' as entry, '站点: s' || site || '.example.com · 爬取 ' || count(x) || '/' || count(*) || ' 页' || (case when count(*) > count(x) then ' · ' || (count(*) - count(x)) || ' 页失败' else '' end)
    || coalesce(string_agg(chr(10) || repeat('  ', depth::int) || '[' || depth || '] ' || coalesce(nullif(title, ''), url) || ' (' || length(x) || ' 字符)  ' || url || (case when x <> '' then chr(10) || repeat('  ', depth::int) || '   ' || left(x, 80) else '' end), '' order by depth, i) filter (where x is not null), '')
    || coalesce(string_agg(chr(10) || '[失败] ' || url || ' — HTTP 404 Not Found', '' order by depth, i) filter (where x is null), '') as report from u group by site"""
)
def crawl_report(spark, folder):
    """The text form of each walk: its head, a line and the first words of each page, the failures."""
    pages = _site(spark, folder, H.body_text(c("html")))
    walk = navigate.crawl(pages.filter(c("norm").endswith("/0")).select(c("norm").alias("entry")), pages, 50, 3)
    return navigate.site_report(walk.withColumn("chars", F.length("text")))


# --- whole reads -----------------------------------------------------------------------------------------


_MORE = "'More of page ' || page_id || ', and enough of it.'"
_RAW = "http://raw.example.com/"


@query(
    f"""with p as (select page_id, page_id % 8 as k, '{_RAW}' || page_id as url, html, {Q.body_text('html')} as x, {Q.title('html')} as t, {Q.language('html')} as l from pages)
    select url, (case k when 1 then 'HTTP 404 Not Found' when 2 then '{V.SITEMAP}' when 6 then 'Unsupported content-type: image/png' end) as error,
    (case k when 0 then 'html' when 3 then 'json' when 4 then 'html' when 5 then 'html' when 7 then 'feed' end) as kind,
    (case when k in (0, 4, 5) then t when k = 3 then '' when k = 7 then 'Feed' end) as title,
    (case when k in (0, 4, 5) then 'utf-8' when k = 3 then 'json' when k = 7 then 'feed' end) as charset,
    (case when k in (0, 4) then x when k = 5 then {Q.join_pages('x', _MORE)} when k = 3 then '{{"id":' || page_id || '}}' when k = 7 then '- T — http://e/' || page_id end) as text,
    (case when k in (1, 2, 6) then 0 when k = 5 then 2 else 1 end)::bigint as pages, k = 4 and length(x) >= 20 as is_rendered from p
    union all select '{_RAW}n/' || page_id, null, 'html', '', 'utf-8', {_MORE}, 1, false from pages where page_id % 8 = 5"""
)
def whole_read(spark, folder):
    """All steps of a read in one plan: gates, payloads, a rendering in place of an empty page, a continuation."""
    x = read_pages(spark, folder)
    k, number, raw = c("page_id") % 8, c("page_id").cast("string"), F.lit(_RAW)
    scripts = F.lit("<html><body >" + "<script >x</script>" * 5 + "</body></html>")
    next_page = F.concat(F.lit('<link rel="next" href="/n/'), number, F.lit('">'), c("html"))
    text_ = F.when(k == 2, "<urlset ></urlset>").when(k == 3, F.concat(F.lit('{ "id" : '), number, F.lit("}"))).when(k == 4, scripts).when(k == 5, next_page).when(k == 7, F.concat(F.lit("<rss ><title>Feed</title><item><title>T</title><link>http://e/"), number, F.lit("</link></item></rss>"))).otherwise(c("html"))
    kind = F.when(k == 2, "application/xml").when(k == 3, "application/json").when(k == 6, "image/png").when(k == 7, "application/rss+xml").otherwise("text/html; charset=utf-8")
    status = F.when(k == 1, 404).otherwise(200)
    rows = x.select(F.concat(raw, number).alias("url"), status.alias("status"), F.when(k == 1, "Not Found").otherwise("OK").alias("reason"), kind.alias("content_type"), F.encode(text_, "UTF-8").alias("body"), F.when(k == 4, c("html")).alias("rendered"))
    more = x.filter(k == 5).select(F.concat(raw, F.lit("n/"), number).alias("url"), F.lit(200).alias("status"), F.lit("OK").alias("reason"), F.lit("text/html").alias("content_type"), F.encode(F.concat(F.lit("<article ><p>"), F.expr(_MORE), F.lit("</p></article>")), "UTF-8").alias("body"), F.lit(None).cast("string").alias("rendered"))
    return read.whole(rows.unionByName(more)).select("url", "error", "kind", "title", "charset", "text", F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("is_rendered", F.lit(False)).alias("is_rendered"))


@query(
    f"""select page_id as request, '读取 1/1 页成功' || chr(10) || chr(10) || '--- ' || coalesce(nullif(t, ''), url) || ' (' || length(x) || ' 字符) ---' || chr(10) || coalesce(nullif(x, ''), '{V.NOTHING}') || coalesce(chr(10) || 'links: ' || l.shown || (case when l.n > 6 then ' …共' || l.n || '个' else '' end), '') as report
    from (select page_id, url, t, {Q.sliced('x', 500)} as x from (select page_id, url || '?p=' || page_id as url, {Q.title('html')} as t, {Q.body_text('html')} as x from pages)) p
    left join (select page_id as id, count(*) as n, string_agg(title || ' — ' || url, ' | ' order by pos) filter (where m <= 6) as shown from (select *, row_number() over (partition by page_id order by pos) as m from ({_links(20)})) group by page_id) l on l.id = p.page_id"""
)
def batch_links(spark, folder):
    """Batch reads with the first links of each page, and their number."""
    pages = read_pages(spark, folder).withColumn("url", F.concat("url", F.lit("?p="), "page_id"))
    return read.batch_report(read.batch(pages.select(c("page_id").alias("request"), F.array("url").alias("urls")), pages, 500, max_links=20))


@query("select page_id as request, 10::bigint as total, 0::bigint as succeeded, 10::bigint as failed from pages")
def batch_cap(spark, folder):
    """Of eleven addresses and a blank one the first ten are read."""
    pages = read_pages(spark, folder)
    asked = F.concat(F.array(F.lit(" ")), F.transform(F.sequence(F.lit(1), F.lit(11)), lambda i: F.concat(F.lit("http://none.example.com/"), i.cast("string"))))
    return read.batch_summary(read.batch(pages.select(c("page_id").alias("request"), asked.alias("urls")), pages))


@query("select doc_id, 5::bigint as count, '- ' || doc_id || '.1' || chr(10) || '- ' || doc_id || '.2' || chr(10) || '- ' || doc_id || '.3' || chr(10) || '- ' || doc_id || '.4' || chr(10) || '- ' || doc_id || '.6' as text from documents")
def feed_limit(spark, folder):
    """Of eight items the first five that say anything."""
    items = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.when(i == 5, "<entry ><title> </title></entry>").otherwise(F.concat(F.lit("<entry ><title>"), c("doc_id"), F.lit("."), i, F.lit("</title></entry>")))), "")
    x = table(spark, folder, "documents").select("doc_id", text.parse_feed(F.concat(F.lit("<feed >"), items, F.lit("</feed>")), 5).alias("f"))
    return x.select("doc_id", "f.count", "f.text")
