"""Fetching as relational steps: a lookup of URLs in a snapshot of pages, gates, retries and races."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import values as V
from leafmill.functions.html import looks_like_challenge, looks_like_spa
from leafmill.functions.urls import fetchable_scheme, normalize
from leafmill.operators.decode import looks_binary


def retry_after_ms(header: Column) -> Column:
    """Milliseconds to wait by a Retry-After header in seconds, at most five seconds; null for anything else."""
    seconds = header.try_cast("double")
    return F.when((seconds >= 0) & (seconds < float("inf")), F.least(seconds * 1000, F.lit(float(V.RETRY_CAP_MS))))


def fetchable_type(content_type: Column) -> Column:
    """Whether a content type can be read; none at all passes."""
    return F.coalesce(content_type, F.lit("")).rlike(f"(?i){V.CONTENT_TYPES}") | (F.coalesce(content_type, F.lit("")) == "")


def gate(status: Column, reason: Column, content_type: Column, body: Column, max_bytes: int) -> Column:
    """The error of an attempt, or null if its body can be read."""
    bare = F.coalesce(content_type, F.lit("")) == ""
    return (
        F.when(~status.between(200, 299), F.concat(F.lit("HTTP "), status.cast("string"), F.lit(" "), F.coalesce(reason, F.lit(""))))
        .when(~fetchable_type(content_type), F.concat(F.lit("Unsupported content-type: "), content_type))
        .when(F.octet_length(body) > max_bytes, F.lit(f"Page exceeds {max_bytes} bytes"))
        .when(bare & looks_binary(body), F.lit("Unsupported content: binary"))
    )


def lookup(urls: DataFrame, pages: DataFrame, url: str = "url", page_url: str = "url") -> DataFrame:
    """Every requested URL with its page's columns and ``error``: one equi-join on the normal form.

    Of pages with one normal form, that with the smallest URL is taken.
    Neither side is broadcast by hint: both can be large.
    """
    own = [c for c in pages.columns if c != page_url]
    keyed = pages.withColumn("_norm", normalize(F.col(page_url))).filter("_norm is not null")
    one = keyed.groupBy("_norm").agg(F.min_by(F.struct(F.col(page_url).alias("_u"), *own), F.col(page_url)).alias("_p"))
    asked = urls.withColumn("_norm", normalize(F.col(url)))
    joined = asked.join(one, "_norm", "left")
    error = F.when(~fetchable_scheme(F.col(url)), "Only http/https URLs are supported").when(F.col("_p").isNull(), "HTTP 404 Not Found")
    return joined.select(*urls.columns, *[F.col(f"_p.{c}").alias(c) for c in own if c not in urls.columns], F.col("_p._u").alias("final_url"), error.alias("error"))


def race(attempts: DataFrame, key: str, latency: str, ok: str, values: list[str], order: str) -> DataFrame:
    """The first success of each key by latency, else all errors in order: (key, won, values..., errors)."""
    best = F.min(F.when(F.col(ok), F.struct(F.col(latency), F.col(order), *values)))
    failed = F.sort_array(F.collect_list(F.when(~F.col(ok), F.struct(F.col(order), F.col(values[0])))))
    out = attempts.groupBy(key).agg(best.alias("b"), failed.alias("f"))
    return out.select(key, F.col("b").isNotNull().alias("won"), *[F.col(f"b.{v}").alias(v) for v in values], F.when(F.col("b").isNull(), F.transform("f", lambda x: x[values[0]])).alias("errors"))


def retried(status: Column, retry_after: Column) -> Column:
    """Whether a first attempt is made once more: too many requests or unavailable, with a wait that can be read."""
    return F.coalesce(status.isin(429, 503) & retry_after_ms(retry_after).isNotNull(), F.lit(False))


def second_chance(first: Column, second: Column, status: Column, retry_after: Column) -> Column:
    """The second attempt where the first is retried, else the first."""
    return F.when(retried(status, retry_after), second).otherwise(first)


def needs_render(html: Column, text: Column) -> Column:
    """Whether a static read is thin enough, and scripted enough, to be rendered."""
    scripted = html.rlike("(?i)<script")
    return ((text == "") | (F.length(text) < V.ARTICLE_MIN)) & (looks_like_spa(html) | ((text == "") & scripted))


def accept_render(text: Column, rendered_html: Column, rendered_text: Column) -> Column:
    """Whether a rendered read replaces the static one: no challenge page, and enough more text."""
    gain = F.length(rendered_text) - F.length(text)
    better = (gain > 50) | ((text == "") & (F.length(rendered_text) >= 20))
    return F.coalesce(~looks_like_challenge(rendered_html) & ~looks_like_challenge(rendered_text) & better, F.lit(False))


def needs_rendered_links(html: Column, n_links: Column) -> Column:
    """Whether a page shows so few links, and so many scripts, that its rendering is asked for links."""
    return F.coalesce((n_links < 3) & (looks_like_spa(html) | ((n_links == 0) & html.rlike("(?i)<script"))), F.lit(False))


def accept_rendered_links(n_links: Column, rendered_html: Column, n_rendered: Column) -> Column:
    """Whether a rendering's links replace the static ones: more of them, and no challenge page."""
    return F.coalesce((n_rendered > n_links) & ~looks_like_challenge(rendered_html), F.lit(False))
