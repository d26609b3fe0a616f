"""Matches of a pattern with their places, in DataFrame functions only.

All steps take time in proportion to the text, however many matches it has:
lists grow in groups of a fixed size, places in a text are looked up in chunks
of it, and spans are searched by bisection.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points of a chunk, elements of a group, and characters of a match's surroundings.
CHUNK, GROUP, BEFORE, AFTER = 4096, 256, 40, 40

SPAN = "array<struct<m:string,before:string,after:string,start:int,end:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def between(parts: Column, start: Column, end: Column) -> Column:
    """Code points from ``start`` up to ``end`` of the text whose chunks are given; '' if there are none."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor((end - 1) / CHUNK).cast("int")
    head, tail = F.substring(F.get(parts, first), start % CHUNK + 1, end - start), F.left(F.get(parts, last), (end - 1) % CHUNK + 1)
    inner = F.when(last - first > 1, F.array_join(F.transform(F.sequence(first + 1, last - 1), lambda i: F.get(parts, i)), "")).otherwise("")
    return F.when(end <= start, "").when(first == last, head).otherwise(F.concat(head, inner, tail))


def _group(n: Column, g: Column) -> Column:
    return F.sequence(g * GROUP, F.least(n, (g + 1) * GROUP) - 1)


def _appended(start: Column, items: Column, value: Callable[[Column], Column]) -> Column:
    """The sums before each of a few items."""
    zero = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda a, x: F.struct((a["at"] + value(x)).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
    return F.aggregate(items, zero, step, lambda a: a["out"])


def sums_before(values: Column) -> Column:
    """For each of an array of integers, the sum of all before it."""

    def of(v: Column) -> Column:
        n, at = F.size(v), lambda i: F.get(v, i)
        groups = F.sequence(F.lit(0), F.floor((n - 1) / GROUP).cast("int"))
        totals = F.transform(groups, lambda g: F.aggregate(_group(n, g), F.lit(0), lambda a, i: a + at(i)))
        starts = _appended(F.lit(0), totals, lambda x: x)
        return F.flatten(F.transform(starts, lambda s, g: _appended(s, _group(n, g), at)))

    return let(values, lambda v: F.when(F.size(v) > 0, of(v)).otherwise(F.array().cast("array<int>")))


def found(text: Column, pattern: str) -> Column:
    """Every match with its start, end, and the text before and after it."""
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps"), F.length(text).alias("n"))

    def placed(x: Column) -> Column:
        gap = lambda i: F.length(F.get(x["gaps"], i))
        before = sums_before(F.transform(x["hits"], lambda m, i: F.length(m) + gap(i)))
        spans = let(before, lambda at: F.transform(x["hits"], lambda m, i: F.struct(m.alias("m"), (F.get(at, i) + gap(i)).alias("start"), (F.get(at, i) + gap(i) + F.length(m)).alias("end"))))
        parts = chunks(text)
        around = lambda p, s: F.struct(s["m"].alias("m"), between(p, F.greatest(s["start"] - BEFORE, F.lit(0)), s["start"]).alias("before"), F.coalesce(between(p, s["end"], F.least(s["end"] + AFTER, x["n"])), F.lit("")).alias("after"), s["start"].alias("start"), s["end"].alias("end"))
        return let(parts, lambda p: F.transform(spans, lambda s: around(p, s)))

    return let(both, lambda x: F.when(F.size(x["hits"]) > 0, placed(x)).otherwise(F.array().cast(SPAN)))


def last_before(spans: Column, end: Column) -> Column:
    """The last of disjoint spans, in order, that starts before ``end``; null if there is none."""
    n = F.size(spans)
    steps = F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int"))

    def halve(a: Column, _: Column) -> Column:
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        low = F.get(spans, mid)["start"] < end
        open_ = a["lo"] < a["hi"]
        return F.struct(F.when(open_ & low, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(open_ & ~low, mid).otherwise(a["hi"]).alias("hi"))

    place = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), n.alias("hi")), halve, lambda a: a["lo"])
    return F.when(n > 0, F.get(spans, place - 1))


def overlaps(spans: Column, start: Column, end: Column) -> Column:
    """Whether a span overlaps any of disjoint spans in order."""
    return F.coalesce(last_before(spans, end)["end"] > start, F.lit(False))
