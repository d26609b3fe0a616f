"""Personal data by weak supervision, in DataFrame functions only.

Base spans follow fixed patterns and checks and always count.  Further
candidates come from stricter or looser forms (digits next to other digits,
national phone numbers, written-out addresses).  Labelers - the form's own
check, gazetteers, words nearby, the characters around - vote for, against or
abstain on every span.  Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is per kind, with no more given
than a weak prior and that none is worse than chance.  A logistic classifier
is trained on the resulting probabilities and decides on the further
candidates; besides the votes it sees what no labeler looks at: the span's
length, how its digits are parted, and what kind of character comes before.
Only counts of patterns, whose number is fixed, reach the driver.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import finished, load, written
from leafmill.llm.spans import between, chunks, last_before, let, overlaps
from leafmill.llm.spans import found as _found

KINDS = ("email", "ip", "card", "phone")

# Base patterns.  Each takes what the plain pattern takes, without its retries:
# runs are possessive, and a match starts where a run starts or the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Forms of further candidates.
MORE = {
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?\[\.\]\x20?[0-9]{1,3}){3}(?![0-9])|(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9a-f:])",
    "email": r"(?i)[a-z0-9][a-z0-9._%+-]{0,63}\x20?[\[(]\x20?at\x20?[\])]\x20?[a-z0-9-]{1,63}\x20?(?:[\[(]\x20?dot\x20?[\])]|\.)\x20?[a-z]{2,24}",
    "card": r"(?<![0-9])(?:(?:[0-9]{4}[\x20-]){3}[0-9]{4}|[0-9]{13,19})(?![0-9])",
    "phone": r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9])|(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: Gazetteers: forms that are known to be in use, and those known not to be personal.
KNOWN = {
    "email": r"(?i)(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu)$",
    "ip": r"^(?:[1-9][0-9]?|1[0-9][0-9]|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)",
    "phone": r"^\+?(?:1[^0-9]|7[^0-9]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|^\(?[2-9][0-9]{2}",
}
RESERVED = {"email": r"(?i)(?:noreply|no-reply|donotreply|postmaster)", "ip": r"^(?:0|127|255)\.", "card": r"^(?:0+|1+)[\x20-]?", "phone": r"(?:0000|1234567)"}
#: Words before a span that speak for and against it.
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|address|correo|courriel)\W*$",
    "ip": r"(?i)\b(?:ip|host|server|address|from|client)\W*$",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|payment|karte|carte|tarjeta)\W*$",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|fax|cell|telefon|tel[eé]fono)\W*$",
}
AGAINST = r"(?i)\b(?:version|v|release|isbn|order|invoice|serial|section|figure|no)\W*$"
LABELERS = ("check", "gazetteer", "context", "edges")
#: First guess of each labeler's reliability, which counts as so many votes, and the bounds of any: not below chance, never certain.
TRUST, PRIOR_VOTES, LEAST, MOST = (0.95, 0.7, 0.7, 0.7), 20, 0.5, 0.995
#: What of a span, besides votes, the classifier sees; at most 4 x 2 x 3 ** 4 x 13 x 5 x 5 patterns in all.
SHAPE = ("size", "form", "lead")


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.split(F.reverse(d), "")
    total = F.aggregate(
        F.transform(F.filter(each, lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.when(c.cast("int") >= 5, 1).otherwise(0))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return total % 10 == 0


def passes(kind: str, m: Column) -> Column:
    """The check that a base match of a kind has to pass."""
    d = digits(m)
    if kind == "ip":
        # leading zeros don't count; then up to three digits are left of a part that may pass
        parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, r"^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) > 3, F.lit(False)).otherwise(F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(d).between(8, 15)
    return F.lit(True)


def _votes(kind: str, base: bool, r: Column) -> dict[str, Column]:
    """Votes (1 for, -1 against, 0 none) of the labelers on a span."""
    m, d = r["m"], digits(r["m"])
    yes = lambda c: F.when(c, 1).otherwise(0)
    check = {"card": F.when(luhn(d), 1).otherwise(-1), "phone": F.when(F.length(d).between(8, 15), 1).otherwise(0 if not base else -1)}.get(kind, F.lit(1 if base else 0))
    return {
        "check": check,
        "gazetteer": F.when(m.rlike(RESERVED[kind]), -1).otherwise(yes(m.rlike(KNOWN[kind]))),
        "context": F.when(r["before"].rlike(AGAINST), -1).otherwise(yes(r["before"].rlike(CUES[kind]))),
        "edges": F.when(r["before"].rlike(r"[\p{L}0-9_]$") | r["after"].rlike(r"^[\p{L}0-9_]"), -1).otherwise(F.when((r["before"] == "") | r["before"].rlike(r"[\s(\[<\"':;,=]$"), 1).otherwise(0)),
    }


def _shape(r: Column) -> dict[str, Column]:
    """Length in steps of four characters, up to 12 steps; what parts the digits; the class of the character before."""
    m, c = r["m"], F.right(r["before"], F.lit(1))
    marks = F.array_distinct(F.regexp_extract_all(m, F.lit(r"[\x20.()-]"), F.lit(0)))
    form = F.when(F.size(marks) > 1, 4).otherwise(F.coalesce(F.nullif(F.array_position(F.array(F.lit(" "), F.lit("-"), F.lit(".")), F.get(marks, F.lit(0))), F.lit(0)), F.when(F.size(marks) == 1, 4).otherwise(0)))
    lead = F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"\p{L}"), 2).when(c.rlike("[0-9]"), 3).otherwise(4)
    return {"size": F.least(F.floor((r["end"] - r["start"]) / 4), F.lit(12)).cast("int"), "form": form.cast("int"), "lead": lead}


def candidates(text: Column) -> Column:
    """All spans of a text: array of (kind, start, end, base, votes, shape)."""
    number = text.rlike("[0-9]")
    asked = {"email": text.contains("@"), "ip": number & text.contains("."), "card": number, "phone": number & text.contains("+")}
    more = {"email": text.rlike(r"(?i)[\[(]\x20?at\x20?[\])]"), "ip": number & (text.contains("[.]") | text.rlike("(?i)[0-9a-f]:[0-9a-f]{1,4}:")), "card": number, "phone": number}
    none = F.array().cast("array<struct<" + ",".join(["kind:int", "start:int", "end:int", "base:boolean", *(f"{x}:int" for x in (*LABELERS, *SHAPE))]) + ">>")

    def spans(kind: str, base: bool, guard: Column, pattern: str) -> Column:
        found = _found(text, pattern)
        if base:
            found = F.filter(found, lambda r: passes(kind, r["m"]))
        row = lambda r: F.struct(F.lit(KINDS.index(kind)).alias("kind"), r["start"].alias("start"), r["end"].alias("end"), F.lit(base).alias("base"), *[v.alias(n) for n, v in {**_votes(kind, base, r), **_shape(r)}.items()])
        return F.coalesce(F.when(guard, F.transform(found, row)), none)

    return F.concat(*[spans(k, True, asked[k], BASE[k]) for k in KINDS]), F.concat(*[spans(k, False, more[k], MORE[k]) for k in KINDS])


def reliabilities(counts: dict[tuple, float], rounds: int = 100) -> tuple[dict, dict]:
    """EM over vote patterns: (posterior of each pattern, (kind, labeler) -> share of right votes).

    ``counts``: (kind, base, votes, shape) -> spans.  Spans of a kind are true
    with an unknown share; a labeler that votes is right with its own
    probability.  The first guesses count as a few votes, so that spans decide.
    """
    right = {(k, i): TRUST[i] for k in range(len(KINDS)) for i in range(len(LABELERS))}
    prior = {k: 0.7 for k in range(len(KINDS))}
    votes: dict[tuple, float] = {}
    for (k, _, v, _), c in counts.items():
        votes[k, v] = votes.get((k, v), 0.0) + c
    post: dict[tuple, float] = {}
    for _ in range(rounds):
        for k, v in votes:
            s = log(prior[k] / (1 - prior[k])) + sum(x * log(right[k, i] / (1 - right[k, i])) for i, x in enumerate(v))
            post[k, v] = 1 / (1 + exp(-max(-30.0, min(30.0, s))))
        for k in prior:
            own = [(v, c, post[k, v]) for (kind, v), c in votes.items() if kind == k]
            prior[k] = min(0.99, max(0.01, (sum(c * p for _, c, p in own) + 1) / (sum(c for _, c, _ in own) + 2)))
            for i in range(len(LABELERS)):
                good = sum(c * (p if v[i] > 0 else 1 - p) for v, c, p in own if v[i])
                all_ = sum(c for v, c, _ in own if v[i])
                right[k, i] = min(MOST, max(LEAST, (good + TRUST[i] * PRIOR_VOTES) / (all_ + PRIOR_VOTES)))
    return {p: post[p[0], p[2]] for p in counts}, right


def features(p: tuple) -> list[tuple]:
    kind, _, votes, shape = p
    return [("bias", 0), ("kind", kind), *(("shape", kind, i, x) for i, x in enumerate(shape)), *(("vote", kind, i, v) for i, v in enumerate(votes))]


def classifier(counts: dict[tuple, float], post: dict[tuple, float], rounds: int = 300) -> dict[tuple, float]:
    """Weights of a logistic regression of the posteriors on votes and shapes, by gradient steps over the counted patterns."""
    w: dict[tuple, float] = {}
    total = sum(counts.values()) or 1.0
    rows = [(features(p), c / total, post[p]) for p, c in counts.items()]
    for _ in range(rounds):
        g: dict[tuple, float] = {}
        for fs, c, y in rows:
            e = c * (1 / (1 + exp(-max(-30.0, min(30.0, sum(w.get(f, 0.0) for f in fs))))) - y)
            for f in fs:
                g[f] = g.get(f, 0.0) + e
        for f, x in g.items():
            w[f] = w.get(f, 0.0) - 2.0 * (x + 1e-4 * w.get(f, 0.0))
    return w


def _decision(w: dict[tuple, float], s: Column) -> Column:
    """Whether the classifier takes a span of the array."""
    at = lambda *f: F.lit(float(w.get(f, 0.0)))

    def choose(options: list[tuple[Column, Column]]) -> Column:
        out = F.lit(0.0)
        for c, v in options:
            out = F.when(c, v).otherwise(out)
        return out

    total = at("bias", 0)
    for k in range(len(KINDS)):
        own = at("kind", k)
        for i, name in enumerate(SHAPE):
            own = own + choose([(s[name] == n, at("shape", k, i, n)) for n in range(13) if ("shape", k, i, n) in w])
        for i, name in enumerate(LABELERS):
            own = own + choose([(s[name] == v, at("vote", k, i, v)) for v in (-1, 0, 1)])
        total = total + F.when(s["kind"] == k, own).otherwise(F.lit(0.0))
    return total >= 0


def detect(docs: DataFrame, text: str = "text", extra: list[Column] | None = None) -> DataFrame:
    """(extra columns, base, spans): the base and all spans of every row's whole text, by kind, then start.

    Spans are (kind number, start, end) in code points, end exclusive.  Null
    text is empty.  The spans table is written once; all rows of the input are
    there, repeated ones too.  ``extra`` columns are carried along.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base, more = candidates(body)
    rows = written(docs.select(*(extra or []), base.alias("base"), more.alias("more")), "spans")
    # base spans of one kind are disjoint and in order
    of_kind = let(F.col("base"), by_kind)
    clash = lambda kinds, e: F.exists(kinds, lambda own: overlaps(own, e["start"], e["end"]))
    rows = rows.withColumn("more", F.when(F.size("more") > 0, let(of_kind, lambda kinds: F.filter("more", lambda e: ~clash(kinds, e)))).otherwise(F.col("more")))
    each = rows.select(F.explode(F.concat("base", "more")).alias("s")).select("s.*")
    found = each.groupBy("kind", "base", *LABELERS, *SHAPE).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {(r["kind"], r["base"], tuple(r[x] for x in LABELERS), tuple(r[x] for x in SHAPE)): float(r["n"]) for r in found}
    post, _ = reliabilities(counts)
    w = classifier(counts, post)
    taken = F.filter("more", lambda s: _decision(w, s))
    short = lambda a: F.array_sort(F.transform(a, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    return rows.withColumn("spans", short(F.concat(F.col("base"), taken))).withColumn("base", short(F.col("base"))).drop("more")


def by_kind(spans: Column) -> Column:
    """The spans of each kind, as an array of arrays."""
    own = lambda k: F.filter(spans, lambda s: s["kind"] == k)
    return F.array(*[own(k) for k in range(len(KINDS))])


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, text: str = "text", count: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one.

    All rows and columns are kept; ``count``, if there is such a column, is
    set anew where the text has changed.
    """
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    found = detect(docs, text, [F.col(f"`{c}`").alias(n) for c, n in names.items()])
    body, labels = F.col(names[text]), F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def replaced(x: Column) -> Column:
        """Each span that starts behind the end of all before it gives what lies between, and its label."""

        def one(s: Column, i: Column) -> Column:
            reach = F.array_max(F.transform(x["kinds"], lambda own: F.coalesce(last_before(own, s["start"])["end"], F.lit(0))))
            # of spans that start together the first in order counts
            again = (i > 0) & (F.get(x["all"], i - 1)["start"] == s["start"])
            return F.when(again | (s["start"] < reach), "").otherwise(F.concat(between(x["parts"], reach, s["start"]), F.get(labels, s["kind"])))

        last = F.array_max(F.transform(x["all"], lambda s: s["end"]))
        return F.concat(F.array_join(F.transform(x["all"], one), ""), between(x["parts"], last, x["n"]))

    done = let(F.struct(by_start.alias("all"), by_kind(F.col("spans")).alias("kinds"), chunks(body).alias("parts"), F.length(body).alias("n")), replaced)
    found = found.withColumn("_new", F.when(F.size("spans") > 0, done).otherwise(body))
    out = []
    for c, n in names.items():
        col = F.col("_new") if c == text else F.col(n)
        if c == count:
            col = F.when((F.size("spans") > 0) & F.col(n).isNotNull(), F.length("_new").cast(docs.schema[c].dataType)).otherwise(F.col(n))
        out.append(col.alias(c))
    return found.select(*out)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = finished(lambda: detect(load(spark, sf_dir, "documents"), extra=[F.col("doc_id")]), "personal-data")
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[number(k) for k in KINDS], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
