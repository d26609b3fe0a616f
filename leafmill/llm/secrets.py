"""Secret scanning with a random forest against false positives, in DataFrame functions only.

Candidates are long tokens with a digit, and whatever is assigned to a name
such as password, follows "Bearer", or stands for the password of a URL.  The
forest, trained on labelled findings, sees a candidate's length, the
transitions between its characters (from each class to each other, and how
many pairs of letters are common in words), how much of it dictionary words
cover, what its path and the 40 characters before and after it say, and the known forms
of providers' keys.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import finished, load, written
from leafmill.llm.spans import SPAN, found, overlaps

TOKEN = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{12,}+={0,2}"
NAMED = r"(?i)(?:passw(?:or)?d|pwd|secret|token|api_?-?key|access_?-?key|credential)"
GIVEN = r"(?i)\b(?:bearer|basic)\x20|://[^\s/:@]{1,64}:[^\s/@]"
ASSIGNED = (
    r"(?<=(?i:password|passwd|pwd|secret|token|apikey|api_key|api-key|access_key|credential)(?i:s|_?[a-z0-9]{1,8}){0,1}[\"']{0,1}\x20{0,2}[=:]\x20{0,2}[\"']{0,1})[^\s\"'=:]{8,}+"
    r"|(?<=\b(?i:bearer|basic)\x20)[A-Za-z0-9._~+/=-]{8,}+"
    r"|(?<=://[^\s/:@]{1,64}:)[^\s/@:]{4,64}(?=@)"
)
#: Words that cover parts of names, paths and placeholders, but not of random strings (fixed values).
WORDS = (
    "about access account address admin after again allow alpha array async await backup base batch beta block buffer build bytes cache call change char check class client close code column commit common config "
    "const content context control copy count create current data date debug default delete demo description device digest dummy email empty error event example fail false field file filter final first float "
    "format from function get global group handle hash head header here host html http image import index info init input insert integer item json key label last left length level library limit line link list "
    "load local lock login main make master max message meta method min mock mode model module name next node none null number object option order output package page param parse password path pattern placeholder "
    "point port print private process project property public query queue read ref release remove replace report request reset resource response result return right root route row sample schema script search "
    "secret section select send server service session set size sort source start state static status step stop store stream string style sub system table tag target task temp test text the this time title token "
    "total true type unit update url user util value version view wait web width window word work write xxxx your"
).split()
#: The commonest pairs of letters in words of European languages (fixed values).
PAIRS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur".split()
CLASSES = "aB1-"
TRANSITIONS = tuple(f"from_{i}_to_{j}" for i in range(4) for j in range(4) if i != j)
FEATURES = ("length", *TRANSITIONS, "pairs", "classes", "digits", "uppers", "hex", "distinct", "covered", "placeholder", "path", "named", "against", "assigned", "given", "provider")
TREES, DEPTH, SEED, CUT = 40, 8, 11, 0.5
#: Labelled findings made for each form.
FINDINGS = 150


def features(value: Column, before: Column, after: Column, path: Column) -> dict[str, Column]:
    n = F.greatest(F.length(value), F.lit(1)).cast("double")
    kinds = F.regexp_replace(F.translate(F.translate(value, "bcdefghijklmnopqrstuvwxyz", "a" * 25), "ACDEFGHIJKLMNOPQRSTUVWXYZ", "B" * 25), "[^aB0-9]", "-")
    kinds = F.translate(kinds, "023456789", "1" * 9)
    share = lambda p: F.length(F.regexp_replace(value, p, "")) / n
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    low = F.lower(value)
    moves = {f"from_{i}_to_{j}": F.regexp_count(kinds, F.lit(f"{x}(?={y})")) / n for i, x in enumerate(CLASSES) for j, y in enumerate(CLASSES) if i != j}
    return {
        "length": F.least(n, F.lit(200.0)),
        **moves,
        "pairs": F.regexp_count(low, F.lit(f"(?={'|'.join(PAIRS)})")) / n,
        "classes": F.size(F.array_distinct(F.split(kinds, ""))).cast("double"),
        "digits": share("[^0-9]"),
        "uppers": share("[^A-Z]"),
        "hex": flag(value.rlike(r"^[0-9a-f]+\z")),
        "distinct": F.size(F.array_distinct(F.split(F.left(low, F.lit(400)), ""))) / F.least(n, F.lit(400.0)),
        "covered": 1 - F.length(F.regexp_replace(low, "|".join(sorted(WORDS, key=lambda w: (-len(w), w))), "")) / n,
        "placeholder": flag(low.rlike(r"example|sample|dummy|xxxx|placeholder|changeme|your|test|12345|(.)\1{5}")),
        "path": flag(value.rlike(r"/[a-z]+/|\.[a-z]{2,4}\z") | after.rlike(r"^\.[a-z]") | F.coalesce(path.rlike(r"(?i)test|example|fixture|sample|doc"), F.lit(False))),
        "named": flag(before.rlike(NAMED)),
        "against": flag(before.rlike(r"(?i)\b(?:commit|sha1?|sha256|md5|checksum|digest|uuid|guid|etag|revision|build|version|id|hash|order|card|isbn|serial)\W*\z")),
        "assigned": flag(before.rlike(r"[=:]\x20{0,2}[\"']?\z")),
        "given": flag(before.rlike(r"(?i)\b(?:bearer|basic)\x20\z|://[^\s/:@]{1,32}:\z")),
        "provider": flag(value.rlike(r"^(?:AKIA|ASIA)[0-9A-Z]{16}\z|^gh[pousr]_[A-Za-z0-9]{30,}\z|^xox[abprs]-|^sk_(?:live|test)_|^AIza|^eyJ[A-Za-z0-9_-]{10,}")),
    }


def labelled(spark: SparkSession, each: int = FINDINGS, start: int = 0) -> DataFrame:
    """Labelled findings (value, before, after, path, label): ``each`` rows of every form, by rule, numbered from ``start``."""
    i = F.col("id")
    pick = lambda *xs, s=0: F.element_at(F.array(*map(F.lit, xs)), (F.pmod(F.xxhash64(i, F.lit(s)), F.lit(len(xs))) + 1).cast("int"))
    hexes = lambda s: F.sha2(F.concat(F.lit(s), i.cast("string")), 256)
    base64 = lambda s: F.base64(F.unhex(hexes(s)))
    letters = lambda s: F.regexp_replace(base64(s), "[^A-Za-z0-9]", "x")
    upper = lambda s: F.translate(F.upper(letters(s)), "0189", "ABCD")
    name = pick("password", "passwd", "secret", "token", "api_key", "auth_token", "client_secret", "access_key", "client_secret_v2", "db_password_1", s=1)
    sign = pick("=", " = ", ": ", "=\"", " = \"", ": '", s=2)
    word = lambda s: pick("user", "table", "config", "request", "value", "index", "module", "session", "buffer", "message", s=s)
    n = lambda s, top: F.pmod(F.xxhash64(i, F.lit(s)), F.lit(top)).cast("string")
    prose = pick("the value of ", "and then ", "in ", "see ", "from ", "oft ", "que ", "der ", s=3)
    no = pick("src/main", "app", "conf", "src7", "src0", "", s=4)
    forms = [
        (1, F.concat(F.lit("AKIA"), F.substring(upper("a"), 1, 16)), pick("key ", "", "aws_access_key_id = ", "id: ", "then ", s=5), no),
        (1, F.concat(pick("ghp_", "gho_", "ghs_", s=6), F.substring(letters("b"), 1, 36)), pick("token ", "", "Authorization: ", s=7), no),
        (1, F.concat(pick("xoxb-", "xoxp-", s=8), n(9, 10**12), F.lit("-"), F.substring(letters("c"), 1, 24)), prose, no),
        (1, F.substring(hexes("d"), 1, 18), F.concat(prose, name, sign), no),
        (1, F.substring(hexes("e"), 1, 32), F.concat(prose, name, sign), no),
        (1, F.substring(hexes("f"), 1, 40), F.concat(prose, name, sign), no),
        (1, base64("g"), F.concat(name, sign), no),
        (1, F.substring(letters("h"), 1, 20), F.concat(name, sign), no),
        (1, F.substring(letters("k"), 1, 12), F.concat(name, sign), no),
        (1, F.substring(hexes("q"), 1, 20), pick("Authorization: Bearer ", "curl -H 'Authorization: Bearer ", "header bearer ", s=35), no),
        (1, F.substring(letters("r"), 1, 40), pick("Authorization: Bearer ", "Authorization: Basic ", s=36), no),
        (1, F.substring(letters("t"), 1, 12), F.concat(pick("postgres://", "https://", "mysql://", s=37), word(38), F.lit(":")), no),
        (0, word(39), F.concat(pick("postgres://", "https://", s=40), word(41), F.lit(":")), pick("tests/data", "docs/example", "", s=42)),
        (0, F.concat(word(43), F.lit("_"), n(44, 100)), F.concat(prose, pick("basic ", "Basic ", s=45)), no),
        (0, F.substring(hexes("l"), 1, 40), F.concat(prose, pick("commit ", "sha1 ", "revision ", "sha: ", s=10)), no),
        (0, F.substring(hexes("m"), 1, 32), pick("md5 ", "md5: ", "checksum=", "etag: ", s=11), no),
        (0, hexes("n"), pick("sha256 ", "sha256:", "digest: ", s=12), no),
        (0, F.regexp_replace(F.substring(hexes("o"), 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), pick("id: ", "uuid=", "", "request ", s=13), no),
        (0, F.regexp_replace(F.translate(hexes("p"), "abcdef", "123456"), "^(.{16}).*$", "$1"), prose, no),
        (0, F.concat(word(14), F.lit("_"), word(15), F.lit("_"), n(16, 100)), prose, no),
        (0, F.concat(word(17), F.lit("/"), word(18), F.lit("/"), word(19), n(20, 10)), prose, no),
        (0, F.concat(F.lit("your-"), word(21), F.lit("-here"), n(22, 10)), F.concat(name, sign), no),
        (0, F.concat(F.upper(word(23)), F.lit("_EXAMPLE_"), n(24, 1000)), F.concat(name, sign), pick("tests/data", "docs/example", "", s=25)),
        (0, F.concat(F.lit("xxxxxxxxxxxx"), n(26, 10)), F.concat(name, sign), no),
        (0, F.concat(F.lit("20"), F.lpad(n(27, 100), 2, "0"), F.lit("-01-"), F.lpad(n(28, 28), 2, "0"), F.lit("T10-30-00")), prose, no),
        (0, F.concat(word(29), word(30), n(31, 10), word(32)), prose, no),
        (0, F.concat(word(33), F.lit("_"), word(34)), F.concat(name, sign), no),
    ]
    rows = spark.range(start, start + each, 1, 1)
    out = None
    for label, value, before, path in forms:
        # what follows the password of a URL is its host
        after = F.when(before.rlike("://"), "@db.internal/x").otherwise(" and")
        part = rows.select(value.alias("value"), before.alias("before"), after.alias("after"), path.alias("path"), F.lit(float(label)).alias("label"))
        out = part if out is None else out.unionByName(part)
    return out


def train(findings: DataFrame) -> RandomForestClassificationModel:
    """The forest of labelled findings (value, before, after, path, label); without both labels there is none to train."""
    rows = findings.filter(F.col("value").isNotNull() & F.col("label").isin(0.0, 1.0))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    # one partition: the same sample for each tree, whatever the cluster
    rows = rows.select(F.col("label").cast("double").alias("label"), *[v.alias(k) for k, v in features(F.col("value"), text("before"), text("after"), text("path")).items()]).coalesce(1)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(rows.select("label", "features"))


def scan(docs: DataFrame, model: RandomForestClassificationModel, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Every candidate of every whole text with its score.

    Returns (key, start, end, rule, value_sha256, score, secret): places are
    code points, end exclusive; the value itself isn't repeated.  Null text is
    empty; rows without candidates give none; repeated rows give theirs each;
    null keys stay; of other columns only ``path`` is read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(SPAN)
    named = F.coalesce(F.when(body.rlike(NAMED) | body.rlike(GIVEN), found(body, ASSIGNED)), none)
    tokens = F.coalesce(F.when(body.rlike("[0-9]"), found(body, TOKEN)), none)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(path).cast("string") if path else F.lit(""), F.lit("")).alias("path"), named.alias("named"), tokens.alias("tokens"))
    # a token that overlaps an assigned value is the same candidate
    alone = F.when(F.size("named") > 0, F.filter("tokens", lambda t: ~overlaps(F.col("named"), t["start"], t["end"]))).otherwise(F.col("tokens"))
    mark = lambda a, r: F.transform(a, lambda x: F.struct(F.lit(r).alias("rule"), x["m"].alias("value"), x["before"].alias("before"), x["after"].alias("after"), x["start"].alias("start"), x["end"].alias("end")))
    rows = rows.select("doc_id", "path", F.explode(F.concat(mark(F.col("named"), "assigned"), mark(alone, "token"))).alias("c")).select("doc_id", "path", "c.*")
    rows = written(rows, "candidates")
    rows = rows.select("doc_id", "start", "end", "rule", F.sha2("value", 256).alias("value_sha256"), *[v.alias(k) for k, v in features(F.col("value"), F.col("before"), F.col("after"), F.col("path")).items()])
    rows = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))
    out = rows.withColumn("score", vector_to_array("probability")[1]).withColumn("secret", F.col("score") >= CUT)
    return out.select(F.col("doc_id").alias(key), "start", "end", "rule", "value_sha256", "score", "secret")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidates in all documents, scored."""
    return finished(lambda: scan(load(spark, sf_dir, "documents"), train(labelled(spark)), path="source"), "secrets")
