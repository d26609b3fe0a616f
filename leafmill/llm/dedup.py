"""Near-duplicate classes by ProbMinHash, banding and verification.

A document is the weighted set of its runs of five words; a run that occurs n
times weighs 1 + ln n.  Two documents are linked if their probability Jaccard
similarity

    J(x, y) = sum over common i of 1 / sum over j of max(x_j / x_i, y_j / y_i)

is 0.8 or more (for sets this is the plain Jaccard similarity), or their texts
are equal.  Classes are the connected components of the links.

Every run sends a Poisson process of arrivals, with its weight as the rate, to
random registers; a register keeps the run that came first, so that two
documents agree in a register with probability J.  Arrivals end once none can
be early enough.  Bands of registers become bucket keys.  A bucket isn't
expanded into pairs: its members are compared with representatives, first with
the one that meets the most texts over all bands, then, where that left them
apart, with two others, which differ from band to band.  Where classes still
meet in a bucket, its members get long sketches of one bit for each of many
more registers.  Every two members of different classes are held against each
other by these bits, in blocks inside of tasks, and only pairs whose estimate
isn't far below the threshold become rows and are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import checked, finished, join_counted, load, written
from leafmill.llm.hashing import U, blocks, mix, shingles, word_hashes

WORDS, THRESHOLD = 5, 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8 ** ROWS) ** BANDS, about 1 in 150,000.
BANDS, ROWS = 30, 5
#: Bits of a long sketch. The estimate of a pair at the threshold 0.8 strays by 0.0133; it has to be DEVIATIONS as much too low to be passed over, as in 1 of 3 million cases.
BITS, DEVIATIONS = 2048, 5.0
#: Members of a bucket that meet in one task (twice as many where two blocks meet).
MEMBERS_PER_BLOCK = 4096
#: Texts that one task gives long sketches.
TEXTS_PER_TASK = 500


def weighted(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, run's hash, weight) of the distinct runs, ordered by both."""
    h, doc, _ = shingles(*word_hashes(texts)[:2], words)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    if not len(h):
        return doc, h, np.zeros(0)
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate([at, [len(h)]]))
    return doc[at], h[at], 1 + np.log(count)


def probminhash(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, docs: int, m: int) -> np.ndarray:
    """(docs, m) winners' hashes; zeros for a document without runs."""
    best = np.full(docs * m, np.inf)
    who = np.zeros(docs * m, U)
    x, live, step = np.zeros(len(h)), np.arange(len(h)), 0
    d, e, w = doc, h, weight
    while len(live):
        step += 1
        # with many registers the latest one is looked up now and then
        look = step % max(1, step // 8) == 0
        z = mix(e + U(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        x = x - np.log(((mix(z) >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / w
        slot = d * m + ((z >> U(32)) * U(m) >> U(32)).astype(np.int64)
        early = x < best[slot]
        at = slot[early]
        np.minimum.at(best, at, x[early])
        won = best[at] == x[early]
        who[at[won]] = e[early][won]
        if look:
            last = best.reshape(docs, m).max(axis=1)
            go = x < last[d]
            live, x, d, e, w = live[go], x[go], d[go], e[go], w[go]
    return who.reshape(docs, m)


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(docs, bands) 64-bit keys."""
    r = registers.reshape(len(registers), bands, rows)
    key = np.tile(mix(np.arange(1, bands + 1, dtype=U)), (len(r), 1))
    for i in range(rows):
        key = mix(key ^ r[:, :, i])
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two weighted sets, each (sorted hashes, weights)."""
    keys = np.union1d(a[0], b[0])
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a[0])] = a[1]
    y[np.searchsorted(keys, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    both = (x > 0) & (y > 0)
    if not both.any():
        return 0.0
    # below a ratio x decides the maximum, above it y does
    split = np.searchsorted(ratio, ratio[both], side="right")
    low, high = np.concatenate([[0.0], np.cumsum(x)]), np.concatenate([np.cumsum(y[::-1])[::-1], [0.0]])
    return float((1 / (low[split] / x[both] + high[split] / y[both])).sum())


def sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(fp, bands) for each row of ``docs`` (fp, text); no bands for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = bands * rows
        for batch in batches:
            out = np.zeros((batch.num_rows, bands), np.int64)
            some = np.zeros(batch.num_rows, bool)
            for at, texts in blocks(batch.column(1)):
                doc, h, w = weighted(texts, words)
                out[at : at + len(texts)] = band_keys(probminhash(doc, h, w, len(texts), m), bands, rows)
                some[at + np.unique(doc)] = True
            flat = pa.array(out[some].ravel())
            ends = np.concatenate([[0], np.cumsum(some * bands)]).astype("i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], ["fp", "bands"])

    return docs.mapInArrow(run, "fp binary, bands array<long>")


def long_sketches(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """(fp, sketch) for each row of ``docs`` (fp, text): one bit of the winner of each of ``bits`` registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, texts in blocks(batch.column(1), 1 << 17):
                for at in range(0, len(texts), 64):
                    part = texts[at : at + 64]
                    doc, h, w = weighted(part, words)
                    won = mix(probminhash(doc, h, w, len(part), bits)) & U(1)
                    out += [x.tobytes() for x in np.packbits(won.astype(np.uint8), axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["fp", "sketch"])

    return docs.mapInArrow(run, "fp binary, sketch binary")


def least_agreement(threshold: float, bits: int, deviations: float) -> int:
    """Bits in which two long sketches have to agree: half of the registers that differ agree by chance."""
    p = (1 + threshold) / 2
    return int(bits * p - deviations * np.sqrt(bits * p * (1 - p)))


def close_pairs(members: DataFrame, threshold: float, bits: int) -> DataFrame:
    """Pairs (a < b) of members of one bucket, of different classes, whose long sketches agree enough.

    ``members``: (key, n, fp, root, sketch, bands), n being the bucket's size.
    Every two blocks of a bucket meet in a task of their own.  A pair that
    shares several buckets is given by that of the first band.
    """
    most = bits - least_agreement(threshold, bits, DEVIATIONS)
    cut = F.ceil(F.col("n") / MEMBERS_PER_BLOCK)
    dealt = members.withColumn("part", F.pmod(F.xxhash64("fp"), cut)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), cut - 1)))
    dealt = dealt.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "fp", "root", "sketch", "bands")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, i, j = (k.as_py() for k in key)
        fps, names = table["fp"].to_pylist(), {}
        root = np.array([names.setdefault(r, len(names)) for r in table["root"].to_pylist()])
        words = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(fps), -1)
        bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(fps), -1)
        part = np.array(table["part"].to_pylist())
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        step, found = max(1, (1 << 16) // max(1, len(right))), []
        for at in range(0, len(left), step):
            own = left[at : at + step]
            differ = np.zeros((len(own), len(right)), np.int32)
            for k in range(words.shape[1]):
                differ += np.bitwise_count(words[own, k][:, None] ^ words[right, k][None, :])
            near = (differ <= most) & (root[own][:, None] != root[right][None, :])
            if i == j:
                near &= own[:, None] < right[None, :]
            a, b = np.nonzero(near)
            a, b = own[a], right[b]
            # the first band that both share is this bucket's
            shared = bands[a] == bands[b]
            here = bands[a, shared.argmax(axis=1)] == bucket if len(a) else np.zeros(0, bool)
            found += [(min(fps[p], fps[q]), max(fps[p], fps[q])) for p, q in zip(a[here].tolist(), b[here].tolist(), strict=True)]
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return dealt.groupBy("key", "i", "j").applyInArrow(run, "a binary, b binary")


def verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose similarity is at least ``threshold``. ``texts``: (fp, text), one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, tuple] = {}
            keep = []
            for k, (b, s, t) in enumerate(zip(batch.column(1), batch.column(2), batch.column(3), strict=True)):
                b = b.as_py()
                if b not in held:
                    if len(held) > 64:
                        held.clear()
                    held[b] = weighted([(t.as_py() or "").encode("utf-8", "surrogatepass")], words)[1:]
                keep.append(similarity(weighted([(s.as_py() or "").encode("utf-8", "surrogatepass")], words)[1:], held[b]) >= threshold - 1e-9)
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    one = texts.select(F.col("fp").alias("a"), F.col("text").alias("s"))
    two = texts.select(F.col("fp").alias("b"), F.col("text").alias("t"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "s", "t").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(fp, root) for every node of the edges (a, b): the smallest fp of its connected component.

    Large and small stars in turn: every node hands the smallest of its
    neighbours to the larger ones, then to the smaller ones.  Rounds grow with
    the logarithm of the component, whatever the order of its ids; they end
    when every edge leads to a root.  Every round is a written table.
    """
    tree = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), f"{name}-edges")
    k = 0
    while True:
        k += 1
        both = tree.union(tree.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("n")).select("a", F.least("a", "n").alias("n"))
        large = written(both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("n").alias("b")).distinct(), f"{name}-large-{k}")
        low = large.groupBy("a").agg(F.min("b").alias("n"))
        small = large.join(low, "a").filter("b > n").select(F.col("b").alias("a"), F.col("n").alias("b")).union(low)
        tree = written(small.distinct(), f"{name}-small-{k}")
        roots = tree.select(F.col("b").alias("root")).distinct()
        if tree.join(roots, tree["a"] == roots["root"], "left_semi").isEmpty() and tree.groupBy("a").count().filter("count > 1").isEmpty():
            return tree.select(F.col("a").alias("fp"), F.col("b").alias("root")).union(roots.select("root", F.col("root").alias("b")))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, fp, root) for every row: md5 of its text, and the class, named by its smallest md5.

    Null text counts as empty.  Texts without words are linked only to equal
    ones; one of fewer than five words is a single run.  Words are runs of
    ASCII letters, digits and any further characters, in lower case.  Repeated
    rows, rows with a null key and an empty table are fine; other columns are
    not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    ids = docs.select(F.col(key).alias("doc_id"), F.unhex(F.md5(body)).alias("fp"), body.alias("text"))
    made = written(sketches(ids.select("fp", "text"), words, bands, rows), "sketches")
    # equal texts become one node before anything is exploded
    nodes = made.filter(F.size("bands") > 0).groupBy("fp").agg(F.first("bands").alias("bands"))
    keys = written(nodes.select("fp", F.explode("bands").alias("key")), "bands")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(keys.join(sizes, "key"), "shared")
    # who meets the most texts over all bands is nearest to the middle of its group, so that the others link to it
    degree = shared.groupBy("fp").agg(F.sum("n").alias("d"))
    shared = shared.join(degree, "fp")
    mine = F.xxhash64("fp", "key")
    heads = shared.groupBy("key").agg(F.max_by("fp", F.struct("d", "fp")).alias("r0"), F.min_by("fp", mine).alias("r1"), F.max_by("fp", mine).alias("r2"))
    met = written(shared.select("fp", "key").join(heads, "key"), "met")
    pair = lambda r: met.filter(F.col("fp") != F.col(r)).select(F.col("fp").alias("a"), F.col(r).alias("b"))
    first = written(pair("r0").distinct(), "pairs-0")
    held = written(first.select(F.col("a").alias("fp")).union(first.select("b")).distinct(), "held")
    texts = written(ids.select("fp", "text").join(checked(held), "fp", "left_semi").groupBy("fp").agg(F.first("text").alias("text")), "texts")
    links = written(verified(first, texts, words, threshold), "links-0")
    # what the first representatives have joined already needs no second look
    found = components(links, "class-0")
    other = pair("r1").union(pair("r2")).distinct()
    one, two = (found.select(F.col("fp").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab")
    other = other.join(one, "a", "left").join(two, "b", "left").filter("root_a is null or root_b is null or root_a != root_b").select("a", "b").join(first, ["a", "b"], "left_anti")
    other = written(other, "pairs-1")
    more = written(verified(other, texts, words, threshold), "links-1")
    if not more.isEmpty():
        found = components(links.union(more), "class-1")
    sorted_pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    seen = first.select(*sorted_pair).union(other.select(*sorted_pair))
    # where classes still meet, all that is left is told by long sketches
    rooted = met.select("fp", "key").join(found, "fp", "left").select("fp", "key", F.coalesce("root", "fp").alias("root"))
    parted = rooted.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi")
    left = written(rooted.join(parted.select("key", "n"), "key"), "left")
    apart = written(left.select("fp").distinct(), "apart")
    # long sketches take much time for few bytes: the rows are dealt out by their number
    doubtful = texts.join(apart, "fp", "left_semi").select("fp", "text").repartition(max(1, -(-apart.count() // TEXTS_PER_TASK)))
    sketched = written(long_sketches(doubtful, words, BITS).join(nodes, "fp"), "long")
    new = written(close_pairs(left.join(sketched, "fp"), threshold, BITS).join(seen, ["a", "b"], "left_anti"), "pairs-2")
    more = written(verified(new, texts, words, threshold), "links-2")
    if not more.isEmpty():
        found = components(found.select(F.col("fp").alias("a"), F.col("root").alias("b")).union(more), "class-2")
    return ids.select("doc_id", "fp").join(found, "fp", "left").select("doc_id", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, class_id, n_docs) per row: the smallest key and the number of rows of its class (null if it has no key)."""
    rows = written(classes(docs, key, text, **options), "classes")
    named = written(rows.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_docs")), "named")
    return join_counted(rows, named, "root", "n_docs").select(F.col("doc_id").alias(key), "class_id", "n_docs")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: that with the smallest key (null keys last), then the smallest text md5.

    All columns are kept.
    """
    rows = written(classes(docs, key, text, **options), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("fp"))
    kept = rows.groupBy("root").agg(F.min(order).alias("k"), F.count(F.lit(1)).alias("n"))
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    data = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    fp = F.unhex(F.md5(F.coalesce(F.col(names[text]), F.lit(""))))
    # classes of one row need no join by text: their keys tell them, if keys are unique
    many = written(kept.filter("n > 1"), "kept")
    gone = join_counted(rows, many, "root", "n").filter(~(F.col("doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("fp") == F.col("k.fp")))).select("doc_id", "fp").distinct()
    left = data.withColumn("_fp", fp).join(checked(written(gone, "gone")).select(F.col("doc_id").alias("_id"), F.col("fp").alias("_gone")), F.col(names[key]).eqNullSafe(F.col("_id")) & (F.col("_fp") == F.col("_gone")), "left_anti")
    again = rows.groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("_id"), F.col("fp").alias("_gone"))
    if not again.isEmpty():
        again = written(again, "again")
        same = F.col(names[key]).eqNullSafe(F.col("_id")) & (F.col("_fp") == F.col("_gone"))
        once = left.join(again, same, "left_semi")
        firsts = [F.first(n).alias(n) for n in names.values() if n != names[key]]
        once = once.groupBy(names[key], "_fp").agg(*firsts).select(*names.values())
        left = left.join(again, same, "left_anti").select(*names.values()).union(once)
    return left.select(*[F.col(n).alias(c) for c, n in names.items()])


def op3_probminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return finished(lambda: near_duplicates(load(spark, sf_dir, "documents")), "near-duplicates")
