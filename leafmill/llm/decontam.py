"""Benchmark decontamination: BM25 over the test items with block-max WAND, then overlap checks.

Every passage (64 words, one every 32) of every document is a query against an
inverted index of the test items.  An item's scores are divided by the least
it needs: a share of what its own weakest run of 32 words (or all of it, if
shorter) would score; so one threshold, 1, serves all items, and all that
reach it are retrieved.  Terms and blocks of postings carry their largest
scores; passages, and then items, that can't reach the threshold are skipped
without being scored.  A retrieved item counts as a leak if enough of the
word runs of its question and of its answer (its last sentence) lie in and
around the passage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import finished, load, written
from leafmill.llm.hashing import U, blocks, shingles, word_hashes

PASSAGE, STRIDE = 64, 32
K1, B, SHARE = 1.2, 0.5, 0.6
#: Shares of the word runs of a question and of an answer that a leak holds, and the length of these runs.
QUESTION, ANSWER, RUN = 0.6, 0.5, 3
#: Groups of items (of six, at least) with largest scores of their own, which rule out passages.
GROUPS = 64
#: Postings per block, and bytes of test items that are indexed and broadcast at once.
BLOCK, INDEX_BYTES = 64, 16 << 20


def parts(text: str) -> tuple[str, str]:
    """Question and answer: all but the last sentence, and the last; a single sentence is a question."""
    found = re.findall(r"[^.!?\n]+[.!?\n]*", text)
    found = [s for s in found if re.search(r"\w", s)]
    return ("".join(found[:-1]), found[-1]) if len(found) > 1 else (text, "")


@dataclass
class Part:
    """A question's or an answer's words and distinct word runs, as hashes."""

    words: np.ndarray
    runs: np.ndarray

    @classmethod
    def of(cls, text: str) -> Part:
        h, doc, *_ = word_hashes([text.encode("utf-8", "surrogatepass")])
        return cls(h, np.unique(shingles(h, doc, RUN)[0]))


@dataclass
class Index:
    """terms: sorted word hashes; most: a term's largest score; groups: the same for each group of items; lists: (items, scores, last item and largest score of each block); question, answer: of each item; words: its length."""

    ids: list
    terms: np.ndarray
    most: np.ndarray
    groups: np.ndarray
    lists: list[tuple[list[int], list[float], list[int], list[float]]]
    question: list[Part]
    answer: list[Part]
    words: list[int]


def build(items: list[tuple[object, str]]) -> Index:
    """The index of (id, text) pairs; items without words are left out."""
    hashed = [(i, t, word_hashes([t.encode("utf-8", "surrogatepass")])[0].tolist()) for i, t in items]
    hashed = [x for x in hashed if x[2]]
    n = len(hashed)
    df = Counter(w for _, _, ws in hashed for w in set(ws))
    mean = sum(len(ws) for _, _, ws in hashed) / n if n else 1.0
    idf = {w: max(np.log((n - c + 0.5) / (c + 0.5)), 0.1) for w, c in df.items()}
    postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
    for k, (_, _, ws) in enumerate(hashed):
        tf = Counter(ws)
        own = {w: idf[w] * c * (K1 + 1) / (c + K1 * (1 - B + B * len(ws) / mean)) for w, c in tf.items()}
        need = SHARE * min(sum(own[w] for w in set(ws[a : a + STRIDE])) for a in range(max(1, len(ws) - STRIDE + 1)))
        for w, v in own.items():
            postings[w].append((k, v / need))
    terms = np.array(sorted(postings), U)
    lists = []
    for t in terms.tolist():
        p = postings[t]
        cut = [p[a : a + BLOCK] for a in range(0, len(p), BLOCK)]
        lists.append(([k for k, _ in p], [v for _, v in p], [c[-1][0] for c in cut], [max(v for _, v in c) for c in cut]))
    size = max(6, -(-n // GROUPS))
    groups = np.zeros((len(terms), max(1, -(-n // size))), np.float32)
    for t, (ks, vs, _, _) in enumerate(lists):
        np.maximum.at(groups[t], np.array(ks) // size, np.array(vs, np.float32))
    halves = [parts(t) for _, t, _ in hashed]
    return Index([i for i, _, _ in hashed], terms, np.array([max(x[3]) for x in lists]), groups, lists, [Part.of(q) for q, _ in halves], [Part.of(a) for _, a in halves], [len(ws) for _, _, ws in hashed])


def wand(index: Index, terms: list[int], threshold: float = 1.0) -> list[tuple[int, float]]:
    """All (item, score) whose score over the terms reaches the threshold, by block-max WAND."""
    out = []
    eps = threshold - 1e-9
    lists = [index.lists[t] for t in terms]
    most = [float(index.most[t]) for t in terms]
    at = [0] * len(lists)
    live = sorted(range(len(lists)), key=lambda i: lists[i][0][0])
    while live:
        total, pivot = 0.0, -1
        for k, i in enumerate(live):
            total += most[i]
            if total >= eps:
                pivot = k
                break
        if pivot < 0:
            break
        doc = lists[live[pivot]][0][at[live[pivot]]]
        while pivot + 1 < len(live) and lists[live[pivot + 1]][0][at[live[pivot + 1]]] == doc:
            pivot += 1
        # the blocks that would hold the pivot item bound its score more closely
        bound, reach = 0.0, None
        for i in live[: pivot + 1]:
            b = bisect_left(lists[i][2], doc)
            if b < len(lists[i][2]):
                bound += lists[i][3][b]
                reach = lists[i][2][b] if reach is None else min(reach, lists[i][2][b])
        if bound >= eps:
            if lists[live[0]][0][at[live[0]]] == doc:
                score = sum(lists[i][1][at[i]] for i in live[: pivot + 1])
                if score >= eps:
                    out.append((doc, score))
                goal = doc + 1
            else:
                goal = doc
        else:
            goal = (reach if reach is not None else doc) + 1
            if pivot + 1 < len(live):
                goal = min(goal, lists[live[pivot + 1]][0][at[live[pivot + 1]]])
            goal = max(goal, doc + 1)
        for i in live[: pivot + 1]:
            at[i] = bisect_left(lists[i][0], goal, at[i])
        live = sorted((i for i in live if at[i] < len(lists[i][0])), key=lambda i: lists[i][0][at[i]])
    return out


def leaks(index: Index, texts: list[bytes]) -> Iterator[tuple[int, int, float, float, float, int, int]]:
    """(text number, item number, score, question overlap, answer overlap, start byte, end byte) of every leak in the texts."""
    h, doc, start, end = word_hashes(texts)
    if not len(h) or not len(index.terms):
        return
    place = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
    hit = np.flatnonzero(index.terms[place] == h)
    if not len(hit):
        return
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    term, d = place[hit], doc[hit]
    pos = hit - first[d]
    # place of the same term's last occurrence in the same text
    order = np.lexsort((pos, term, d))
    prev = np.full(len(hit), -1)
    same = (term[order][1:] == term[order][:-1]) & (d[order][1:] == d[order][:-1])
    prev[order[1:][same]] = pos[order[:-1][same]]
    # passages are numbered through all texts; a word lies in that which starts at the stride before it and in the one before that
    count = np.maximum(1, -(-np.diff(first) // STRIDE))
    base = np.concatenate([[0], np.cumsum(count)])
    bound = np.zeros((base[-1], index.groups.shape[1]), np.float32)
    for back in range(PASSAGE // STRIDE):
        p = pos // STRIDE - back
        new = np.flatnonzero((p >= 0) & (prev < p * STRIDE))
        if len(new):
            passage = base[d[new]] + p[new]
            cut = np.flatnonzero(np.diff(passage, prepend=-1))
            bound[passage[cut]] += np.add.reduceat(index.groups[term[new]], cut, axis=0)
    grams, gdoc, gpos = shingles(h, doc, RUN)
    found: dict[tuple[int, int], tuple] = {}
    for p in np.flatnonzero(bound.max(axis=1) >= 1 - 1e-4):
        i = int(np.searchsorted(base, p, side="right") - 1)
        s = int(p - base[i]) * STRIDE
        lo, hi = np.searchsorted(hit, [first[i] + s, min(first[i] + s + PASSAGE, first[i + 1])])
        for k, score in wand(index, np.unique(term[lo:hi]).tolist()):
            lo, hi = max(0, s - index.words[k]), s + PASSAGE + index.words[k]
            a, b = np.searchsorted(gdoc, [i, i + 1])
            g = slice(a + np.searchsorted(gpos[a:b], lo), a + np.searchsorted(gpos[a:b], hi))
            near, words = grams[g], h[first[i] + lo : min(first[i] + hi, first[i + 1])]
            q, w = overlap(index.question[k], near, words), overlap(index.answer[k], near, words)
            if q is not None and q >= QUESTION and (w is None or w >= ANSWER):
                where = gpos[g][np.isin(near, np.concatenate([index.question[k].runs, index.answer[k].runs]))]
                x = first[i] + (where.min() if len(where) else s)
                y = min(first[i] + (where.max() + RUN if len(where) else s + PASSAGE), first[i + 1]) - 1
                if (i, k) not in found or found[i, k][0] < score:
                    found[i, k] = (score, q, 1.0 if w is None else w, int(start[x]), int(end[y]))
    for (i, k), x in sorted(found.items()):
        yield (i, k, *x)


def overlap(part: Part, near: np.ndarray, words: np.ndarray) -> float | None:
    """Share of a part's word runs among those nearby; a part shorter than a run must occur as it is; None for no words."""
    if len(part.words) >= RUN:
        return float(np.isin(part.runs, near).mean())
    if not len(part.words):
        return None
    n = len(words) - len(part.words) + 1
    return float(n > 0 and np.logical_and.reduce([words[i : i + n] == w for i, w in enumerate(part.words)]).any())


def scan(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and test item that it leaks.

    Returns (key, item_id, score, question_overlap, answer_overlap,
    start, end): score 1 is the retrieval threshold; start and end are code
    points of the first and after the last shared word run of the best passage.
    Null texts are empty; texts and items without words leak nothing; repeated
    rows and items count each; null keys stay; other columns are not read.
    The test items are indexed and broadcast in blocks of a bounded number of
    bytes (an item above it is a block of its own), one after the other.
    """
    tests = benchmark.select(F.col(item).alias("item_id"), F.col(item_text).alias("text")).filter(F.col("text").isNotNull())
    size = tests.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    n = -(-size // INDEX_BYTES) or 1
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kinds = [rows.schema["doc_id"].dataType.simpleString(), tests.schema["item_id"].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, question_overlap double, answer_overlap double, start long, end long"
    out = None
    for k in range(n):
        own = tests.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        index = build([tuple(r) for r in own.orderBy("item_id", "text").collect()])
        sent = docs.sparkSession.sparkContext.broadcast(index)
        part = rows.mapInArrow(_scanner(sent), schema)
        if n > 1:
            # one index at a time, on the driver as in the workers
            part = written(part, f"leaks-{k}")
            sent.destroy()
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("doc_id", key) if key != "doc_id" else out


def _scanner(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            take, cols = [], [[] for _ in range(6)]
            for at, texts in blocks(batch.column(1)):
                for i, k, score, q, a, s, e in leaks(index, texts):
                    take.append(at + i)
                    lead = texts[i][:s].decode("utf-8", "surrogatepass")
                    start = len(lead)
                    for c, x in zip(cols, (index.ids[k], score, q, a, start, start + len(texts[i][s:e].decode("utf-8", "surrogatepass"))), strict=True):
                        c.append(x)
            if take:
                kinds = [None, pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take)), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "start", "end"])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that leak a test item; all columns and all other rows are kept.

    The leak is decided where the row is, so rows need no key.
    """
    tests = benchmark.select(F.col("item_id"), F.col("text")).filter(F.col("text").isNotNull())
    size = tests.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    n = -(-size // INDEX_BYTES) or 1
    out = docs
    for k in range(n):
        own = tests.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        sent = docs.sparkSession.sparkContext.broadcast(build([tuple(r) for r in own.orderBy("item_id", "text").collect()]))
        out = out.mapInArrow(_cleaner(sent, docs.columns.index(text)), docs.schema)
        if n > 1:
            out = written(out, f"clean-{k}")
            sent.destroy()
    return out


def _cleaner(sent, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for at, texts in blocks(batch.column(column)):
                for i, *_ in leaks(sent.value, texts):
                    keep[at + i] = False
            yield batch.filter(pa.array(keep))

    return run


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak of a benchmark item in any document."""
    return finished(lambda: scan(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")), "leaks")
