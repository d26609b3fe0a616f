"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

An n-gram's presence in a text counts as its log ratio of smoothed document
frequencies in toxic and other training texts; a logistic regression is
trained on the scaled features.  N-grams are hashed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafmill.llm.common import finished, load, remainder, written

#: The bounded sample the classifier is fitted on: whole labelled documents with the smallest hashes of their ids, so many and with so many bytes at most.
TRAIN_ROWS, TRAIN_BYTES = 8_000, 64 << 20
#: Lengths of the n-grams, bits of their hashes, and how many the classifier may use.
LENGTHS, BITS, FEATURES = (3, 4, 5), 20, 2_000
THRESHOLD = 0.3
_CHUNK = 1 << 18


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of the whole lower-case text, with a blank at both ends, in bounded blocks (order and repeats kept)."""
    c = np.frombuffer(" ".join(["", *text.lower().split(), ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, max(len(c), 1), _CHUNK):
        part = c[at : at + _CHUNK + max(LENGTHS) - 1]
        for n in LENGTHS:
            stop = min(_CHUNK, len(part) - n + 1)
            if stop <= 0:
                continue
            h = np.full(stop, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for i in range(n):
                h = (h ^ part[i : i + stop]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            yield h >> np.uint32(32 - BITS)


def present(text: str, table: np.ndarray) -> np.ndarray:
    """The distinct features of a text; ``table`` gives each hash its feature (0: none)."""
    found = [np.unique(f[f > 0]) for f in (table[h] for h in ngrams(text))]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, table.dtype)


def fit(texts: list[str], toxic: np.ndarray, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray, float]:
    """Hashes used, their weights (log ratio times coefficient) and the bias."""
    n = np.array([(toxic == 0).sum(), (toxic == 1).sum()], np.float32)
    if not n.all():
        return np.zeros(0, np.int64), np.zeros(0), float(np.log((n[1] + 1) / (n[0] + 1))) if n.any() else -np.inf
    df = np.zeros((2, 1 << BITS), np.float32)
    seen = np.zeros(1 << BITS, bool)
    for t, y in zip(texts, toxic, strict=True):
        for h in ngrams(t):
            seen[h] = True
        at = np.flatnonzero(seen)
        df[int(y), at] += 1
        seen[at] = False
    # log ratio of the shares of texts that hold the n-gram, and its standard error
    ratio = np.log((df[1] + 1) / (n[1] + 2)) - np.log((df[0] + 1) / (n[0] + 2))
    z = ratio / np.sqrt(1 / (df[1] + 1) + 1 / (df[0] + 1))
    order = np.argsort(-np.abs(z), kind="stable")[:features]
    used = np.sort(order[(df[:, order].sum(axis=0) > 0) & (np.abs(z[order]) > 1)])
    table = np.zeros(1 << BITS, np.int32)
    table[used] = np.arange(1, len(used) + 1)
    # the few features that a text has, as (row, column) pairs
    cols = [present(t, table) - 1 for t in texts]
    row, col = np.repeat(np.arange(len(texts)), [len(f) for f in cols]), np.concatenate(cols)
    scale = ratio[used]
    x = scale[col]
    y = toxic.astype(np.float32)
    w, b, penalty = np.zeros(len(used)), float(np.log(n[1] / n[0])), 1.0 / len(texts)
    vw, vb, gw, gb = 0.0, 0.0, np.zeros_like(w), 0.0
    for step in range(1, 401):  # Adam on the whole sample
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, x * w[col], len(texts)) + b, -30, 30)))
        e = (p - y) / len(y)
        dw, db = np.bincount(col, x * e[row], len(used)) + penalty * w, float(e.sum())
        gw, gb = 0.9 * gw + 0.1 * dw, 0.9 * gb + 0.1 * db
        vw, vb = 0.99 * vw + 0.01 * dw * dw, 0.99 * vb + 0.01 * db * db
        c1, c2 = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.05 * (gw / c1) / (np.sqrt(vw / c2) + 1e-8)
        b -= 0.05 * (gb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return used, (w * scale).astype(np.float64), float(b)


@dataclass(frozen=True)
class Classifier:
    """A fitted classifier: a table from hash to feature, the features' weights (first: none), the bias."""

    table: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        v = self.bias + self.weights[present(text or "", self.table)].sum()
        return float(1 / (1 + np.exp(-np.clip(v, -500, 500))))


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> Classifier:
    """Fit on at most ``rows`` labelled documents of ``size`` bytes (those with the smallest hash of the id) that satisfy ``usable``.

    Null ids and labels are left out; repeated labels of an id count as toxic
    if any does; of repeated documents of an id one text is used; null text is
    empty.  Without both classes the score is their smoothed share, and 0
    (next to nothing) without any label.
    """
    own = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("y")).filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    if usable is not None:
        own = own.filter(usable)
    own = own.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most ``rows`` pairs of numbers: bounded, whatever the input
    have = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(own), "doc_id")
    have = written(have.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")), "labelled")
    # at most ``rows`` sums of lengths
    before = F.sum("n").over(W.orderBy(F.xxhash64("doc_id"), "doc_id"))
    first = have.select("doc_id", F.octet_length("text").cast("long").alias("n")).withColumn("n", before).filter(F.col("n") <= size)
    have = have.join(F.broadcast(first.select("doc_id")), "doc_id")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        used, w, b = fit(pdf["text"].tolist(), pdf["y"].to_numpy())
        return pd.DataFrame({"hash": [*used, -1], "weight": [*w, b]})

    # one task fits; it gets the bounded sample only
    found = have.groupBy(F.lit(0).alias("one")).applyInPandas(lambda pdf: run(pdf.drop(columns="one", errors="ignore")), "hash long, weight double").toPandas()
    table = np.zeros(1 << BITS, np.int16 if FEATURES < 1 << 15 else np.int32)
    model = found[found["hash"] >= 0].sort_values("hash")
    table[model["hash"].to_numpy(np.int64)] = np.arange(1, len(model) + 1)
    bias = found.loc[found["hash"] < 0, "weight"]
    return Classifier(table, np.array([0.0, *model["weight"]]), float(bias.iloc[0]) if len(bias) else -np.inf)


def score(docs: DataFrame, model: Classifier, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that each whole text is toxic.

    Null and empty texts get the bias alone; every other column is kept as it
    is, and one that is called ``out`` gives way.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        for s in batches:
            yield pd.Series([m.score(t) for t in s], dtype="float64")

    return docs.withColumn(out, run(F.col(text)))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a classifier that has not seen the held-out fold (2 of 0 to 3)."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = finished(lambda: score(docs, train(docs, load(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)).drop("text"), "toxicity")
    return out.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
