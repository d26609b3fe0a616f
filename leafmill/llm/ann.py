"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product becomes smallest Euclidean distance by adding one
component: x -> (x / M, sqrt(1 - |x|^2 / M^2)), q -> (q / |q|, 0) with M the
largest norm.  Rows are hashed within ranges of norms that differ by a factor
of two at most, each with an M of its own, and queries probe every range; a
range in which a sample misses the recall is searched exactly, in blocks, and
so are queries for which too few rows were found.  A hash is ``floor((a . x + b) / w)`` with Gaussian ``a``; a table
joins several.  A query visits its own bucket and perturbed ones in order of
estimated success: each hash moved by -1 or +1 costs the squared distance from
the query to that side of its cell.  Candidates of all tables are ranked by
exact inner products of the original vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafmill.llm.common import finished, load, written

#: Rows and probing queries of one bucket that meet in one task.
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 4096, 1024
#: The bounded sample on which the number of probes is set: rows, and queries among them.
SAMPLE_ROWS, SAMPLE_QUERIES = 4096, 192
#: Ranges of norms; the last holds all smaller ones.
RANGES = 16


@dataclass(frozen=True)
class Hashes:
    """Hash tables: directions (tables, hashes, dims + 1), offsets (tables, hashes), cell width, largest norm, probes."""

    a: np.ndarray
    b: np.ndarray
    width: float
    norm: float
    probes: int

    def cells(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Real-valued cell positions (rows, tables, hashes)."""
        if query:
            full = np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))])
        else:
            y = x / self.norm
            full = np.hstack([y, np.sqrt(np.maximum(0.0, 1.0 - (y * y).sum(axis=1)))[:, None]])
        return np.einsum("nd,thd->nth", full, self.a) / self.width + self.b


def bucket_ids(cells: np.ndarray) -> np.ndarray:
    """One 64-bit id per row of integer cells."""
    h = np.zeros(cells.shape[:-1], np.uint64)
    for i in range(cells.shape[-1]):
        h = (h ^ (cells[..., i].astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def perturbations(place: np.ndarray, count: int) -> list[tuple[int, ...]]:
    """Up to ``count`` sets of moves (hash 2i down, 2i+1 up), most promising first, the empty set ahead of all."""
    cost = np.stack([place**2, (1 - place) ** 2], axis=1).ravel()
    order = np.argsort(cost, kind="stable")
    c = cost[order]
    out: list[tuple[int, ...]] = [()]
    heap = [(c[0], (0,))]
    while heap and len(out) < count:
        total, s = heapq.heappop(heap)
        moves = [int(order[i]) for i in s]
        if len({m // 2 for m in moves}) == len(moves):
            out.append(tuple(moves))
        last = s[-1]
        if last + 1 < len(c):
            heapq.heappush(heap, (total + c[last + 1], (*s, last + 1)))
            heapq.heappush(heap, (total - c[last] + c[last + 1], (*s[:-1], last + 1)))
    return out


def probe_ids(positions: np.ndarray, count: int) -> list[np.ndarray]:
    """Bucket ids to visit, in order, for each row of positions (rows, hashes) of one table."""
    base = np.floor(positions)
    out = []
    for row, place in zip(base, positions - base, strict=True):
        sets = perturbations(place, count)
        cells = np.repeat(row[None, :], len(sets), axis=0)
        for i, s in enumerate(sets):
            for m in s:
                cells[i, m // 2] += 1 if m % 2 else -1
        out.append(bucket_ids(cells))
    return out


def calibrated(sample: np.ndarray, asks: np.ndarray, rows: int, norm: float, k: int, tables: int, recall: float, seed: int) -> Hashes | None:
    """Hash tables whose number of probes reaches ``recall`` for ``asks`` on the sample of a range; None if none does.

    Neighbours within a sample are farther than those among all rows, so the
    sample's recall is the lower one.  Fewer hashes are tried where the probes
    of many aren't enough.
    """
    if len(sample) <= k + 1:
        return None
    q = asks[:SAMPLE_QUERIES]
    s = q @ sample.T
    # a query that is a row of the sample isn't its own neighbour
    s[(q[:, None, :1] == sample[None, :, :1])[:, :, 0] & (np.abs(s - (q * q).sum(axis=1)[:, None]) <= 1e-12 * (1 + np.abs(s)))] = -np.inf
    true = np.argpartition(-s, k, axis=1)[:, :k]
    most_hashes = max(6, int(np.log2(max(rows, 1) / 1024)) if rows > 1024 else 6)
    for hashes in range(most_hashes, 5, -1):
        rng = np.random.default_rng(seed)
        a = rng.standard_normal((tables, hashes, sample.shape[1] + 1))
        h = Hashes(a, rng.random((tables, hashes)), 1.0, norm, 1)
        spread = float(h.cells(sample, False).std(axis=0).mean()) or 1.0
        h = Hashes(a, h.b, 2.5 * spread, norm, 1)
        own = bucket_ids(np.floor(h.cells(sample, False)))
        at, most = h.cells(q, True), 3 ** min(hashes, 8)
        first = np.full((len(q), k), most, np.int64)
        for t in range(tables):
            for i, ids in enumerate(probe_ids(at[:, t], most)):
                rank = {b: r for r, b in reversed(list(enumerate(ids.tolist())))}
                first[i] = np.minimum(first[i], [rank.get(b, most) for b in own[true[i], t].tolist()])
        need = int(np.quantile(first, recall, method="higher")) + 1
        if need <= most:
            return Hashes(a, h.b, h.width, norm, need)
    return None


def _matrix(s: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in s]) if len(s) else np.zeros((0, 1))


def usable(vectors: DataFrame, key: str, vec: str) -> DataFrame:
    """(id, v): one row per id (the smallest vector where ids repeat) of finite, non-zero vectors of the commonest length."""
    v = F.col("v")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vec).alias("v")).filter(F.col("id").isNotNull() & v.isNotNull())
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    rows = rows.filter(F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["n"] if sizes else 0)).groupBy("id").agg(F.min("v").alias("v"))


def search(vectors: DataFrame, queries: DataFrame | None = None, k: int = 20, key: str = "vec_id", vec: str = "embedding", query: str = "id % 20 = 0", tables: int = 2, recall: float = 0.97, seed: int = 7) -> DataFrame:
    """The ``k`` rows with the largest inner product for each query row, other than itself.

    Queries are the usable rows that satisfy ``query`` (an expression over
    ``id``).  Returns (query_id, rank, vec_id, score), nearest first, ties to
    the smaller id.  Rows whose id or vector is null, whose vector is zero,
    holds null or non-finite components or has another length than most take
    no part; repeated ids count once; fewer other rows than ``k`` give fewer; empty
    tables give none; other columns are not read.  A query whose probed buckets
    hold fewer than ``k`` rows is searched exactly, in blocks.  Buckets with
    many rows or queries are dealt over blocks, so no hot bucket meets in one task.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, key, vec), "vectors")
    out_schema = "query_id long, rank int, vec_id long, score double"
    size = F.sqrt(F.aggregate("v", F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double")))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(size).alias("norm")).collect()[0]
    if not facts["n"]:
        return spark.createDataFrame([], out_schema)
    octave = F.least(F.greatest(F.floor(F.log2(F.lit(facts["norm"]) / size)), F.lit(0)), F.lit(RANGES - 1)).cast("int")
    rows = rows.withColumn("g", octave)
    hashed = F.xxhash64("id")
    asks = _matrix(rows.filter(query).orderBy(hashed, "id").limit(SAMPLE_QUERIES).toPandas()["v"])
    models: dict[int, Hashes | None] = {}
    for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max(size).alias("norm")).collect():
        sample = _matrix(rows.filter(F.col("g") == r["g"]).orderBy(hashed, "id").limit(SAMPLE_ROWS).toPandas()["v"])
        models[r["g"]] = calibrated(sample, asks, r["n"], r["norm"], k, tables, recall, seed) if len(asks) else None
    model = spark.sparkContext.broadcast(models)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 2048):
                for g, part in pdf.iloc[at : at + 2048].groupby("g"):
                    h = model.value[g]
                    # a range without hashes is one bucket
                    ids = np.zeros((len(part), 1), np.int64) if h is None else bucket_ids(np.floor(h.cells(_matrix(part["v"]), False)))
                    for t in range(ids.shape[1]):
                        yield pd.DataFrame({"t": np.int32(g * tables + t), "bucket": ids[:, t], "id": part["id"].to_numpy(), "v": part["v"].to_numpy()})

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 128):
                part = pdf.iloc[at : at + 128]
                for g, h in model.value.items():
                    if h is None:
                        yield pd.DataFrame({"t": np.int32(g * tables), "bucket": np.int64(0), "id": part["id"].to_numpy(), "v": part["v"].to_numpy()})
                        continue
                    place = h.cells(_matrix(part["v"]), True)
                    for t in range(place.shape[1]):
                        ids = probe_ids(place[:, t], h.probes)
                        n = [len(x) for x in ids]
                        yield pd.DataFrame({"t": np.int32(g * tables + t), "bucket": np.concatenate(ids), "id": np.repeat(part["id"].to_numpy(), n), "v": np.repeat(part["v"].to_numpy(), n)})

    item = rows.schema["v"].dataType.simpleString()
    indexed = rows.mapInPandas(index, f"t int, bucket long, id long, v {item}")
    probes = rows.filter(query).mapInPandas(probe, f"t int, bucket long, id long, v {item}")
    def rank(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asks):
            return pd.DataFrame({"query_id": pd.Series(dtype="i8"), "vec_id": pd.Series(dtype="i8"), "score": pd.Series(dtype="f8")})
        ids, x, q = rows["id"].to_numpy(), _matrix(rows["v"]), _matrix(asks["v"])
        s = q @ x.T
        found = []
        for i, (own, near) in enumerate(zip(asks["id"].to_numpy(), s, strict=True)):
            near[ids == own] = -np.inf
            # rounding in the product of blocks may not decide; what is near the limit is computed again, row by row
            floor = near[np.argpartition(-near, k - 1)[k - 1]] if len(near) > k else -np.inf
            c = np.flatnonzero((near >= floor - 1e-9 * (1 + abs(floor))) & (near > -np.inf)) if floor > -np.inf else np.flatnonzero(near > -np.inf)
            exact = (x[c] * q[i]).sum(axis=1)
            top = np.lexsort((ids[c], -exact))[:k]
            found.append((np.full(len(top), own), ids[c][top], exact[top]))
        a, b, c = (np.concatenate(z) for z in zip(*found, strict=True))
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": c})

    def meet(indexed: DataFrame, probes: DataFrame, name: str) -> DataFrame:
        blocks = written(indexed.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("rows")).withColumn("rc", F.ceil(F.col("rows") / ROWS_PER_BLOCK)), f"buckets-{name}")
        asked = probes.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("asked")).withColumn("qc", F.ceil(F.col("asked") / QUERIES_PER_BLOCK))
        blocks = written(blocks.join(asked, ["t", "bucket"]).select("t", "bucket", "rc", "qc"), f"blocks-{name}")
        left = indexed.join(blocks, ["t", "bucket"]).withColumn("r", F.pmod(F.xxhash64("id"), "rc")).withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qc") - 1)))
        again = blocks.select(*[F.col(c).alias(c) for c in blocks.columns])
        right = probes.join(again, ["t", "bucket"]).withColumn("q", F.pmod(F.xxhash64("id"), "qc")).withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rc") - 1)))
        by = ["t", "bucket", "r", "q"]
        left, right = (x.select(*[F.col(c).alias(c) for c in [*by, "id", "v"]]) for x in (left, right))
        near = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(rank, "query_id long, vec_id long, score double")
        return near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))

    near = written(meet(indexed, probes, "near"), "near")
    full = near.groupBy("query_id").count().filter(F.col("count") >= min(k, facts["n"] - 1)).select(F.col("query_id").alias("id"))
    short = written(rows.filter(query).select("id", "v").join(full, "id", "left_anti"), "short")
    if facts["n"] > 1 and not short.isEmpty():
        whole = [F.lit(0).alias("t"), F.lit(0).cast("long").alias("bucket"), "id", "v"]
        again = meet(rows.select(*whole), short.select(*whole), "short")
        near = near.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").union(again)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_multiprobe_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all."""
    return finished(lambda: search(load(spark, sf_dir, "embeddings")), "nearest")
