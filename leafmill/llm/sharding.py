"""Sharding by rendezvous hashing.

Every (key, shard) pair gets a pseudo-random draw u in (0, 1); the key goes to
the shard with the largest ``-weight / ln(u)``.  A shard's draws do not depend
on the other shards, so adding one moves only the rows it wins, and weights act
in proportion.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import chunks_for, finished, load, ranked, written

#: Rows of one shard numbered by one task.
ROWS_PER_CHUNK = 200_000


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0-based) that wins the key. Null keys share one shard; equal draws go to the later shard."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights must be positive")
    text = key.cast("string")
    table = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights)])

    def draw(s: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(text, s["i"]), 11).cast("double")
        return F.struct((-s["w"] / F.log((bits + 0.5) / float(1 << 53))).alias("v"), s["i"].alias("i"))

    return F.array_max(F.transform(table, draw))["i"]


def shard(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Assign every row to a shard and a place in it.

    Returns (key, size, text_crc32, shard, slot, grown_shard): size is the
    text's UTF-8 bytes plus 16 (null text: 16, crc 0); slot numbers the rows
    of a shard from 0 without gaps; grown_shard is the shard if one more of
    weight 1 were added.  Repeated rows stay and get slots of their own; rows
    with a null key share a shard; an empty table gives no rows; other columns
    are not read.  Slots are dealt over (shard, chunk) groups, where a chunk
    takes rows by a hash of the row and its position, so that neither a hot
    key nor a large shard meets in one task.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body).cast("long") + 16).alias("size"),
        F.crc32(body).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, 1.0]).alias("grown_shard"),
        F.xxhash64(F.col(key), F.monotonically_increasing_id()).alias("_mix"),
    )
    kept = written(narrow, "shards")
    n = chunks_for(kept.count(), len(weights), ROWS_PER_CHUNK, 8)
    kept = kept.withColumn("_chunk", F.pmod("_mix", F.lit(n)))
    out = ranked(kept, "shard", "_chunk", ["doc_id", "text_crc32", "size", "_mix"], "slot")
    return out.select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")


def op10_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 equal shards."""
    out = finished(lambda: shard(load(spark, sf_dir, "documents"), [1.0] * 40), "shards")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
