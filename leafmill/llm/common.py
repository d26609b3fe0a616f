"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; on one machine, as in tests, a private one where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="leafmill-")
        spark.sparkContext.setCheckpointDir(found)
    return found


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the tables that a query under ``finished`` has written so far.
_scratch: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("scratch", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a table in the shared folder and read it back.

    The table outlives lost executors.  It stays until the query that is run
    under ``finished`` ends, else until the folder is emptied (see ``purge``),
    since the frames that read it are lazy.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/leafmill/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if (held := _scratch.get()) is not None:
        held.append((spark, path))
    # nothing reads the shuffle files of this query again: they go as soon as the table is there
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def finished(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The frame that ``make`` returns, written; the tables written on the way to it are deleted."""
    held: list[tuple[SparkSession, str]] = []
    token = _scratch.set(held)
    try:
        try:
            out = make()
        finally:
            _scratch.reset(token)
        return written(out, name)
    finally:
        for spark, path in held:
            _delete(spark, path)


def _delete(spark: SparkSession, place: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of one fingerprint and a key that may be broadcast: some tens of MB.
BROADCAST_ROWS = 1_000_000


def checked(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written, narrow table, to be broadcast if it has at most ``rows`` rows; else Spark shuffles it."""
    return F.broadcast(table) if table.count() <= rows else table


#: A key counts as hot with more than this share of all rows, and more rows than that.
HOT_SHARE, HOT_ROWS = 1 / 1000, 10_000


def join_counted(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` joined with a written ``table`` of one row for each key, whose ``count`` is that of the key's rows.

    The few rows of hot keys (fewer than 1 / HOT_SHARE) are broadcast, so that
    no hot key's rows are shuffled; all others meet in a shuffle.
    """
    total = table.agg(F.coalesce(F.sum(count), F.lit(0))).collect()[0][0]
    least = max(HOT_ROWS, int(total * HOT_SHARE))
    hot = table.filter(F.col(count) > least)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table.filter(F.col(count) <= least), key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def purge(spark: SparkSession) -> None:
    """Delete every table ``written`` has made in this application."""
    _delete(spark, f"{shared_dir(spark)}/leafmill/{spark.sparkContext.applicationId}")


def remainder(key: Column | str, mod: int) -> Column:
    """crc32 of the key as text, modulo ``mod``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), F.lit(""))) % mod


def ranked(df: DataFrame, group: str, chunk: str, order: list[str], rank: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in parallel.

    Rows of a group are numbered within (group, chunk) and shifted by the
    count of all earlier chunks, so no task holds more than one chunk.
    ``df`` must give the same rows on every read (a written table).
    """
    from pyspark.sql import Window as W

    sizes = df.groupBy(group, chunk).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(group).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(group, chunk, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = W.partitionBy(group, chunk).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(inner) - 1)
    return out.join(sizes, [group, chunk]).withColumn(rank, F.col("_before") + F.col("_rn")).drop("_rn", "_before", chunk)


def chunks_for(rows: int, groups: int, per_chunk: int, least: int) -> int:
    """How many chunks keep (group, chunk) near ``per_chunk`` rows."""
    return max(least, -(-rows // (max(1, groups) * per_chunk)))
