"""The snapshot tables, and a pluggable reader in their place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Reader = Callable[[SparkSession, str], DataFrame]


def parquet(table: str) -> Reader:
    """A reader of one Parquet table of a folder."""
    return lambda spark, folder: spread(spark.read.parquet(f"{folder}/{table}.parquet"))


#: Bytes of a table for each core below which its rows are dealt out.
BYTES_PER_CORE = 16 << 20


def spread(df: DataFrame) -> DataFrame:
    """A table of few bytes, which can lie in a single row group, is dealt out to all cores; a larger one is left as it is.

    Reading a page takes far longer than moving it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * BYTES_PER_CORE else df


def read_pages(spark: SparkSession, folder: str, reader: Reader | None = None) -> DataFrame:
    """(page_id, url, html) from ``reader``, by default the Parquet table of fetched pages."""
    return (reader or parquet("pages"))(spark, folder).select("page_id", "url", "html")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return parquet(name)(spark, folder)
