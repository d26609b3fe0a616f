"""Streams of pages: the column functions of a read are stateless, so they run on arriving files as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import html as H

PAGES = "page_id long, url string, html string"


def arriving(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """A stream of page files put into a folder."""
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def read_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, title, lang, text) of arriving pages."""
    html = F.col("html")
    return pages.select("page_id", "url", H.title(html).alias("title"), H.language(html).alias("lang"), H.body_text(html).alias("text"))
