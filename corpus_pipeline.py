"""The corpus pipeline over ``documents``: toxicity, near-duplicates, decontamination, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  The first four return the columns of documents; the last returns the
pieces of packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import decontam, dedup, packing, pii, toxicity
from leafmill.llm.common import finished, load, remainder


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a classifier of the labelled documents outside the held-out fold."""
    model = toxicity.train(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    name = "_score"
    while name in docs.columns:
        name += "_"
    return toxicity.score(docs, model, out=name).filter(F.col(name) < toxicity.THRESHOLD).drop(name)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return dedup.deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontam.clean(docs, load(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets."""
    return pii.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near-duplicates", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("pii", redact),
    ("packing", pack),
]

#: No SQL can state the trained and hashed stages; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each result is written as Parquet and read again as the next one's input.

    What the stages have written on the way is deleted in the end.
    """

    def stages() -> DataFrame:
        docs = load(spark, sf_dir, "documents")
        for name, stage in STAGES[:-1]:
            docs = finished(lambda docs=docs, stage=stage: stage(spark, docs, sf_dir), f"stage-{name}")
        return STAGES[-1][1](spark, docs, sf_dir)

    return finished(stages, "pipeline")
