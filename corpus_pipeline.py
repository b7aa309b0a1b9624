"""The corpus pipeline: each stage works on all that the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written as Parquet and read
again as the next one's ``docs``; all but the last return the columns of ``docs``. Empty tables pass
through; null texts are kept as they are and packed as empty ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapline.llm.decontaminate import remove_contaminated
from snapline.llm.pack import pack
from snapline.llm.pii import redact
from snapline.llm.registry import ready, table
from snapline.llm.simhash import keep_one
from snapline.llm.toxicity import remove_toxic
from snapline.session import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# The models and digests in between are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go."""
    return remove_toxic(docs, table(ready(spark), sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints stays."""
    ready(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return remove_contaminated(docs, table(ready(spark), sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    ready(spark)
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed token sequences."""
    ready(spark)
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage but the last is written to the shared scratch folder."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
