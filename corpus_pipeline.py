"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. Its result is
written as Parquet below the shared folder and read again, so that a lost executor costs one stage at
most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import decontaminate, minmax, packing, quality, toxicity
from siltstone.llm.common import table
from siltstone.session import configure, materialize


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the quality cutoffs of their language and source."""
    configure(spark)
    return quality.keep_good(docs)


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    configure(spark)
    return minmax.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not consist of benchmark passages to a twentieth or more."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all that is left, packed into sequences."""
    configure(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", civil),
    ("quality rules", good),
    ("near-dedup", single),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

#: A kernel machine and a packing cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
