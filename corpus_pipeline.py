"""The corpus pipeline: quality, near duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moorage.llm.common import prepare
from moorage.llm.decontaminate import without_leaks
from moorage.llm.jaccard import distinct_documents
from moorage.llm.packing import packed
from moorage.llm.quality import accepted
from moorage.session import workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return accepted(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays: that of the smallest id."""
    prepare(spark)
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark item go."""
    return without_leaks(docs, prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their places in sequences."""
    prepare(spark)
    return packed(docs)


STAGES = [
    ("quality", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# A learnt classifier and its decisions are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = workspace(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
