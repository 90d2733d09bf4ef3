"""The queries of this subpackage, one per operator, over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.llm import bytebpe, chat, counts, decontaminate, fingerprints, jaccard, order, packing, periodic, quality, shards, spelling, webtext
from moorage.llm.common import prepare
from moorage.llm.oracles import ORACLES  # noqa: F401
from moorage.session import workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(_table(spark, sf_dir, "documents"))


@_query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


@_query
def op4_web_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.main_text(_table(spark, sf_dir, "pages"))


@_query
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(_table(spark, sf_dir, "documents")).drop("set_id")


@_query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.chat_digest(chat.format_chat(chat.text_parts(rows)))


@_query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(_table(spark, sf_dir, "documents"))


@_query
def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.training_order(_table(spark, sf_dir, "documents"), workspace(spark, "shard-files"))


@_query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shuffled_shards(_table(spark, sf_dir, "documents"))
    return placed.select(
        "record.doc_id",
        "size",
        F.crc32(F.coalesce("record.text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


@_query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.words_with_slips(_table(spark, sf_dir, "documents")))


@_query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.round_trip(_table(spark, sf_dir, "documents"))


@_query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digest(periodic.periodic_runs(periodic.with_repeated_tail(_table(spark, sf_dir, "documents"))))
