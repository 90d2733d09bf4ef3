"""Load history: which files are in, and which are still to load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.operators.positions import with_position
from moorage.sources import files

RECORD = (
    T.StructType()
    .add("dataset_name", T.StringType())
    .add("jurisdiction", T.StringType())
    .add("source_url", T.StringType())
    .add("filename", T.StringType())
    .add("partition_values", T.StringType())
    .add("loaded_at", T.StringType())
    .add("row_count", T.LongType())
    .add("file_hash", T.StringType())
)


def history_path(root: str) -> str:
    """The one place history is written to and read from."""
    return f"{root.rstrip('/')}/load_history"


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All records, or none on the first run. An unreadable history raises: it is not an empty one."""
    path = history_path(root)
    if not files.has_data(spark, path):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).parquet(path)


def select_history(history: DataFrame, jurisdiction: str | None = None, dataset: str | None = None) -> DataFrame:
    if jurisdiction is not None:
        history = history.where(F.col("jurisdiction") == jurisdiction)
    if dataset is not None:
        history = history.where(F.col("dataset_name") == dataset)
    return history


def loaded_urls(history: DataFrame) -> DataFrame:
    return history.select("source_url").distinct()


def newest_first(history: DataFrame) -> DataFrame:
    return history.orderBy(F.desc("loaded_at"), "source_url")


def newest_positions(history: DataFrame) -> DataFrame:
    """The same order as a column ``position``."""
    return with_position(history, F.desc("loaded_at"), "source_url")


def unloaded(discovered: DataFrame, history: DataFrame, force: bool = False, match_hash: bool = False) -> DataFrame:
    """Discovered files that are not in the history; repeats among them stay.

    ``match_hash`` also reloads a known URL whose content has changed.
    """
    if force:
        return discovered
    if match_hash:
        known = history.select("source_url", "file_hash").distinct()
        on = (discovered["url"] == known["source_url"]) & discovered["file_hash"].eqNullSafe(known["file_hash"])
    else:
        known = loaded_urls(history)
        on = discovered["url"] == known["source_url"]
    return discovered.join(known, on, "left_anti")


def records(loaded: DataFrame, run_time: str, keys: Sequence[str] = ("dataset_name", "jurisdiction")) -> DataFrame:
    """History rows of loaded files.

    ``loaded`` has the keys, ``url, filename, partition_values`` (a map), ``row_count`` and maybe ``file_hash``.
    """
    file_hash: Column = F.col("file_hash") if "file_hash" in loaded.columns else F.lit(None)
    return loaded.select(
        *keys,
        F.col("url").alias("source_url"),
        "filename",
        F.to_json("partition_values").alias("partition_values"),
        F.lit(run_time).alias("loaded_at"),
        F.col("row_count").cast("bigint").alias("row_count"),
        file_hash.cast("string").alias("file_hash"),
    )


def append(history_rows: DataFrame, root: str) -> None:
    history_rows.write.mode("append").parquet(history_path(root))
