"""Moving legacy files into dated partitions, byte for byte, spread over the executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.names import below
from moorage.functions.paths import relayout_path
from moorage.sources import files
from moorage.sources.files import CHUNK, filesystem, open_input

OUTCOME = (
    T.StructType().add("path", T.StringType()).add("target", T.StringType()).add("status", T.StringType()).add("error", T.StringType())
)
_ARROW = pa.schema([(n, pa.string()) for n in OUTCOME.names])


def mapping(spark: SparkSession, root: str, prefix: str, hive: bool = False, by_file_date: bool = False) -> DataFrame:
    """``path, target`` of every Parquet file below ``root``, empty ones too; this alone is the dry run."""
    relative = below(F.col("path"), root)
    return files.every_file(spark, root, "*.parquet").select(
        "path", relayout_path(relative, prefix.rstrip("/"), hive, by_file_date).alias("target")
    )


def _copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            status, error = "copied", None
            try:
                fs, target = filesystem(row["target"])
                folder, _, name = target.rpartition("/")
                fs.create_dir(folder, recursive=True)
                temp = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with open_input(row["path"]) as source, fs.open_output_stream(temp) as sink:
                    while chunk := source.read(CHUNK):
                        sink.write(chunk)
                fs.move(temp, target)
            except Exception as exc:  # noqa: BLE001 - a bad file must not stop the others
                status, error = "error", f"{type(exc).__name__}: {exc}"
            yield pa.RecordBatch.from_pylist([{**row, "status": status, "error": error}], schema=_ARROW)


def relayout(mapped: DataFrame, outcomes: str) -> DataFrame:
    """Copy every file to its target and return the outcome rows, kept in the table ``outcomes``.

    Two files with one target are an error of both, not a silent overwrite.
    """
    clash = mapped.groupBy("target").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("target")
    clear = mapped.join(clash, "target", "left_anti").select("path", "target")
    copied = files.spread(clear).mapInArrow(_copy, OUTCOME)
    clashing = mapped.join(clash, "target", "left_semi").select(
        "path", "target", F.lit("error").alias("status"), F.lit("several files have this target").alias("error")
    )
    copied.unionByName(clashing).write.mode("append").parquet(outcomes)
    return mapped.sparkSession.read.schema(OUTCOME).parquet(outcomes)


def summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
