"""Landing new files exactly once, as a file stream instead of a hand-kept list of URLs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.names import scanned_file
from moorage.operators.history import RECORD
from moorage.operators.metrics import Metric, observed
from moorage.sinks import tables
from moorage.sources.delimited import literal_path
from moorage.sources.files import delete, every_file, has_data

BATCH = "_batch"
# Files without bytes are in no batch of a stream.
NO_BATCH = -1
METRICS = T.StructType().add("metric_name", T.StringType()).add("value", T.DoubleType())
ERRORS = T.StructType().add("path", T.StringType()).add("error", T.StringType())
FILES = "path string, modificationTime timestamp, length bigint, content binary"


def _replace_batch(df: DataFrame, path: str, batch_id: int, owner: Sequence[str] = ()) -> None:
    """Write one batch's rows so that a repeated batch replaces its own earlier attempt.

    ``owner`` names the columns that tell apart streams sharing the table.
    """
    (
        df.withColumn(BATCH, F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*owner, BATCH)
        .parquet(path)
    )


def readable(frame: Callable[[list[str]], DataFrame], paths: list[str]) -> tuple[list[str], list[tuple[str, str]]]:
    """The files that can be read to their end, and the others with the reason.

    Halves are read until what fails is one file, so a bad file costs as many reads as its batch has doublings, each a
    job of its own over many tasks, and good files are never judged by a bad neighbour.
    """
    try:
        frame(paths).write.format("noop").mode("overwrite").save()
        return paths, []
    except Exception as exc:  # noqa: BLE001 - what a reader raises depends on the format
        if len(paths) == 1:
            return [], [(paths[0], str(exc).strip().splitlines()[0][:500])]
    half = len(paths) // 2
    (good, bad), (more, worse) = readable(frame, paths[:half]), readable(frame, paths[half:])
    return good + more, bad + worse


def ingest(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    root: str,
    dataset: str,
    jurisdiction: str,
    run_time: str,
    metrics: Sequence[Metric] = (),
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    **options: str,
) -> None:
    """Load every file of ``source`` that earlier runs have not seen, then stop.

    The stream is one of file names. Each micro-batch reads its files and writes data, then metrics, then errors, then
    history, all keyed by the batch id. If a run dies in between, the next one repeats the batch and replaces what was there:
    no file is lost or doubled. A file that cannot be read stops nothing: the rest of its batch is loaded, and it is a row of
    the error table, like files without any bytes.
    """
    named = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True)
    if "pathGlobFilter" in options:
        named = named.option("pathGlobFilter", options["pathGlobFilter"])
    if files_per_batch:
        named = named.option("maxFilesPerTrigger", files_per_batch)

    def frame(paths: list[str]) -> DataFrame:
        reader = spark.read.format(file_format).schema(schema).options(**options).option("basePath", source)
        return reader.load([literal_path(p) for p in paths]).select("*", scanned_file().alias("_path"), F.col("_metadata.file_name").alias("_name"))

    def write(paths: list[str], batch_id: int, attempt: int) -> None:
        batch = frame(paths)
        rows, seen = observed(batch, metrics, f"{dataset}-{batch_id}-{attempt}")
        _replace_batch(rows.drop("_path", "_name"), tables.table_path(root, dataset), batch_id)
        found = [(n, float(v)) for n, v in seen.get.items() if v is not None]
        _replace_batch(spark.createDataFrame(found, METRICS), tables.table_path(root, f"{dataset}_metrics"), batch_id)
        per_file = batch.groupBy("_path", "_name").agg(F.count(F.lit(1)).alias("row_count"))
        record = per_file.select(
            F.lit(dataset).alias("dataset_name"),
            F.lit(jurisdiction).alias("jurisdiction"),
            F.col("_path").alias("source_url"),
            F.col("_name").alias("filename"),
            F.lit("{}").alias("partition_values"),
            F.lit(run_time).alias("loaded_at"),
            "row_count",
            F.lit(None).cast("string").alias("file_hash"),
        )
        _replace_batch(record, tables.table_path(root, "load_history"), batch_id, ["jurisdiction", "dataset_name"])

    def load(batch: DataFrame, batch_id: int) -> None:
        # Names only, as many as a batch may have.
        paths = [r.path for r in batch.select("path").toLocalIterator()]
        if not paths:
            return
        errors = tables.table_path(root, f"{dataset}_errors")
        delete(spark, f"{errors}/{BATCH}={batch_id}")
        try:
            write(paths, batch_id, 0)
        except Exception:
            good, bad = readable(frame, paths)
            if not bad:
                raise
            # What the failed attempt wrote goes, whatever partitions it reached.
            delete(spark, f"{tables.table_path(root, dataset)}/{BATCH}={batch_id}")
            _replace_batch(spark.createDataFrame(bad, ERRORS), errors, batch_id)
            if good:
                write(good, batch_id, 1)

    query = (
        named.load(source)
        .select("path")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", tables.table_path(root, f"_checkpoint_{dataset}"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    empty = every_file(spark, source, options.get("pathGlobFilter")).where("length = 0")
    delete(spark, f"{tables.table_path(root, f'{dataset}_errors')}/{BATCH}={NO_BATCH}")
    if not empty.isEmpty():
        _replace_batch(empty.select("path", F.lit("file is empty").alias("error")), tables.table_path(root, f"{dataset}_errors"), NO_BATCH)


def load_errors(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """``path, error`` of the files that could not be loaded."""
    path = tables.table_path(root, f"{dataset}_errors")
    return _read(spark, path, ERRORS) if has_data(spark, path) else spark.createDataFrame([], ERRORS)


def loaded(spark: SparkSession, root: str, dataset: str, schema: T.StructType) -> DataFrame:
    return _read(spark, tables.table_path(root, dataset), schema)


def batch_metrics(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    return _read(spark, tables.table_path(root, f"{dataset}_metrics"), METRICS, keep_batch=True)


def stream_history(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, tables.table_path(root, "load_history"), RECORD)


def _read(spark: SparkSession, path: str, schema: T.StructType, keep_batch: bool = False) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    df = spark.read.schema(full).parquet(path)
    return df if keep_batch else df.drop(BATCH)
