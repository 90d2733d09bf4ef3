"""GeoParquet below partition folders: tasks write and publish, a manifest says what belongs to a write.

Rows of a partition value lie together in their task, so one file is open at a time. Files are staged under hidden names;
the table of those that finished tasks have written is the manifest, and an empty file beside it makes it valid. Only then
tasks move the files in, and delete what they replace. A write that dies before that has changed nothing; one that dies
later is finished by the next write, or by ``finish``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.sinks.geoparquet import GeoFile
from moorage.sources import files
from moorage.sources.files import filesystem

# What stands for a null in folder names, and the characters they do not hold as they are.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"
MODES = ("append", "overwrite", "dynamic")
_MANIFEST = "folder string, staged string, final string, row_count bigint"
_READY = "ready"


def folder_name(field: str, value: str | None) -> str:
    """``field=value`` as tables with partition folders spell it."""
    text = NULL_FOLDER if value is None or value == "" else value
    return "=".join("".join(f"%{ord(c):02X}" if c in _ESCAPED or c < " " else c for c in part) for part in (field, text))


def write(df: DataFrame, path: str, by: Sequence[str], crs: dict | None = None, column: str = "geometry", mode: str = "append") -> DataFrame:
    """Write a frame with a WKB (or WKB hex) column below ``path/field=value/...``; returns ``folder, files, row_count``.

    ``append`` adds files, ``overwrite`` replaces all there are, ``dynamic`` those of the partitions that occur. Partition
    columns are folder names only, as in any partitioned table. A frame without rows adds nothing.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    spark = df.sparkSession
    finish(spark, path)
    commit = f"{path.rstrip('/')}/_commit-{uuid.uuid4().hex}"
    data = [c for c in df.columns if c not in by]
    values: list[Column] = [F.col(c).cast("string") for c in by]
    keyed = df.select(*data, F.array(*values).alias("_values") if by else F.lit(None).cast("array<string>").alias("_values"))
    dealt = keyed.hint("rebalance", "_values").sortWithinPartitions("_values") if by else keyed
    dealt.mapInArrow(_stage(list(by), path.rstrip("/"), commit, crs, column), _MANIFEST).write.parquet(f"{commit}/add")
    added = spark.read.schema(_MANIFEST).parquet(f"{commit}/add")
    old = files.every_file(spark, path, "*.parquet").select("path")
    if mode == "dynamic":
        there = F.regexp_replace(F.substr("path", F.length("path") - F.length(_below("path", path)) + 1), "/?[^/]*$", "")
        old = old.withColumn("folder", there).join(added.select("folder").distinct(), "folder", "left_semi")
    old.where(F.lit(mode != "append")).select("path").write.parquet(f"{commit}/drop")
    files.create_empty(spark.createDataFrame([(f"{commit}/{_READY}",)], "path string"))
    told = [tuple(r) for r in added.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count")).toLocalIterator()]
    _apply(spark, commit)
    return spark.createDataFrame(told, "folder string, files bigint, row_count bigint")


def _below(column: str, root: str) -> Column:
    """What follows the root in a listed path, which may carry a scheme that the root lacks."""
    base = root.rstrip("/").split("://")[-1].removeprefix("file:") + "/"
    return F.substr(F.col(column), F.locate(base, F.col(column)) + F.lit(len(base)))


def finish(spark: SparkSession, path: str) -> int:
    """Complete the writes below ``path`` that died while they were published; returns how many. No other writer may be at work."""
    done = 0
    for name in files.child_names(spark, path):
        commit = f"{path.rstrip('/')}/{name}"
        if name.startswith("_commit-") and files.exists(spark, f"{commit}/{_READY}"):
            _apply(spark, commit)
            done += 1
    return done


def _apply(spark: SparkSession, commit: str) -> None:
    """Publish a valid manifest; repeating any part of it does no harm."""
    spread = lambda df: files.spread(df, df.columns[0])
    moves = spread(spark.read.schema(_MANIFEST).parquet(f"{commit}/add").select("staged", "final"))
    moves.mapInArrow(_move, "final string").write.format("noop").mode("overwrite").save()
    drops = spread(spark.read.schema("path string").parquet(f"{commit}/drop"))
    drops.mapInArrow(_drop, "path string").write.format("noop").mode("overwrite").save()
    files.delete(spark, commit)


def _move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for staged, final in zip(batch.column("staged").to_pylist(), batch.column("final").to_pylist()):
            fs, source = filesystem(staged)
            target = filesystem(final)[1]
            fs.create_dir(target.rpartition("/")[0], recursive=True)
            # A repeated move finds its work done.
            if fs.get_file_info(source).type == pafs.FileType.File:
                fs.move(source, target)
        yield batch.select(["final"])


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, name = filesystem(path)
            for own in (name, "{0}/.{2}.crc".format(*name.rpartition("/"))):
                if fs.get_file_info(own).type == pafs.FileType.File:
                    fs.delete_file(own)
        yield batch


def _stage(by: list[str], root: str, commit: str, crs: dict | None, column: str):
    """Task function that writes a file for each partition value and names it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        geo = sink = place = folder = name = None

        def closed() -> pa.RecordBatch:
            geo.close()
            sink.close()
            final = "/".join(p for p in (root, folder, name) if p)
            row = {"folder": folder, "staged": f"{commit}/files/{name}", "final": final, "row_count": geo.rows}
            return pa.RecordBatch.from_pylist([row], pa.schema([(k, pa.int64() if k == "row_count" else pa.string()) for k in row]))

        for batch in batches:
            values, rows = batch.column("_values").to_pylist(), batch.drop_columns(["_values"])
            edges = [0, *(i for i in range(1, len(values)) if values[i] != values[i - 1]), len(values)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if geo is None or values[a] != place:
                    if geo is not None:
                        yield closed()
                    place = values[a]
                    folder = "/".join(folder_name(f, v) for f, v in zip(by, place or []))
                    name = f"part-{uuid.uuid4().hex}.snappy.parquet"
                    fs, target = filesystem(f"{commit}/files/{name}")
                    fs.create_dir(target.rpartition("/")[0], recursive=True)
                    sink = fs.open_output_stream(target)
                    geo = GeoFile(sink, rows.schema, column, crs)
                geo.write(rows.slice(a, b - a))
        if geo is not None:
            yield closed()

    return run
