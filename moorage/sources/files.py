"""File listings and small file-system steps, all through the Hadoop file-system layer."""

from __future__ import annotations

import fnmatch
import hashlib
import re

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions.names import file_name, scanned_file
from moorage.session import settled

CHUNK = 8 << 20
# Folders that one task lists.
FOLDERS = 16


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow file system of a Hadoop-style path, for tasks that handle files themselves."""
    scheme, authority, name = re.match(r"(?:([a-zA-Z][\w+.-]*):)?(?://([^/]*))?(.*)", path, re.S).groups()
    if scheme in (None, "file"):
        return pafs.LocalFileSystem(), name
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    fs, base = pafs.FileSystem.from_uri(f"{scheme}://{authority or ''}/")
    return fs, base.rstrip("/") + name


def open_input(path: str):
    fs, name = filesystem(path)
    return fs.open_input_file(name)


def listing(spark: SparkSession, root: str | list[str], pattern: str | None = None) -> DataFrame:
    """One row per file below ``root``: path, length, modification time. No content is read.

    Tasks get files by their total size, so work on the listed files is spread without a shuffle.
    Spark leaves out files of zero bytes.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select("path", "length", "modificationTime")


def _size(path: str) -> int | None:
    try:
        fs, name = filesystem(path)
    except pa.ArrowInvalid:  # no place of files, such as a web address
        return None
    info = fs.get_file_info(name)
    return info.size if info.type == pafs.FileType.File else None


def _sizes(batches):
    for batch in batches:
        paths = batch.column("path").to_pylist()
        sizes = [_size(path) for path in paths]
        yield pa.RecordBatch.from_pydict({"path": paths, "length": pa.array(sizes, pa.int64())})


def sizes(paths: DataFrame) -> DataFrame:
    """``path, length`` of each given path, asked for in tasks: 0 for empty files, null where no file lies."""
    return spread(paths.select("path").distinct()).mapInArrow(_sizes, "path string, length bigint")


def _children(batches):
    """Files and folders directly in each folder."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, name = filesystem(path)
            prefix = path[: len(path) - len(name)]
            found = fs.get_file_info(pafs.FileSelector(name, allow_not_found=True))
            # Hidden files and folders are not data, as in any scan.
            shown = [i for i in found if not i.base_name.startswith((".", "_"))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([prefix + i.path for i in shown], pa.string()),
                    pa.array([i.size if i.type == pafs.FileType.File else None for i in shown], pa.int64()),
                    pa.array([i.mtime for i in shown], pa.timestamp("us", "UTC")),
                    pa.array([i.type == pafs.FileType.Directory for i in shown], pa.bool_()),
                ],
                names=["path", "length", "modificationTime", "folder"],
            )


def every_file(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """``path, length, modificationTime`` of every file below ``root``, empty ones too; ``pattern`` is a glob of names.

    Folders are listed level by level, those of a level spread over tasks, so that neither a deep tree nor a wide one meets
    one task. The driver learns only how many folders the next level has. A missing root has no files.
    """
    fs, target = _hadoop(spark, root)
    base = fs.makeQualified(target).toString().rstrip("/")
    level, found, many = spark.createDataFrame([(base,)], "path string"), None, 1
    while many:
        # A task for every few folders: most levels of most trees are small.
        tasks = min(4 * spark.sparkContext.defaultParallelism, -(-many // FOLDERS))
        schema = "path string, length bigint, modificationTime timestamp, folder boolean"
        listed = settled(level.repartition(tasks, "path").mapInArrow(_children, schema), "listing")
        own = listed.where("not folder").drop("folder")
        found = own if found is None else found.unionByName(own)
        level = listed.where("folder").select("path")
        many = level.count()
    return found if pattern is None else found.where(file_name(F.col("path")).rlike(fnmatch.translate(pattern)))


def _create(batches):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, name = filesystem(path)
            fs.create_dir(name.rpartition("/")[0], recursive=True)
            fs.open_output_stream(name).close()
        yield batch.select(["path"])


def create_empty(paths: DataFrame) -> None:
    """Files of zero bytes at each given path."""
    paths.select("path").mapInArrow(_create, "path string").write.format("noop").mode("overwrite").save()


def contents(spark: SparkSession, root: str | list[str], pattern: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select("path", "content")


def fingerprint(files: DataFrame) -> DataFrame:
    """Adds the MD5 of ``content`` and drops the bytes."""
    return files.withColumn("file_hash", F.md5("content")).drop("content")


def _md5(batches):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            digest = hashlib.md5()
            with open_input(path) as source:
                while chunk := source.read(CHUNK):
                    digest.update(chunk)
            yield pa.RecordBatch.from_pydict({"path": [path], "file_hash": [digest.hexdigest()]})


def fingerprint_files(listed: DataFrame) -> DataFrame:
    """``path, file_hash`` of listed files, read in pieces so that their size does not matter."""
    return listed.select("path").mapInArrow(_md5, "path string, file_hash string")


def spread(df: DataFrame, column: str = "path") -> DataFrame:
    """Rows that each stand for a file, over many tasks.

    The number is given outright: sized by bytes, a list of paths would end up in a single task.
    """
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, column)


def rows_per_file(df: DataFrame) -> DataFrame:
    """Row count of every file behind a file-based frame."""
    return df.groupBy(scanned_file().alias("path")).agg(F.count(F.lit(1)).alias("row_count"))


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def has_data(spark: SparkSession, path: str, suffix: str = ".parquet") -> bool:
    """True if any file with ``suffix`` lies below ``path``.

    A missing path is False; a path that cannot be read raises, so an outage is not "no data".
    """
    fs, target = _hadoop(spark, path)
    if not fs.exists(target):
        return False
    found = fs.listFiles(target, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(suffix):
            return True
    return False


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, empty when it does not exist."""
    fs, target = _hadoop(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put the staged folder in place of ``target``; the old one goes only after the new one is there."""
    fs, new = _hadoop(spark, staged)
    _, final = _hadoop(spark, target)
    # Hidden, so that a reader of the parent does not take it for a partition.
    parent, _, name = target.rstrip("/").rpartition("/")
    _, old = _hadoop(spark, f"{parent}/.{name}.replaced")
    fs.mkdirs(final.getParent())
    if not fs.exists(final) and fs.exists(old):
        fs.rename(old, final)
    fs.delete(old, True)
    had_old = fs.exists(final)
    if had_old and not fs.rename(final, old):
        raise OSError(f"could not set aside {target}")
    if not fs.rename(new, final):
        if had_old:
            fs.rename(old, final)
        raise OSError(f"could not promote {staged} to {target}")
    fs.delete(old, True)
