"""Delimited text files as all-string frames."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.names import header_names, scanned_file
from moorage.session import settled
from moorage.sources import records
from moorage.sources.files import listing

UTF8, LATIN1 = "UTF-8", "ISO-8859-1"
OVERFLOW = "_overflow"
# Separator by file extension.
SEPARATORS = {"csv": ",", "tsv": "\t", "txt": "\t"}


@dataclass(frozen=True)
class FileGroup:
    """Files that one scan can read: same header line, encoding and quoting."""

    header: str
    encoding: str
    multi_line: bool
    paths: tuple[str, ...]


def _headers(separator: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            found = [records.first_record(path, separator) for path in paths]
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "header": pa.array(found, pa.binary())})

    return run


def _well_quoted(line: Column, separator: str) -> Column:
    """Whether each quote of a line opens or closes a field of that line, or stands for itself inside one."""
    parts = F.split(line, '"')
    last = F.size(parts) - 1
    begins, ends = lambda x: F.startswith(x, F.lit(separator)), lambda x: F.endswith(x, F.lit(separator))
    outer = lambda x, i: F.when(i % 2 == 1, True).otherwise((x == "") | ((i == 0) | begins(x)) & ((i == last) | ends(x)))
    return (last % 2 == 0) & F.forall(F.transform(parts, outer), lambda good: good)


def profile(spark: SparkSession, paths: str | list[str], separator: str = ",") -> DataFrame:
    """Per file: header record, encoding, whether it is to be read by records, number of lines.

    The text scan is split like any other and folded per file by a hash aggregate of flags and counts,
    so neither a huge file nor a huge number of files meets one task. Headers are read apart, from the
    first bytes of each file; carried through the aggregate they would turn it into a sort of all lines.
    In a file whose lines are all well quoted, every line is a record; any other is ``multi_line``.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(paths).select("value", scanned_file().alias("path"))
    odd = F.contains("value", F.lit('"')) & ~_well_quoted(F.col("value"), separator)
    facts = lines.groupBy("path").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("valid"),
        F.bool_or(odd).alias("multi_line"),
        F.count(F.lit(1)).alias("lines"),
    )
    headers = listing(spark, paths).select("path").mapInArrow(_headers(separator.encode()), "path string, header binary")
    encoding = F.when(F.col("valid"), UTF8).otherwise(LATIN1)
    text = F.when(F.col("valid"), F.col("header").cast("string")).otherwise(F.decode("header", LATIN1))
    return facts.join(headers, "path").select(
        "path", text.alias("header"), encoding.alias("encoding"), "multi_line", "lines"
    )


def file_groups(profiled: DataFrame) -> list[FileGroup]:
    """Scan plan: which files can be read together.

    Only file names, as in any Spark file index, and the distinct headers reach the driver, row by row.
    """
    known = profiled.where(F.col("header").isNotNull())
    known = settled(known.withColumn("key", F.md5("header")).drop("lines"), "file-profile")
    headers = {r.key: r.header for r in known.groupBy("key").agg(F.first("header").alias("header")).toLocalIterator()}
    members: dict[tuple[str, str, bool], list[str]] = {}
    for r in known.select("key", "encoding", "multi_line", "path").toLocalIterator():
        members.setdefault((r.key, r.encoding, r.multi_line), []).append(r.path)
    found = [FileGroup(headers[k], e, m, tuple(sorted(paths))) for (k, e, m), paths in members.items()]
    return sorted(found, key=lambda g: (g.header, g.encoding, g.multi_line))


def read_group(spark: SparkSession, group: FileGroup, separator: str, overflow: bool = False) -> DataFrame:
    """All columns as text plus ``source_file``; blank lines are skipped, short rows padded with nulls.

    With ``overflow`` one more column shows what a row has beyond its header. Files whose records span lines are
    cut into ranges like the others.
    """
    cells = next(csv.reader(io.StringIO(group.header.lstrip("\ufeff"), newline=""), delimiter=separator), [])
    names = header_names(cells) + ([OVERFLOW] if overflow else [])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    options = {"sep": separator, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    if not group.multi_line:
        reader = spark.read.options(**options).option("header", True).option("encoding", group.encoding).schema(schema)
        return reader.csv([literal_path(p) for p in group.paths]).withColumn("source_file", scanned_file())
    found = records.records(records.range_states(spark, list(group.paths), separator), separator, group.encoding)
    # ``multiLine`` keeps line ends inside quotes as they are.
    parsed = F.from_csv("record", quoted_ddl(schema), {**options, "multiLine": "true"})
    return found.select(parsed.alias("_row"), "source_file").select("_row.*", "source_file")


def quoted_ddl(schema: T.StructType) -> str:
    return ", ".join("`" + f.name.replace("`", "``") + "` string" for f in schema)


def literal_path(path: str) -> str:
    """A listed path as a scan argument that matches only itself."""
    return "".join("\\" + ch if ch in "*?[]{}\\" else ch for ch in path)


def read_delimited(spark: SparkSession, paths: str | list[str], separator: str = ",") -> DataFrame:
    """Every file under ``paths``; frames of different headers are matched by name."""
    frames = [read_group(spark, g, separator) for g in file_groups(profile(spark, paths, separator))]
    if not frames:
        raise ValueError(f"no delimited data below {paths}")
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def overlong_files(df: DataFrame) -> DataFrame:
    """Files with a row longer than the header, which is an error of that file."""
    return (
        df.groupBy(F.col("source_file").alias("path"))
        .agg(F.count_if(F.col(OVERFLOW).isNotNull()).alias("long_rows"))
        .where(F.col("long_rows") > 0)
    )
