"""Web-file load: discovered files minus loaded ones -> parsed rows -> partitioned append -> history."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moorage.functions.names import normalize_name, suffix_duplicates
from moorage.operators import headers, history, inference
from moorage.session import settled
from moorage.sinks import tables
from moorage.sources import delimited, files, workbook

ERROR = "path string, error string"


@dataclass
class Parsed:
    """Rows of the good files, their row counts (``path, row_count``) and the bad files (``path, error``)."""

    rows: DataFrame | None
    counts: DataFrame
    bad: DataFrame


def _local(path: str) -> str:
    """Listed local paths carry a scheme that given ones may lack."""
    return re.sub("^file:/+", "/", path)


def _merge(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b, allowMissingColumns=True)


def parse_delimited(spark: SparkSession, paths: list[str], separator: str, stored: Mapping[str, str]) -> Parsed:
    """Delimited files with normalised names and typed columns.

    One pass per group of like files gives the types, the row counts and the files with overlong rows.
    ``stored`` has the types of the target table.
    """
    groups, masks = [], {}
    scans = delimited.file_groups(delimited.profile(spark, [delimited.literal_path(p) for p in paths], separator))
    seen = {_local(p) for group in scans for p in group.paths}
    for group in scans:
        rows = delimited.read_group(spark, group, separator, overflow=True)
        data = [c for c in rows.columns if c not in ("source_file", delimited.OVERFLOW)]
        columns = suffix_duplicates([normalize_name(c) for c in data])
        rows = rows.withColumnsRenamed(dict(zip(data, columns)))
        overlong = F.col(delimited.OVERFLOW).isNotNull() if delimited.OVERFLOW in rows.columns else F.lit(False)
        report = inference.mask_report(rows, columns, ["source_file"], long_rows=F.count_if(overlong))
        # A file of a header alone has no rows to report.
        named = spark.createDataFrame([(p,) for p in group.paths], "path string")
        report = named.join(report.withColumnRenamed("source_file", "path"), "path", "left").withColumns(
            {
                "masks": F.coalesce("masks", F.array(*[F.lit(0)] * len(columns))),
                "row_count": F.coalesce("row_count", F.lit(0).cast("bigint")),
            }
        )
        long = F.when(F.col("long_rows") > 0, F.lit("row has more fields than the header"))
        report = settled(report.withColumn("error", F.coalesce(long, _conflict(columns, stored))), "file-report")
        good = report.where("error is null")
        overall = good.agg(*[F.bit_or(F.col("masks")[i]) for i in range(len(columns))]).first()
        for column, mask in zip(columns, overall):
            masks[column] = masks.get(column, 0) | (mask or 0)
        rows = rows.drop(delimited.OVERFLOW)
        if good.count() < report.count():
            wrong = report.where("error is not null").select(F.col("path").alias("source_file"))
            rows = rows.join(wrong, "source_file", "left_anti")
        groups.append((rows, columns, report))
    types = _types(masks, stored)
    out, counts = None, spark.createDataFrame([], "path string, row_count bigint")
    bad = spark.createDataFrame([(p, "file has no columns") for p in paths if _local(p) not in seen], ERROR)
    for rows, columns, report in groups:
        out = _merge(out, inference.cast_columns(rows, {c: types[c] for c in columns}))
        counts = counts.unionByName(report.where("error is null").select("path", "row_count"))
        bad = bad.unionByName(report.where("error is not null").select("path", "error"))
    return Parsed(out, counts, bad)


def _types(masks: Mapping[str, int], stored: Mapping[str, str]) -> dict[str, str]:
    """The stored type of a column, else the type of its values."""
    return {c: stored.get(c) or inference.type_of_mask(m) for c, m in masks.items()}


def _conflict(columns: list[str], stored: Mapping[str, str]):
    """Why the values of a file do not fit the table, null if they do."""
    checks = [
        F.when(~inference.fits(F.col("masks")[i], stored[c]), F.lit(f"column {c!r} is {stored[c]} in the table but not in the file"))
        for i, c in enumerate(columns)
        if c in stored
    ]
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")


def parse_excel(
    spark: SparkSession, paths: list[str], sheet: int | str = 0, header_detection: str | int = "auto"
) -> Parsed:
    """The same for workbooks; all values stay text. Each workbook is unpacked once."""
    explicit = None if header_detection == "auto" else int(header_detection)
    cells = workbook.excel_cells(files.listing(spark, [delimited.literal_path(p) for p in paths]), sheet)
    cells = settled(cells, "cells")
    rows = settled(headers.sheet_rows(cells.where(F.col("error").isNull())), "sheet-rows")
    found = settled(headers.header_rows(rows, explicit=explicit), "sheet-headers")
    failed = [df.where(F.col("error").isNotNull()).select(F.col("file").alias("path"), "error") for df in (cells, found)]
    out = None
    for table in headers.sheet_tables(rows, found):
        out = _merge(out, table.withColumnRenamed("file", "source_file").drop("sheet", "r"))
    named = found.where(F.col("error").isNull()).select(*headers.KEYS, "header_row")
    below = rows.join(named, headers.KEYS).groupBy(F.col("file").alias("path"))
    counts = below.agg(F.count_if(F.col("r") > F.col("header_row")).alias("row_count"))
    return Parsed(out, counts, failed[0].unionByName(failed[1]))


def load_files(
    spark: SparkSession,
    todo: DataFrame,
    root: str,
    dataset: str,
    jurisdiction: str,
    file_type: str,
    fields: Mapping[str, str],
    run_time: str,
    excel: Mapping | None = None,
    replace: bool = False,
) -> DataFrame:
    """Load landed files (``url, filename, partition_values, path``) in one job per kind of step.

    Rows are tagged with the partition values discovered for their file and appended below
    ``root/jurisdiction/dataset/field=value/...`` in the order of ``fields``. Bad files are returned as
    ``path, error`` and do not stop the rest; history is written after the data. With ``replace`` the
    partitions of the new files replace the stored ones instead of adding to them.
    """
    base = f"{root.rstrip('/')}/{jurisdiction}"
    target = tables.table_path(base, dataset)
    todo, refused = _usable(todo)
    paths = [r.path for r in todo.select("path").toLocalIterator()]
    if not paths:
        return refused
    if file_type in ("xlsx", "xls"):
        options = excel or {}
        parsed = parse_excel(spark, paths, options.get("sheet", 0), options.get("header_detection", "auto"))
    else:
        stored = {}
        if files.has_data(spark, target):
            stored = {f.name: f.dataType.simpleString() for f in spark.read.parquet(target).schema}
        parsed = parse_delimited(spark, paths, delimited.SEPARATORS[file_type], stored)
    at = _plain("path")
    counts, failed = settled(parsed.counts.select(at, "row_count"), "file-counts"), settled(parsed.bad, "file-errors")
    todo = todo.select("*", at)
    silent = todo.join(counts, "_at", "left_anti").join(failed.select(at), "_at", "left_anti")
    bad = refused.unionByName(failed).unionByName(silent.select("path", F.lit("file has no table").alias("error")))
    if parsed.rows is None:
        return bad
    values = todo.select("_at", *[F.col("partition_values")[f].alias(f) for f in fields])
    rows = parsed.rows.select(*[F.col(c) for c in parsed.rows.columns if c not in fields and c != "source_file"], _plain("source_file"))
    publish = tables.snapshot if replace else tables.append
    publish(rows.join(values, "_at").drop("_at"), target, list(fields))
    listed = files.listing(spark, [delimited.literal_path(p) for p in paths])
    loaded = (
        todo.join(counts, "_at")
        .join(files.fingerprint_files(listed).select(at, "file_hash"), "_at", "left")
        .select(
            F.lit(dataset).alias("dataset_name"), F.lit(jurisdiction).alias("jurisdiction"),
            "url", "filename", "partition_values", "row_count", "file_hash",
        )
    )
    history.append(history.records(loaded, run_time), base)
    return bad


def _plain(column: str):
    return F.regexp_replace(column, "^file:/+", "/").alias("_at")


def _usable(todo: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files that can be read, and the rest with a reason: not landed, empty, landed for several addresses, or several times."""
    sized = todo.join(files.sizes(todo), "path", "left")
    shared = F.size(F.collect_set("url").over(Window.partitionBy("path"))) > 1
    again = F.size(F.collect_set("path").over(Window.partitionBy("url"))) > 1
    # The several addresses of one landed file are few, as are the places of one address; the sets hold no more than them.
    reason = (
        F.when(shared, F.lit("several addresses have this file name"))
        .when(again, F.lit("address is landed several times"))
        .when(F.col("length").isNull(), F.lit("file is not landed"))
        .when(F.col("length") == 0, F.lit("file has no columns"))
    )
    judged = settled(sized.withColumn("error", reason).dropDuplicates(["path", "url"]), "landed-files")
    return judged.where("error is null").drop("error", "length"), judged.where("error is not null").select("path", "error").distinct()


def run(
    spark: SparkSession,
    discovered: DataFrame,
    landing: str,
    root: str,
    dataset: str,
    jurisdiction: str,
    file_type: str,
    fields: Mapping[str, str],
    run_time: str,
    force: bool = False,
    excel: Mapping | None = None,
    replace: bool = False,
    landed: DataFrame | None = None,
) -> DataFrame:
    """Load what is discovered and not in the history.

    ``landed`` (``url, path``) says where each address was put; without it, files lie in ``landing`` under their own
    names, and addresses that share one are refused.
    """
    known = history.select_history(
        history.read_history(spark, f"{root.rstrip('/')}/{jurisdiction}"), jurisdiction, dataset
    )
    todo = history.unloaded(discovered, known, force)
    own = F.concat(F.lit(landing.rstrip("/") + "/"), "filename")
    if landed is None:
        located = todo.withColumn("path", own)
    else:
        located = todo.join(landed.select("url", "path"), "url", "left").withColumn("path", F.coalesce("path", own))
    return load_files(spark, located, root, dataset, jurisdiction, file_type, fields, run_time, excel, replace)
