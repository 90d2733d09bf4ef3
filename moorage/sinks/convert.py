"""Converting a directory of delimited, GeoJSON and Excel files to Parquet, one output per input file.

Files are not converted one by one: those that share a header and column types are read by one scan
and written by one job, partitioned by file, so the number of jobs follows the number of schemas.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.names import extension, parquet_target
from moorage.operators import headers, inference
from moorage.session import settled, workspace
from moorage.sinks.finalize import OUTCOME as PUBLISHED
from moorage.sinks.finalize import publish_batches
from moorage.sources import delimited, files, geojson, pages, workbook

OUTCOME = T.StructType()
for _name, _kind in {
    "path": T.StringType(), "target": T.StringType(), "status": T.StringType(), "error": T.StringType(),
}.items():
    OUTCOME = OUTCOME.add(_name, _kind)

# longitude/latitude as PROJJSON, the CRS of every GeoJSON file.
CRS84 = {
    "$schema": "https://proj.org/schemas/v0.7/projjson.schema.json",
    "type": "GeographicCRS",
    "name": "WGS 84 (CRS84)",
    "datum_ensemble": {
        "name": "World Geodetic System 1984 ensemble",
        "members": [{"name": "World Geodetic System 1984 (Transit)"}, {"name": "World Geodetic System 1984 (G2139)"}],
        "ellipsoid": {"name": "WGS 84", "semi_major_axis": 6378137, "inverse_flattening": 298.257223563},
        "accuracy": "2.0",
    },
    "coordinate_system": {
        "subtype": "ellipsoidal",
        "axis": [
            {"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"},
            {"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"},
        ],
    },
    "id": {"authority": "OGC", "code": "CRS84"},
}


# Formats that are read, and those that are reported as errors.
READ, UNREAD = ("csv", "tsv", "txt", "geojson", "xlsx"), ("xls", "shp")


@dataclass
class _Batch:
    """Rows of several files with one schema, and the files they stand for."""

    rows: DataFrame
    file: str
    paths: list[str]
    spatial: bool = False


def plan(spark: SparkSession, root: str, force: bool = False) -> DataFrame:
    """``path, ext, target, status, error`` of every convertible file below ``root``."""
    listed = files.every_file(spark, root)
    done = listed.select(F.regexp_extract("path", r"^(.*?\.parquet)(/|$)", 1).alias("target")).where("target != ''").distinct()
    sources = listed.where(~F.col("path").rlike(r"\.parquet(/|$)")).select(
        "path", "length", extension(F.col("path")).alias("ext"), parquet_target(F.col("path")).alias("target")
    )
    sources = sources.where(F.col("ext").isin(*READ, *UNREAD))
    shared = sources.groupBy("target").agg((F.count(F.lit(1)) > 1).alias("clash"))
    joined = sources.join(shared, "target").join(done.withColumn("exists", F.lit(True)), "target", "left")
    status = (
        F.when(F.col("clash") | F.col("ext").isin(*UNREAD), "errored")
        .when(F.coalesce("exists", F.lit(False)) & F.lit(not force), "skipped")
        .otherwise("ready")
    )
    status = F.when((status == "ready") & (F.col("length") == 0), "errored").otherwise(status)
    error = (
        F.when(F.col("clash"), "several files have this target")
        .when(F.col("ext").isin(*UNREAD), "unsupported format")
        .when(status == "errored", "file is empty")
    )
    return joined.select("path", "ext", "target", status.alias("status"), error.alias("error"))


def _names(rows: DataFrame, column: str = "path") -> list[str]:
    return [r[0] for r in rows.select(column).toLocalIterator()]


def _delimited(spark: SparkSession, paths: list[str], separator: str) -> Iterator[_Batch | tuple[str, str]]:
    for group in delimited.file_groups(delimited.profile(spark, paths, separator)):
        raw = delimited.read_group(spark, group, separator, overflow=True)
        columns = [c for c in raw.columns if c not in (delimited.OVERFLOW, "source_file")]
        overlong = F.col(delimited.OVERFLOW).isNotNull() if delimited.OVERFLOW in raw.columns else F.lit(False)
        report = inference.mask_report(raw, columns, ["source_file"], long_rows=F.count_if(overlong))
        by_types: dict[tuple[str, ...], list[str]] = {}
        seen: set[str] = set()
        for row in report.toLocalIterator():
            seen.add(row.source_file)
            if row.long_rows:
                yield row.source_file, f"{row.long_rows} row(s) have more fields than the header"
            else:
                by_types.setdefault(tuple(map(inference.type_of_mask, row.masks)), []).append(row.source_file)
        for types, members in by_types.items():
            part = delimited.FileGroup(group.header, group.encoding, group.multi_line, tuple(members))
            typed = inference.cast_columns(delimited.read_group(spark, part, separator), dict(zip(columns, types)))
            yield _Batch(typed, "source_file", members)
        empty = [p for p in group.paths if p not in seen]
        if empty:
            part = delimited.FileGroup(group.header, group.encoding, group.multi_line, tuple(empty))
            yield _Batch(delimited.read_group(spark, part, separator), "source_file", empty)


def _excel(spark: SparkSession, paths: list[str]) -> Iterator[_Batch | tuple[str, str]]:
    listed = files.listing(spark, [delimited.literal_path(p) for p in paths])
    cells = settled(workbook.excel_cells(listed), "cells")
    good = cells.where(F.col("error").isNull())
    rows = headers.sheet_rows(good)
    failed = cells.where(F.col("error").isNotNull()).select("file", "error").unionByName(
        headers.header_rows(rows).where(F.col("error").isNotNull()).select("file", "error")
    )
    bad = {r.file: r.error for r in failed.toLocalIterator()}
    yield from bad.items()
    for frame in headers.tables(good, normalize=False):
        frame = frame.drop("sheet", "r")
        yield _Batch(frame, "file", _names(frame.select("file").distinct(), "file"))
    seen = {r.file for r in good.select("file").distinct().toLocalIterator()} | set(bad)
    yield from ((p, "no sheet with data") for p in paths if p not in seen)


def _geojson(spark: SparkSession, paths: list[str]) -> Iterator[_Batch | tuple[str, str]]:
    bodies = geojson.file_pages(spark, [delimited.literal_path(p) for p in paths])
    parsed = bodies.select("layer", F.from_json("body", "features array<struct<properties: variant>>")["features"].alias("features"))
    features = parsed.select("layer", F.col("features").isNull().alias("broken"), F.explode_outer("features").alias("f"))
    found = features.groupBy("layer").agg(
        F.expr("schema_of_variant_agg(f.properties)").alias("s"), F.count("f").alias("n"), F.bool_or("broken").alias("broken")
    )
    by_schema: dict[str, list[str]] = {}
    for row in found.toLocalIterator():
        if row.broken:
            yield row.layer, "a feature cannot be read"
        elif row.n:
            by_schema.setdefault(row.s, []).append(row.layer)
        else:
            yield row.layer, "no features"
    for text, members in by_schema.items():
        schema = pages.schema_of(text)
        part = geojson.file_pages(spark, [delimited.literal_path(p) for p in members])
        yield _Batch(pages.geojson_rows(part, schema, ["layer"]).drop("geometry_error"), "layer", members, spatial=True)


def _write(spark: SparkSession, batch: _Batch, target_of: dict[str, str]) -> None:
    """One job for all files of the batch, then one rename per file."""
    staged = workspace(spark, "convert")
    keyed = batch.rows.withColumn("_file", F.md5(batch.file)).drop(*({batch.file} - {"_file"}))
    keyed.hint("rebalance", F.col("_file")).write.partitionBy("_file").parquet(staged)
    if batch.spatial:
        published = workspace(spark, "convert-geo")
        found = files.listing(spark, staged, "*.parquet").select(
            F.lit(None).cast("string").alias("dataset_name"), "path", F.lit("lonlat").alias("crs"),
            F.lit("geometry").alias("geometry_column"), F.lit("ready").alias("status"), F.lit(None).cast("string").alias("error"),
        )
        done = found.mapInArrow(publish_batches({"lonlat": CRS84}, staged, published), PUBLISHED)
        log = settled(done, "convert-log")
        broken = log.where("status = 'error'").select("error").first()
        if broken:
            raise RuntimeError(broken.error)
        staged = published
    for path in batch.paths:
        folder = f"{staged}/_file={hashlib.md5(path.encode()).hexdigest()}"
        target = target_of[path]
        if files.exists(spark, folder):
            files.swap_in(spark, folder, target)
        else:
            keyed.drop("_file").limit(0).write.mode("overwrite").parquet(target)


def convert_directory(spark: SparkSession, root: str, outcomes: str, force: bool = False) -> DataFrame:
    """Convert everything convertible below ``root``; outcome rows are kept in the table ``outcomes``.

    Status is ``converted``, ``skipped`` (the target exists) or ``errored``.
    """
    planned = plan(spark, root, force)
    kept = settled(planned, "plan")
    target_of = {r.path: r.target for r in kept.where("status = 'ready'").toLocalIterator()}
    ready = {k: [] for k in READ}
    for row in kept.where("status = 'ready'").select("path", "ext").toLocalIterator():
        ready[row.ext].append(row.path)
    results: list[tuple] = []

    def run(batches: Iterator[_Batch | tuple[str, str]], paths: list[str]) -> None:
        left = set(paths)
        try:
            for item in batches:
                if isinstance(item, tuple):
                    results.append((item[0], target_of[item[0]], "errored", item[1]))
                    left.discard(item[0])
                    continue
                try:
                    _write(spark, item, target_of)
                    results.extend((p, target_of[p], "converted", None) for p in item.paths)
                except Exception as exc:  # noqa: BLE001 - other files go on
                    results.extend((p, target_of[p], "errored", str(exc)) for p in item.paths)
                left.difference_update(item.paths)
            results.extend((p, target_of[p], "errored", "file has no columns") for p in sorted(left))
        except Exception as exc:  # noqa: BLE001
            results.extend((p, target_of[p], "errored", str(exc)) for p in left)

    for ext, separator in delimited.SEPARATORS.items():
        if ready[ext]:
            run(_delimited(spark, [delimited.literal_path(p) for p in ready[ext]], separator), ready[ext])
    if ready["geojson"]:
        run(_geojson(spark, ready["geojson"]), ready["geojson"])
    if ready["xlsx"]:
        run(_excel(spark, ready["xlsx"]), ready["xlsx"])
    done = spark.createDataFrame(results, OUTCOME)
    idle = kept.where("status != 'ready'").select("path", "target", "status", "error")
    done.unionByName(idle).write.mode("append").parquet(outcomes)
    return spark.read.schema(OUTCOME).parquet(outcomes)


def summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("n"))

