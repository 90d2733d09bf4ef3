"""Publishing all spatial datasets of a registry as GeoParquet, file by file on the executors."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.crs import crs_label
from moorage.functions.names import below
from moorage.sinks.geoparquet import is_published, publish_file
from moorage.sources import files

OUTCOME = (
    T.StructType()
    .add("dataset_name", T.StringType())
    .add("path", T.StringType())
    .add("status", T.StringType())
    .add("row_count", T.LongType())
    .add("error", T.StringType())
)
_ARROW = pa.schema(
    [("dataset_name", pa.string()), ("path", pa.string()), ("status", pa.string()), ("row_count", pa.int64()), ("error", pa.string())]
)


def plan(registry: DataFrame, listed: DataFrame, root: str, requested_crs: int | None = None) -> DataFrame:
    """``dataset_name, path, crs, status, error``: what is to be done with every file of every dataset.

    A dataset without files and a non-spatial one are skipped; a spatial one without a CRS is an error.
    Data fetched in ``requested_crs`` is labelled with it; the registry's own CRS is the fallback.
    """
    named = listed.select("path", F.split(below(F.col("path"), root), "/")[0].alias("dataset_name"))
    known = crs_label(F.col("crs_epsg"), F.col("crs_wkid"), F.col("crs_wkt"))
    label = F.lit(f"EPSG:{requested_crs}") if requested_crs else known
    non_spatial = F.coalesce("non_spatial", F.lit(False))
    wanted = registry.select("dataset_name", label.alias("crs"), non_spatial.alias("non_spatial"), "geometry_column")
    # The listing is the large side, and the only one on which a dataset may have many rows.
    found = named.join(wanted, "dataset_name")
    absent = wanted.join(named.select("dataset_name").distinct(), "dataset_name", "left_anti")
    joined = found.unionByName(absent, allowMissingColumns=True)
    status = (
        F.when(F.col("non_spatial"), "skipped_non_spatial")
        .when(F.col("path").isNull(), "skipped_no_files")
        .when(F.col("crs").isNull(), "error")
        .otherwise("ready")
    )
    planned = joined.withColumn("status", status)
    skipped = planned.where("status = 'skipped_non_spatial'").dropDuplicates(["dataset_name"])
    planned = planned.where("status <> 'skipped_non_spatial'").unionByName(skipped)
    return planned.select(
        "dataset_name",
        F.when(F.col("status").isin("ready", "error"), F.col("path")).alias("path"),
        "crs",
        F.coalesce("geometry_column", F.lit("geometry")).alias("geometry_column"),
        "status",
        F.when(F.col("status") == "error", "no CRS is known for this spatial dataset").alias("error"),
    )


def publish_batches(projjson: dict[str, dict], root: str, target: str, again: bool = False):
    """Task function that publishes planned files from below ``root`` to below ``target``."""

    def one(row: dict) -> dict:
        out = {k: row[k] for k in ("dataset_name", "path", "status", "error")}
        if row["status"] != "ready":
            return out
        to = row["path"].replace(root, target, 1)
        try:
            if root == target and not again and is_published(row["path"]):
                return {**out, "status": "already_published"}
            out["row_count"] = publish_file(row["path"], to, row["geometry_column"], projjson.get(row["crs"]))
            out["status"] = "converted"
        except Exception as exc:  # noqa: BLE001 - a bad file must not stop the others
            out.update(status="error", error=f"{type(exc).__name__}: {exc}")
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([one(row)], schema=_ARROW)

    return run


def finalize(
    spark: SparkSession,
    root: str,
    registry: DataFrame,
    outcomes: str,
    target: str | None = None,
    projjson: Mapping[str, dict] | None = None,
    datasets: list[str] | None = None,
    requested_crs: int | None = None,
    again: bool = False,
) -> DataFrame:
    """Convert every spatial dataset below ``root`` in place, or into ``target``; returns the outcome rows.

    ``projjson`` gives the PROJJSON of CRS labels; a label without one is written as unknown CRS. The
    outcomes are written to the table ``outcomes`` as the work is done, so reading them does not redo it.
    In place, a file that is GeoParquet already stays as it is (``already_published``), with the CRS it was
    published with, unless ``again`` is set: earlier years are neither rewritten nor labelled anew, and a lost
    executor's files can simply be done again.
    """
    if datasets:
        registry = registry.where(F.col("dataset_name").isin(*datasets))
    listed = files.listing(spark, root, "*.parquet")
    work = plan(registry, listed, root, requested_crs)
    run = publish_batches(dict(projjson or {}), root.rstrip("/"), (target or root).rstrip("/"), again)
    files.spread(work).mapInArrow(run, OUTCOME).write.mode("append").parquet(outcomes)
    return spark.read.schema(OUTCOME).parquet(outcomes)

