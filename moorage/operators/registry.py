"""Spatial metadata registry from landed service documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions import crs

SERVICE = (
    "sourceSpatialReference struct<latestWkid: int, wkid: int, wkt: string>, geometryType string, "
    "extent struct<xmin: double, ymin: double, xmax: double, ymax: double>, hasZ boolean, hasM boolean, _bad string"
)
_TEXT, _INT, _NUM, _BOOL = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
# The registry's columns.
COLUMNS = {
    "dataset_name": _TEXT, "source_url": _TEXT, "non_spatial": _BOOL,
    "crs_epsg": _INT, "crs_wkid": _INT, "crs_wkt": _TEXT,
    "geometry_type": _TEXT, "geometry_column": _TEXT,
    "xmin": _NUM, "ymin": _NUM, "xmax": _NUM, "ymax": _NUM,
    "has_z": _BOOL, "has_m": _BOOL,
    "extracted_at": _TEXT,
    "validation_status": _TEXT, "validation_timestamp": _TEXT, "validation_details": _TEXT,
}


def registry(datasets: DataFrame, documents: DataFrame, run_time: str) -> DataFrame:
    """One row per catalog dataset.

    ``datasets``: ``name, layer_url, non_spatial, geometry_type``; ``documents``: ``service_url, body``.
    Where the document is missing or corrupt the row holds only what the catalog knows.
    """
    parsed = documents.select("service_url", F.from_json("body", SERVICE, {"columnNameOfCorruptRecord": "_bad"}).alias("s"))
    intact = parsed.where(F.col("s._bad").isNull() & F.col("s").isNotNull())
    usable = intact.groupBy("service_url").agg(F.max("s").alias("s"))
    joined = datasets.withColumn("service_url", crs.service_url(F.col("layer_url"))).join(usable, "service_url", "left")
    found = F.col("s").isNotNull()
    values = {
        "dataset_name": F.col("name"),
        "source_url": F.col("layer_url"),
        "non_spatial": F.coalesce("non_spatial", F.lit(False)),
        "crs_epsg": F.col("s.sourceSpatialReference.latestWkid"),
        "crs_wkid": F.col("s.sourceSpatialReference.wkid"),
        "crs_wkt": F.col("s.sourceSpatialReference.wkt"),
        "geometry_type": F.when(found, crs.geometry_type_label(F.nullif(F.col("s.geometryType"), F.lit("")))).otherwise(
            F.col("geometry_type")
        ),
        "geometry_column": F.when(found, F.lit("geometry")),
        **{side: F.col(f"s.extent.{side}") for side in ("xmin", "ymin", "xmax", "ymax")},
        "has_z": F.when(found, F.coalesce("s.hasZ", F.lit(False))),
        "has_m": F.when(found, F.coalesce("s.hasM", F.lit(False))),
        "extracted_at": F.lit(run_time),
    }
    rows = joined.select(
        *[values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in COLUMNS.items()]
    )
    # One row per name; which of several same-named entries stays does not depend on the run.
    rest = [c for c in COLUMNS if c != "dataset_name"]
    single = rows.groupBy("dataset_name").agg(F.min(F.struct(*rest)).alias("r"))
    return single.select("dataset_name", "r.*")


def label(rows: DataFrame) -> DataFrame:
    """Adds the CRS label used when geometry is published."""
    return rows.withColumn("crs", crs.crs_label(F.col("crs_epsg"), F.col("crs_wkid"), F.col("crs_wkt")))
