"""Landed feature pages -> rows.

A page table has ``layer STRING, offset BIGINT, body STRING``: one service response per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.operators import geometry
from moorage.session import settled

PAGE_SIZE = 1000

# What the stop rule needs of a page: features are counted, not read.
PROBE = "features array<struct<_count: int>>, exceededTransferLimit boolean, error string"
GEOJSON_GEOMETRY = "struct<type: string, coordinates: string, geometries: array<string>>"
ESRI_GEOMETRY = (
    "struct<x: double, y: double, rings: array<array<array<double>>>, paths: array<array<array<double>>>>"
)


def page_profile(pages: DataFrame) -> DataFrame:
    """Adds ``n_features``, the service's error text and its transfer-limit flag to every page."""
    probe = F.from_json("body", PROBE)
    return pages.withColumn("_page", probe).select(
        *pages.columns,
        F.coalesce(F.size("_page.features"), F.lit(0)).alias("n_features"),
        F.when(F.col("_page.features").isNull(), F.col("_page.error")).alias("page_error"),
        F.coalesce("_page.exceededTransferLimit", F.lit(False)).alias("limit_exceeded"),
    )


def stop_offsets(profiled: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``layer, stop``: where each layer ends, its first page shorter than ``page_size``.

    Pages with a service error do not count. One partial aggregate, so a layer that holds most pages
    is no hot spot.
    """
    short = F.col("n_features") < page_size
    if "page_error" in profiled.columns:
        short = short & F.col("page_error").isNull()
    # Tested inside the aggregate: as a filter the test would repeat the parsing behind it.
    found = profiled.groupBy("layer").agg(F.min(F.when(short, F.col("offset"))).alias("stop"))
    return found.where(F.col("stop").isNotNull())


def until_stop(pages: DataFrame, stops: DataFrame) -> DataFrame:
    """Pages up to the end of their layer.

    ``stops`` has a row per layer; its size is settled before the join, so that page bodies are
    shuffled only if it is too large to broadcast.
    """
    known = settled(stops, "page-stops")
    joined = pages.join(known, "layer", "left").where(F.col("stop").isNull() | (F.col("offset") <= F.col("stop")))
    return joined.drop("stop")


def stop_rule(profiled: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Profiled pages that count: up to the stop, with features, without an error.

    The first short page is kept if it has features and dropped if it is empty.
    """
    kept = until_stop(profiled, stop_offsets(profiled, page_size)).where(F.col("n_features") > 0)
    return kept.where(F.col("page_error").isNull()) if "page_error" in profiled.columns else kept


def page_warnings(profiled: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Pages whose content means the layer may be incomplete."""
    reason = F.when(F.col("page_error").isNotNull(), F.concat(F.lit("service error: "), "page_error")).when(
        F.col("limit_exceeded") & (F.col("n_features") < page_size), F.lit("short page, but the service has more")
    )
    told = profiled.select("layer", "offset", reason.alias("reason")).where(F.col("reason").isNotNull())
    # Offsets run in steps of a page from 0 to the stop; the profile has a row a page.
    before = F.lag("offset").over(Window.partitionBy("layer").orderBy("offset"))
    steps = until_stop(profiled, stop_offsets(profiled, page_size)).select("layer", "offset").distinct()
    gaps = steps.withColumn("_gap", F.col("offset") - F.coalesce(before, F.lit(-page_size))).where(F.col("_gap") > page_size)
    return told.unionByName(gaps.select("layer", "offset", F.lit("pages before it are missing").alias("reason")))


def _ddl(schema: T.StructType | str) -> str:
    return schema if isinstance(schema, str) else schema.simpleString()[len("struct<") : -1]


def _features(pages: DataFrame, key: str, attributes: T.StructType | str, geometry_type: str, keep: list[str]):
    schema = (
        f"geometryType string, features array<struct<{key}: struct<{_ddl(attributes)}>, geometry: {geometry_type}>>"
    )
    return (
        pages.select(*keep, F.from_json("body", schema).alias("_page"))
        # The outer form keeps Spark from testing the array first, which would parse every page twice.
        .select(*keep, F.col("_page.geometryType").alias("_type"), F.explode_outer("_page.features").alias("_f"))
        .where(F.col("_f").isNotNull())
    )


def _flatten(features: DataFrame, key: str, keep: list[str], encoded: Column) -> DataFrame:
    """Attributes as columns; ``geometry`` replaces any attribute of that name."""
    attributes = [n for n in features.schema["_f"].dataType[key].dataType.names if n != "geometry"]
    return (
        features.withColumn("_wkb", encoded)
        .select(
            *keep,
            *[F.col("_f")[key][n].alias(n) for n in attributes],
            F.hex("_wkb.wkb").alias("geometry"),
            F.col("_wkb.error").alias("geometry_error"),
        )
    )


def geojson_rows(pages: DataFrame, attributes: T.StructType | str, keep: list[str] | None = None) -> DataFrame:
    """Rows of GeoJSON pages; geometry as upper-case WKB hex, null plus ``geometry_error`` on failure."""
    keep = keep or []
    features = _features(pages, "properties", attributes, GEOJSON_GEOMETRY, keep)
    return _flatten(features, "properties", keep, geometry.encode_geojson(F.col("_f.geometry")))


def esri_rows(pages: DataFrame, attributes: T.StructType | str, keep: list[str] | None = None) -> DataFrame:
    """Rows of service-JSON pages; the page's geometry type applies to all its features."""
    keep = keep or []
    features = _features(pages, "attributes", attributes, ESRI_GEOMETRY, keep)
    return _flatten(features, "attributes", keep, geometry.encode_esri(F.col("_f.geometry"), F.col("_type")))


def raw_rows(pages: DataFrame, key: str, attributes: T.StructType | str, keep: list[str] | None = None) -> DataFrame:
    """As above without conversion: ``geometry`` stays the JSON text of the source."""
    keep = keep or []
    features = _features(pages, key, attributes, "string", keep)
    names = [n for n in features.schema["_f"].dataType[key].dataType.names if n != "geometry"]
    return features.select(*keep, *[F.col("_f")[key][n].alias(n) for n in names], F.col("_f.geometry").alias("geometry"))


def infer_attributes(pages: DataFrame, key: str) -> T.StructType:
    """Attribute schema when none is declared: one merge pass over all pages, no data collected."""
    merged = (
        pages.select(F.explode(F.from_json("body", f"features array<struct<{key}: variant>>")["features"]).alias("f"))
        .agg(F.expr(f"schema_of_variant_agg(f.{key})").alias("s"))
        .first()["s"]
    )
    return schema_of(merged or "OBJECT<>")


def schema_of(variant_schema: str) -> T.StructType:
    """Struct type of a merged variant schema; members without any value or of mixed kinds are text."""
    ddl = variant_schema.removeprefix("OBJECT<").removesuffix(">")
    if not ddl:
        return T.StructType()
    ddl = re.sub(r"\bDECIMAL\(\d+, ?\d+\)|\bFLOAT\b", "DOUBLE", re.sub(r"\b(VOID|VARIANT)\b", "STRING", ddl))
    return T.StructType.fromDDL(ddl.replace("OBJECT<", "STRUCT<"))
