"""Geometry jobs: source geometry -> WKB, WKB -> coordinates, extents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.functions import wkb

_NESTING = {1: "array<double>", 2: "array<array<double>>", 3: "array<array<array<double>>>"}

# GeoJSON type -> (WKB kind, list levels of its coordinates).
_GEOJSON_KINDS = {
    "Point": (wkb.POINT, 1),
    "LineString": (wkb.LINE, 2),
    "Polygon": (wkb.POLYGON, 3),
    "MultiPoint": (wkb.MULTI_POINT, 2),
    "MultiLineString": (wkb.MULTI_LINE, 3),
    "MultiPolygon": (wkb.MULTI_POLYGON, 4),
}


def _coords(col: Column) -> Column:
    return col.cast(wkb.COORDS)


def _wrap(levels: int, col: Column) -> Column:
    for _ in range(4 - levels):
        col = F.array(col)
    return col


def _member(kind: Column | int, coords: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, int) else kind
    return F.struct(kind.cast("int").alias("kind"), _coords(coords).alias("coords"))


def _single(kind: Column | int, coords: Column) -> Column:
    return F.struct(F.lit(False).alias("collection"), F.array(_member(kind, coords)).alias("members"))


def _geojson_member(geometry: Column) -> Column:
    """Kind and coordinates of a simple GeoJSON geometry; kind null for other types."""
    member = None
    for name, (kind, levels) in _GEOJSON_KINDS.items():
        nesting = _NESTING.get(levels, "array<array<array<array<double>>>>")
        parsed = F.from_json(geometry["coordinates"], nesting)
        # JSON that is present but not coordinates must fail, not look empty.
        broken = parsed.isNull() & geometry["coordinates"].isNotNull()
        value = _member(F.when(~broken, F.lit(kind)), _wrap(levels, parsed))
        match = geometry["type"] == name
        member = F.when(match, value) if member is None else member.when(match, value)
    return member.otherwise(_member(F.lit(None), F.lit(None)))


def encode_geojson(geometry: Column) -> Column:
    """``struct<wkb, error>`` of a GeoJSON geometry with raw ``coordinates`` and ``geometries`` text."""
    simple = F.struct(F.lit(False).alias("collection"), F.array(_geojson_member(geometry)).alias("members"))
    parts = F.transform(
        geometry["geometries"],
        lambda g: _geojson_member(F.from_json(g, "type string, coordinates string")),
    )
    whole = F.struct(F.lit(True).alias("collection"), parts.alias("members"))
    return wkb.encode_wkb(
        F.when(geometry["type"] == "GeometryCollection", whole).when(geometry.isNotNull(), simple)
    )


def encode_esri(geometry: Column, geometry_type: Column) -> Column:
    """``struct<wkb, error>`` of a service geometry: first ring outer, other rings holes."""
    polygon = _single(wkb.POLYGON, _wrap(3, geometry["rings"]))
    paths = geometry["paths"]
    line = _single(F.when(F.size(paths) == 1, wkb.LINE).otherwise(wkb.MULTI_LINE), _wrap(3, paths))
    point = _single(wkb.POINT, _wrap(1, F.array(geometry["x"], geometry["y"])))
    known = (
        F.when((geometry_type == "esriGeometryPolygon") & (F.size(geometry["rings"]) > 0), polygon)
        .when((geometry_type == "esriGeometryPolyline") & (F.size(paths) > 0), line)
        .when((geometry_type == "esriGeometryPoint") & geometry["x"].isNotNull() & geometry["y"].isNotNull(), point)
    )
    supported = geometry_type.isin("esriGeometryPolygon", "esriGeometryPolyline", "esriGeometryPoint")
    unsupported = geometry.isNotNull() & ~F.coalesce(supported, F.lit(False))
    return wkb.encode_wkb(F.when(unsupported, _single(0, F.lit(None))).otherwise(known))


def failure_counts(rows: DataFrame, layer: str = "layer") -> DataFrame:
    """Rows and failed geometries per layer and reason."""
    return (
        rows.where(F.col("geometry_error").isNotNull())
        .groupBy(layer, "geometry_error")
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def hex_to_wkb(text: Column) -> Column:
    """Bytes of a WKB hex text; null and empty texts are null."""
    return F.unhex(F.nullif(text, F.lit("")))


def decode_hex(df: DataFrame, column: str = "geometry") -> DataFrame:
    """Adds ``decoded`` (kind and coordinates) and ``decode_error`` for a WKB hex column."""
    text = F.nullif(F.col(column), F.lit(""))
    decoded = df.withColumn("_d", wkb.decode_wkb(F.unhex(text)))
    not_hex = text.isNotNull() & F.unhex(text).isNull()
    return decoded.withColumns(
        {
            "decoded": F.col("_d.geometry"),
            "decode_error": F.when(not_hex, F.lit("not hexadecimal")).otherwise(F.col("_d.error")),
        }
    ).drop("_d")


def extent(df: DataFrame, keys: list[str], binary: Column) -> DataFrame:
    """Bounding box and geometry types per group; groups of any size aggregate partially."""
    boxed = df.withColumn("_b", wkb.wkb_bounds(binary)["box"])
    return boxed.groupBy(*keys).agg(
        F.min("_b.xmin").alias("xmin"),
        F.min("_b.ymin").alias("ymin"),
        F.max("_b.xmax").alias("xmax"),
        F.max("_b.ymax").alias("ymax"),
        F.array_sort(F.collect_set("_b.geometry_type")).alias("geometry_types"),
        F.count("_b.geometry_type").alias("geometries"),
    )
