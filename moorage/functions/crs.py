"""Coordinate reference and geometry type labels of the metadata registry."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Service geometry type -> stored geometry type.
GEOMETRY_TYPES = {
    "esriGeometryPoint": "Point",
    "esriGeometryMultipoint": "MultiPoint",
    "esriGeometryPolyline": "MultiLineString",
    "esriGeometryPolygon": "Polygon",
}


def geometry_type_label(service_type: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for x in chain.from_iterable(GEOMETRY_TYPES.items())])
    return F.coalesce(labels[service_type], service_type)


def crs_label(epsg: Column, wkid: Column, wkt: Column) -> Column:
    """EPSG code if known, else the service's own id read as EPSG, else the WKT; 0 and '' are unknown."""
    known = [F.nullif(epsg, F.lit(0)), F.nullif(wkid, F.lit(0))]
    return F.coalesce(*[F.concat(F.lit("EPSG:"), c.cast("string")) for c in known], F.nullif(wkt, F.lit("")))


def service_url(layer_url: Column) -> Column:
    return F.replace(F.rtrim(layer_url, F.lit("/")), F.lit("/query"), F.lit(""))
