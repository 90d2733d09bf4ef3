import json

from pyspark.sql import functions as F

from moorage.functions import wkb
from moorage.operators import geometry
from moorage.sources import pages


def landed(spark, *bodies, layer="a", size=2):
    rows = [(layer, i * size, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "layer string, offset bigint, body string")


def geo(shape, **properties):
    return {"type": "Feature", "properties": properties, "geometry": shape}


def page(n, **extra):
    return {"features": [geo(None, id=i) for i in range(n)], **extra}


def kept(spark, *bodies):
    rows = pages.stop_rule(pages.page_profile(landed(spark, *bodies)), 2)
    return sorted(r.offset for r in rows.collect())


def test_stop_rule(spark):
    assert kept(spark, page(2), page(2)) == [0, 2]
    assert kept(spark, page(2), page(1), page(2)) == [0, 2]
    assert kept(spark, page(2), page(0), page(2)) == [0]
    assert kept(spark, {"features": None}) == []


def test_error_page_neither_stops_nor_loads(spark):
    bodies = [page(2), {"error": {"code": 500, "message": "busy"}}, page(2), page(1, exceededTransferLimit=True)]
    assert kept(spark, *bodies) == [0, 4, 6]
    warned = pages.page_warnings(pages.page_profile(landed(spark, *bodies)), 2).orderBy("offset").collect()
    assert [r.offset for r in warned] == [2, 6]
    assert "busy" in warned[0].reason and "more" in warned[1].reason


def test_geojson_types_and_geometry_override(spark):
    ring = [[0, 0], [2, 0], [2, 2], [0, 0]]
    shapes = [
        {"type": "Point", "coordinates": [1, 2]},
        {"type": "LineString", "coordinates": [[1, 2], [3, 4]]},
        {"type": "Polygon", "coordinates": [ring]},
        {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]},
        {"type": "MultiLineString", "coordinates": [[[1, 2], [3, 4]]]},
        {"type": "MultiPolygon", "coordinates": [[ring], [ring]]},
        {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2, 3]}]},
        {"type": "Point", "coordinates": []},
        {"type": "Point", "coordinates": "here"},
        {"type": "Circle", "coordinates": [1, 2]},
        None,
    ]
    body = {"features": [geo(s, id=i, geometry="hidden") for i, s in enumerate(shapes)]}
    rows = pages.geojson_rows(landed(spark, body), "id int, geometry string").orderBy("id").collect()
    names = [wkb.bounds(bytes.fromhex(r.geometry))[0] if r.geometry else None for r in rows]
    assert names == [
        "Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection Z", None, None, None, None
    ]
    assert [bool(r.geometry_error) for r in rows] == [False] * 8 + [True, True, False]
    assert rows[0].geometry == rows[0].geometry.upper()


def test_esri_shapes(spark):
    def rows(kind, *shapes):
        body = {"geometryType": kind, "features": [{"attributes": {"id": i}, "geometry": s} for i, s in enumerate(shapes)]}
        return pages.esri_rows(landed(spark, body), "id int").orderBy("id").collect()

    outer, hole = [[0, 0], [9, 0], [9, 9], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]
    got = rows("esriGeometryPolygon", {"rings": [outer, hole]}, {"rings": []}, None, {"curveRings": []})
    assert wkb.decode(bytes.fromhex(got[0].geometry))["members"][0]["kind"] == wkb.POLYGON
    assert len(wkb.decode(bytes.fromhex(got[0].geometry))["members"][0]["coords"][0]) == 2
    assert [(r.geometry, r.geometry_error) for r in got[1:]] == [(None, None)] * 3
    got = rows("esriGeometryPolyline", {"paths": [outer]}, {"paths": [outer, hole]})
    assert [wkb.bounds(bytes.fromhex(r.geometry))[0] for r in got] == ["LineString", "MultiLineString"]
    got = rows("esriGeometryPoint", {"x": 1.5, "y": 2.5}, {"x": None, "y": 2.5}, {"x": 1.0})
    assert [bool(r.geometry) for r in got] == [True, False, False]
    (got,) = rows("esriGeometryMultipoint", {"points": [[1, 2]]})
    assert (got.geometry, got.geometry_error) == (None, "unsupported geometry type")


def test_failure_counts(spark):
    body = {"features": [geo({"type": "Circle", "coordinates": []}, id=i) for i in range(3)]}
    rows = pages.geojson_rows(landed(spark, body), "id int", keep=["layer"])
    assert [r.failures for r in geometry.failure_counts(rows).collect()] == [3]


def test_inferred_attributes_and_raw_rows(spark):
    body = {"features": [geo({"type": "Point", "coordinates": [1, 2]}, a=1, b="x"), geo(None, a=2.5, c=True)]}
    table = landed(spark, body)
    schema = pages.infer_attributes(table, "properties")
    assert sorted(schema.names) == ["a", "b", "c"]
    rows = pages.raw_rows(table, "properties", schema).orderBy("a").collect()
    assert json.loads(rows[0].geometry) == {"type": "Point", "coordinates": [1, 2]} and rows[1].geometry is None


def test_hex_decode_job(spark):
    rows = spark.createDataFrame(
        [(1, "0101000000000000000000F03F0000000000000040"), (2, ""), (3, None), (4, "xyz"), (5, "0101")], "id int, geometry string"
    )
    got = geometry.decode_hex(rows).orderBy("id").collect()
    assert got[0].decoded.members[0].coords == [[[[1.0, 2.0]]]]
    assert [r.decoded for r in got[1:]] == [None] * 4
    assert [bool(r.decode_error) for r in got] == [False, False, False, True, True]
    ext = geometry.extent(rows.where("id < 4"), [], geometry.hex_to_wkb(F.col("geometry"))).first()
    assert (ext.xmin, ext.ymax, ext.geometry_types, ext.geometries) == (1.0, 2.0, ["Point"], 1)
