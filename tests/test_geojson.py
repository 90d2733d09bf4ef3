"""GeoJSON collections cut out of byte ranges."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from moorage.sources import files, geojson

TEXTS = ["plain", 'quo"te', "back\\slash", "\\\\", 'x\\"', "{[", "]}", '"features":[', "é漢😀", "\\", "line\nbreak", ""]


def collection(draw, many):
    features = [
        {
            "type": "Feature",
            "properties": {"id": i, draw.choice(["a", "b{", 'c"']): draw.choice(TEXTS), "features": draw.choice([[], [{"x": 1}], None])},
            "geometry": draw.choice([None, {"type": "Point", "coordinates": [i, 0.5]}, {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}]),
        }
        for i in range(many)
    ]
    members = [("type", "FeatureCollection"), ("name", 'x"features":['), ("crs", {"features": [{"no": [1]}], "type": "name"}), ("bbox", [0, 0, 1, 1])]
    after = [("other", [{"id": -1}]), ("last", {"features": [{"id": -2}]})]
    draw.shuffle(members)
    return dict([*members, ("features", features), *after]), features


def put(path, data):
    with open(path, "wb") as out:
        out.write(data if isinstance(data, bytes) else data.encode())
    return path


def read(spark, path, size):
    rows = geojson.file_pages(spark, path, size).collect()
    assert sum(r.offset == -1 for r in rows) == len({r.layer for r in rows})
    return sorted((json.loads(r.body)["features"] for r in rows), key=lambda own: own[0]["properties"]["id"] if own else -1)


@pytest.mark.parametrize("size", [64, 333, 5000, 1 << 25])
@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_any_ranges_give_the_same_features(spark, folder, size, style, monkeypatch):
    monkeypatch.setattr(geojson, "READ", 50)
    monkeypatch.setattr(geojson, "PAGE", 400)
    whole, features = collection(random.Random(size), 12 if size == 64 else 60)
    path = put(f"{folder}/c.geojson", json.dumps(whole, **style))
    found = [f for own in read(spark, path, size) for f in own]
    assert sorted(found, key=lambda f: f["properties"]["id"]) == features


def test_a_file_takes_more_than_one_task(spark, folder):
    whole, features = collection(random.Random(1), 3000)
    path = put(f"{folder}/c.geojson", json.dumps(whole))
    sized = files.listing(spark, path).select("path", "length")
    states = geojson.range_states(spark, sized, 20_000)
    assert states.count() > 10
    found = geojson.file_pages(spark, path, 20_000)
    assert found.select(F.spark_partition_id()).distinct().count() > 2
    assert len([f for r in found.collect() for f in json.loads(r.body)["features"]]) == 3000


def test_files_without_features_and_broken_ones(spark, folder):
    put(f"{folder}/none.geojson", '{"type": "FeatureCollection", "features": []}')
    put(f"{folder}/other.geojson", '{"type": "Point", "coordinates": [1, 2]}')
    put(f"{folder}/cut.geojson", '{"features": [{"properties": {"id": 1}}, {"properties": {"i')
    put(f"{folder}/open.geojson", '{"features": [{"properties": {"id": "x}}]}')
    put(f"{folder}/good.geojson.gz", gzip.compress(b'\n {"features" : \t[ {"properties": {"id": 7}} , null]}'))
    found = {}
    for r in geojson.file_pages(spark, folder, 16).collect():
        found.setdefault(r.layer.rsplit("/", 1)[1], []).extend(json.loads(r.body)["features"])
    assert found == {"none.geojson": [], "other.geojson": [], "cut.geojson": [], "open.geojson": [], "good.geojson.gz": [{"properties": {"id": 7}}]}


def test_rows_of_files(spark, folder):
    put(f"{folder}/a.geojson", json.dumps({"features": [{"properties": {"id": i, "n": "x"}, "geometry": {"type": "Point", "coordinates": [1, 2]}} for i in range(5)]}))
    put(f"{folder}/b.geojson", json.dumps({"features": [{"properties": {"id": 9, "m": 0.5}, "geometry": None}]}))
    rows = geojson.read_geojson(spark, folder, keep=["layer"]).collect()
    assert sorted((r.layer[-9:], r.id, r.n, r.m, r.geometry is None) for r in rows) == [("a.geojson", i, "x", None, False) for i in range(5)] + [("b.geojson", 9, None, 0.5, True)]
