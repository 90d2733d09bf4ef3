"""GeoParquet below partition folders, published by manifest."""

import json
import os
import struct

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from moorage.sinks import geo_layout


def point(x, y):
    return struct.pack("<BIdd", 1, 1, x, y)


def frame(spark, rows):
    return spark.createDataFrame([(i, bytearray(point(i, -i)) if i % 3 else None, year, kind) for i, year, kind in rows], "id int, geometry binary, year int, kind string")


def stored(folder):
    out = {}
    for place, _, names in os.walk(folder):
        if "/_" not in place:
            for name in names:
                if name.endswith(".parquet") and not name.startswith("."):
                    out.setdefault(os.path.relpath(place, folder), []).append(f"{place}/{name}")
    return out


ROWS = [(i, 2020 + i % 3, ["a b", "x/y=z", None][i % 2 + (i > 20)]) for i in range(24)]


def test_folders_footers_and_rows(spark, folder):
    told = geo_layout.write(frame(spark, ROWS), folder, ["year", "kind"], crs={"name": "local"}).collect()
    assert sum(r.row_count for r in told) == 24 and {r.folder for r in told} == set(stored(folder))
    assert "year=2020/kind=x%2Fy%3Dz" in stored(folder) and f"year=2020/kind={geo_layout.NULL_FOLDER}" in stored(folder)
    found = sorted((r.id, r.year, r.kind) for r in spark.read.parquet(folder).collect())
    assert sorted(found, key=str) == sorted(ROWS, key=str)
    (path,) = stored(folder)["year=2020/kind=a b"]
    footer = json.loads(pq.read_metadata(path).metadata[b"geo"])["columns"]["geometry"]
    assert footer["crs"] == {"name": "local"} and footer["geometry_types"] in (["Point"], [])
    assert pq.read_schema(path).names == ["id", "geometry"]
    assert not [n for n in os.listdir(folder) if n.startswith("_commit")]


def test_modes(spark, folder):
    ids = lambda: sorted(r.id for r in spark.read.parquet(folder).collect())
    geo_layout.write(frame(spark, [(1, 2020, "a"), (2, 2021, "a")]), folder, ["year"])
    geo_layout.write(frame(spark, [(3, 2021, "a")]), folder, ["year"])
    assert ids() == [1, 2, 3]
    geo_layout.write(frame(spark, [(4, 2021, "a"), (5, 2022, "a")]), folder, ["year"], mode="dynamic")
    assert ids() == [1, 4, 5]
    geo_layout.write(frame(spark, [(6, 2020, "a")]), folder, ["year"], mode="overwrite")
    assert ids() == [6] and list(stored(folder)) == ["year=2020"]
    assert geo_layout.write(frame(spark, []), folder, ["year"]).count() == 0 and ids() == [6]
    with pytest.raises(ValueError):
        geo_layout.write(frame(spark, []), folder, ["year"], mode="replace")


def test_without_fields(spark, folder):
    geo_layout.write(frame(spark, ROWS), folder, [])
    assert list(stored(folder)) == ["."] and spark.read.parquet(folder).count() == 24


def test_a_dead_write_leaves_nothing_and_a_half_published_one_is_finished(spark, folder, monkeypatch):
    geo_layout.write(frame(spark, [(1, 2020, "a")]), folder, ["year"])
    broken = frame(spark, [(2, 2020, "a"), (4, 2021, "a")]).withColumn("geometry", F.lit(b"\x01\x63"))
    with pytest.raises(Exception):
        geo_layout.write(broken, folder, ["year"], mode="overwrite")
    assert [r.id for r in spark.read.parquet(folder).collect()] == [1]

    def died(spark, commit):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(geo_layout, "_apply", died)
        with pytest.raises(KeyboardInterrupt):
            geo_layout.write(frame(spark, [(7, 2021, "a"), (8, 2022, "a")]), folder, ["year"], mode="overwrite")
    assert [r.id for r in spark.read.parquet(folder).collect()] == [1]
    # Some files were moved already.
    (commit,) = [n for n in os.listdir(folder) if n.startswith("_commit-") and os.path.exists(f"{folder}/{n}/ready")]
    first = spark.read.parquet(f"{folder}/{commit}/add").first()
    os.makedirs(os.path.dirname(first.final))
    os.rename(first.staged, first.final)
    assert geo_layout.finish(spark, folder) == 1 and geo_layout.finish(spark, folder) == 0
    assert sorted(r.id for r in spark.read.parquet(folder).collect()) == [7, 8]
