import json
import os
import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from moorage.functions.paths import relayout_path
from moorage.plans.registered.files import _workbook
from moorage.sinks import convert, finalize, footers, geoparquet, relayout, tables
from moorage.sources import files, parquet

HEX = struct.pack("<BIdd", 1, 1, 1.0, 2.0).hex().upper()
HEX_Z = struct.pack("<BIddd", 1, 0x80000001, 5.0, 6.0, 7.0).hex().upper()
CRS = {"type": "ProjectedCRS", "name": "Local", "id": {"authority": "EPSG", "code": 8193}, "coordinate_system": {"axis": [{"unit": {"name": "US survey foot"}}]}}


def parts(path):
    return sorted(f"{d}/{n}" for d, _, names in os.walk(path) for n in names if n.endswith(".parquet"))


def test_snapshot_keeps_other_years(spark, folder):
    df = spark.createDataFrame([(1, 2023), (2, 2024), (3, 2024)], "id int, year int")
    tables.snapshot(df, folder + "/t")
    tables.snapshot(df.where("id = 3"), folder + "/t")
    assert sorted(map(tuple, spark.read.parquet(folder + "/t").collect())) == [(1, 2023), (3, 2024)]


def test_layout_order_append_and_replace(spark, folder):
    df = spark.createDataFrame([(1, "2024", "01")], "id int, year string, month string")
    tables.append(df, folder + "/t", ["year", "month"])
    tables.append(df, folder + "/t", ["year", "month"])
    assert all("/year=2024/month=01/" in p for p in parts(folder + "/t"))
    assert spark.read.parquet(folder + "/t").count() == 2
    tables.replace(df, folder + "/r")
    tables.replace(df, folder + "/r")
    assert spark.read.parquet(folder + "/r").count() == 1


def test_partition_values_replace_columns(spark):
    df = spark.createDataFrame([("old", "/x/2024taxroll.csv"), ("old", "/x/none.csv")], "year string, source_file string")
    assert [r.year for r in tables.partitions_from_file_name(df, {"year": r"\d{4}"}).collect()] == ["2024", None]


def test_has_data_and_swap(spark, folder):
    assert not files.has_data(spark, folder + "/no")
    os.makedirs(folder + "/empty")
    assert not files.has_data(spark, folder + "/empty")
    for name, n in (("old", 1), ("new", 2)):
        spark.range(n).write.parquet(f"{folder}/{name}")
    files.swap_in(spark, f"{folder}/new", f"{folder}/old")
    assert spark.read.parquet(f"{folder}/old").count() == 2 and sorted(os.listdir(folder)) == ["empty", "old"]


def test_geoparquet_footer_and_modes(spark, folder):
    df = spark.createDataFrame([(1, HEX), (2, HEX_Z), (3, None)], "id int, geometry string")
    geoparquet.write(df.coalesce(1), folder + "/g", crs=CRS)
    (name,) = parts(folder + "/g")
    geo = json.loads(pq.ParquetFile(name).schema_arrow.metadata[b"geo"])
    column = geo["columns"]["geometry"]
    assert geo["primary_column"] == "geometry" and column["encoding"] == "WKB" and column["crs"] == CRS
    assert column["geometry_types"] == ["Point", "Point Z"] and column["bbox"] == [1.0, 2.0, 5.0, 6.0]
    rows = {r.id: r.geometry for r in spark.read.parquet(folder + "/g").collect()}
    assert rows[2] == bytearray(struct.pack("<BIddd", 1, 1001, 5.0, 6.0, 7.0)) and rows[3] is None
    assert os.listdir(folder + "/g") and not [n for n in os.listdir(folder + "/g") if n.startswith("_staging")]
    geoparquet.write(df, folder + "/g")
    assert spark.read.parquet(folder + "/g").count() == 6
    geoparquet.write(df, folder + "/g", mode="overwrite")
    assert spark.read.parquet(folder + "/g").count() == 3
    without = json.loads(pq.ParquetFile(parts(folder + "/g")[0]).schema_arrow.metadata[b"geo"])
    assert without["columns"]["geometry"]["crs"] is None


def test_failed_geoparquet_write_leaves_nothing(spark, folder):
    df = spark.createDataFrame([(1, HEX), (2, "zz")], "id int, geometry string")
    geoparquet.write(df.where("id = 1"), folder + "/g")
    with pytest.raises(Exception):
        geoparquet.write(df, folder + "/g")
    assert spark.read.parquet(folder + "/g").count() == 1 and len(os.listdir(folder + "/g")) == len(parts(folder + "/g"))


def test_footer_audit(spark, folder):
    df = spark.createDataFrame([(1, HEX)], "id int, geometry string")
    geoparquet.write(df.coalesce(1), folder + "/g", crs=CRS)
    df.coalesce(1).write.parquet(folder + "/p")
    with open(folder + "/broken.parquet", "w") as out:
        out.write("no parquet")
    audited = footers.footer_audit(files.listing(spark, folder, "*.parquet"))
    rows = {r.path.split("/")[-2] if "/g/" in r.path or "/p/" in r.path else "broken": r for r in audited.collect()}
    g, p = rows["g"], rows["p"]
    assert (g.crs_id, g.crs_name, g.crs_units, g.geometry_types, g.bbox) == ("EPSG:8193", "Local", "US survey foot", ["Point"], [1.0, 2.0, 1.0, 2.0])
    assert g.file_bytes > g.footer_bytes > 0 and (g.num_rows, g.num_columns, g.row_groups) == (1, 2, 1)
    assert p.has_geo is False and "org.apache.spark.version" in p.other_keys
    assert all(len(v) < 220 for v in p.other_keys.values())
    assert rows["broken"].error
    assert footers.totals(audited).first().rows == 2


def registry_frame(spark, *rows):
    schema = "dataset_name string, non_spatial boolean, crs_epsg int, crs_wkid int, crs_wkt string, geometry_column string"
    return spark.createDataFrame(rows, schema)


def test_finalize_in_place_and_again(spark, folder):
    root = folder + "/j"
    df = spark.createDataFrame([(1, HEX), (2, "")], "id int, geometry string")
    df.coalesce(1).write.parquet(f"{root}/parcels/year=2025")
    df.drop("geometry").coalesce(1).write.parquet(f"{root}/plain/year=2025")
    df.coalesce(1).write.parquet(f"{root}/roll/year=2025")
    entries = registry_frame(
        spark, ("parcels", None, 8193, None, None, None), ("plain", False, 8193, None, None, None), ("roll", True, None, None, None, None), ("gone", False, 1, None, None, None)
    )
    for run in range(2):
        rows = finalize.finalize(spark, root, entries, f"{folder}/log{run}", projjson={"EPSG:8193": CRS}).collect()
        got = {r.dataset_name: r.status for r in rows}
        assert got == {"parcels": "already_published" if run else "converted", "plain": "error", "roll": "skipped_non_spatial", "gone": "skipped_no_files"}
    stored = spark.read.parquet(f"{root}/parcels").orderBy("id").collect()
    assert stored[0].geometry == bytearray(bytes.fromhex(HEX)) and stored[1].geometry is None and stored[0].year == 2025
    assert b"geo" in pq.ParquetFile(parts(f"{root}/parcels")[0]).schema_arrow.metadata
    assert spark.read.parquet(f"{root}/roll").first().geometry == HEX


def test_finalize_to_other_tree(spark, folder):
    root = folder + "/raw"
    spark.createDataFrame([(1, HEX)], "id int, geometry string").write.parquet(f"{root}/parcels")
    entries = registry_frame(spark, ("parcels", False, None, 102100, None, None))
    finalize.finalize(spark, root, entries, folder + "/log", target=folder + "/published", datasets=["parcels"])
    assert spark.read.parquet(f"{root}/parcels").first().geometry == HEX
    assert parts(folder + "/published/parcels")


def test_drifted_and_dictionary_schemas(spark, folder):
    os.makedirs(folder + "/year=2024")
    pq.write_table(pa.table({"id": pa.array([1], pa.int32()), "v": pa.array(["a"]).dictionary_encode()}), folder + "/year=2024/a.parquet")
    pq.write_table(pa.table({"id": pa.array([2], pa.int64()), "v": pa.array(["b"]), "w": pa.array([0.5])}), folder + "/b.parquet")
    df = parquet.read_normalized(spark, folder)
    assert dict(df.dtypes) == {"id": "bigint", "v": "string", "w": "double"}
    assert sorted(map(tuple, df.select("id", "v").collect())) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize(
    "path, hive, dated, want",
    [
        ("202001CSV.parquet", True, True, "p/year=2020/month=01/CSV.parquet"),
        ("a/202012CSV.parquet", False, True, "p/a/2020/12/CSV.parquet"),
        ("202001.parquet", True, True, "p/year=2020/month=01/202001.parquet"),
        ("202001", True, True, "p/year=2020/month=01/202001"),
        ("202013CSV.parquet", True, True, "p/202013CSV.parquet"),
        ("202000CSV.parquet", True, True, "p/202000CSV.parquet"),
        ("2020/x.parquet", True, True, "p/year=2020/x.parquet"),
        ("2020/x.parquet", False, True, "p/2020/x.parquet"),
        ("2020/202101x.parquet", True, True, "p/2020/year=2021/month=01/x.parquet"),
        ("2020/202101x.parquet", True, False, "p/year=2020/202101x.parquet"),
        ("20201/x.parquet", True, False, "p/20201/x.parquet"),
        ("x.parquet", True, False, "p/x.parquet"),
    ],
)
def test_relayout_rules(spark, path, hive, dated, want):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(relayout_path(F.col("p"), "p", hive, dated).alias("t")).first().t == want


def test_relayout_copies_bytes_and_reports_clashes(spark, folder):
    for name in ("a/202001x.parquet", "2020/01/x.parquet", "2021/y.parquet"):
        os.makedirs(os.path.dirname(f"{folder}/in/{name}"), exist_ok=True)
        with open(f"{folder}/in/{name}", "w") as out:
            out.write(name)
    mapped = relayout.mapping(spark, folder + "/in", folder + "/out", hive=True, by_file_date=True)
    assert mapped.count() == 3 and not os.path.exists(folder + "/out")
    done = relayout.relayout(mapped, folder + "/log")
    assert {r.status: r.n for r in relayout.summary(done).collect()} == {"copied": 3}
    with open(folder + "/out/a/year=2020/month=01/x.parquet") as got:
        assert got.read() == "a/202001x.parquet"
    clash = mapped.withColumn("target", F.lit(folder + "/out/same.parquet"))
    assert {r.status: r.n for r in relayout.summary(relayout.relayout(clash, folder + "/log2")).collect()} == {"error": 3}


def test_convert_directory(spark, folder):
    root = folder + "/in"
    os.makedirs(root + "/sub")
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    feature = lambda i, g: {"type": "Feature", "properties": {"id": i}, "geometry": g}
    collection = {"type": "FeatureCollection", "features": [feature(1, {"type": "Polygon", "coordinates": [ring]}), feature(2, None)]}
    texts = {
        "My Data.csv": "id,amount\n1,2.5\n2,NA\n", "sub/other.csv": "id,amount\n1,x\n", "empty.csv": "a,b\n", "long.csv": "a,b\n1,2,3\n",
        "tab.txt": "a\tb\n1\tx\n", "shape.geojson": json.dumps(collection), "same.csv": "a\n1\n", "same.txt": "a\n1\n", "note.md": "no", "blank.csv": "\n",
    }
    for name, text in texts.items():
        with open(f"{root}/{name}", "w") as out:
            out.write(text)
    with open(root + "/sheet.xlsx", "wb") as out:
        out.write(_workbook([["title"], ["Col A", "b", "c"], ["1", "2", "3"]]))
    with open(root + "/bad.xlsx", "wb") as out:
        out.write(b"no workbook")
    first = convert.convert_directory(spark, root, folder + "/log1")
    got = {r.path.split("/in/")[1]: (r.status, r.error) for r in first.collect()}
    status = {k: v[0] for k, v in got.items()}
    assert status == {
        "My Data.csv": "converted", "sub/other.csv": "converted", "empty.csv": "converted", "long.csv": "errored", "tab.txt": "converted",
        "shape.geojson": "converted", "same.csv": "errored", "same.txt": "errored", "sheet.xlsx": "converted", "bad.xlsx": "errored", "blank.csv": "errored",
    }, got
    typed = spark.read.parquet(root + "/my_data.parquet")
    assert dict(typed.dtypes) == {"id": "bigint", "amount": "double"} and typed.count() == 2
    assert dict(spark.read.parquet(root + "/sub/other.parquet").dtypes)["amount"] == "string"
    assert spark.read.parquet(root + "/sheet.parquet").columns == ["Col A", "b", "c"]
    assert spark.read.parquet(root + "/empty.parquet").count() == 0
    shape = spark.read.parquet(root + "/shape.parquet")
    assert shape.where("geometry is not null").count() == 1 and b"geo" in pq.ParquetFile(parts(root + "/shape.parquet")[0]).schema_arrow.metadata
    again = convert.convert_directory(spark, root, folder + "/log2")
    assert {r.status: r.n for r in convert.summary(again).collect()} == {"skipped": 6, "errored": 5}
    forced = convert.convert_directory(spark, root, folder + "/log3", force=True)
    assert {r.status: r.n for r in convert.summary(forced).collect()} == {"converted": 6, "errored": 5}
