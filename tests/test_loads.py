"""The whole loads: features into gated snapshots, web files into partitions, files as a stream."""

import json
from decimal import Decimal
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from moorage.operators import discovery, gate, history
from moorage.operators.metrics import Metric
from moorage.plans import feature_load, file_load
from moorage.plans.registered import QUERIES
from moorage.plans.registered.files import _workbook
from moorage.sources import catalog
from moorage.streaming import ingest

CONFIG = {
    "jurisdictions": {
        "town": {
            "crs": 8193,
            "datasets": [
                {
                    "name": "parcels",
                    "layer_url": "https://h/s/0/query",
                    "validation": {"tolerance_percent": 5, "metrics": [{"parquet_column": "total_taxes", "aggregate": "sum", "api_field": "TotalTaxes"}]},
                },
                {"name": "roll", "layer_url": "https://h/s/1/query", "non_spatial": True, "validation": {"enabled": False}},
            ],
        }
    }
}


def landed(spark, n, taxes):
    def bodies(layer, shape):
        for at in range(0, n, 10):
            features = [
                {"attributes": {"OBJECTID": i, "TotalTaxes": taxes}, "geometry": shape and {"x": i, "y": 1.0}} for i in range(at, min(n, at + 10))
            ]
            yield "town", layer, at, json.dumps({"geometryType": "esriGeometryPoint", "features": features})

    rows = [*bodies("parcels", True), *bodies("roll", False)]
    return spark.createDataFrame(rows, "jurisdiction string, layer string, offset bigint, body string")


def documents(spark):
    body = json.dumps({"sourceSpatialReference": {"latestWkid": 3857}, "geometryType": "esriGeometryPoint"})
    return spark.createDataFrame([("https://h/s/0", body)], "service_url string, body string")


def options(root, **more):
    return feature_load.LoadOptions(root=root, year=2025, run_time="2025-03-01T00:00:00", page_size=10, **more)


def load(spark, root, n, taxes, **more):
    return feature_load.run(spark, CONFIG, landed(spark, n, taxes), documents(spark), options(root, **more))


def test_feature_load(spark, folder):
    assert load(spark, folder, 95, 10.0) == {"town/parcels": "loaded", "town/roll": "loaded"}
    stored = spark.read.parquet(f"{folder}/town/parcels")
    assert stored.columns == ["objectid", "total_taxes", "geometry", "year"] and stored.count() == 95
    assert dict(stored.dtypes)["geometry"] == "binary"
    assert dict(spark.read.parquet(f"{folder}/town/roll").dtypes)["geometry"] == "string"

    assert load(spark, folder, 97, 10.1)["town/parcels"] == "loaded"
    assert spark.read.parquet(f"{folder}/town/parcels").count() == 97

    failed = load(spark, folder, 97, 20.0)
    assert failed["town/parcels"].startswith("failed") and failed["town/roll"] == "loaded"
    kept = spark.read.parquet(f"{folder}/town/parcels")
    assert kept.count() == 97 and kept.agg(F.max("total_taxes")).first()[0] == 10.1

    audit = spark.read.parquet(f"{folder}/town/validation_results").collect()
    assert sorted(r.status for r in audit) == ["failed", "no_baseline", "passed"]
    assert {r.dataset_name for r in audit} == {"parcels"}
    registered = spark.read.parquet(f"{folder}/town/spatial_metadata_registry")
    assert {r.dataset_name: r.crs_epsg for r in registered.collect()} == {"parcels": 3857, "roll": None}

    assert load(spark, folder, 97, 20.0, skip_validation=True)["town/parcels"] == "loaded"
    assert spark.read.parquet(f"{folder}/town/parcels").agg(F.max("total_taxes")).first()[0] == 20.0


def test_load_warnings(spark, folder):
    dataset = {"name": "parcels", "layer_url": "https://h/s/0/query"}
    bad = json.dumps({"geometryType": "esriGeometryMultipoint", "features": [{"attributes": {"OBJECTID": 1}, "geometry": {"x": 1}}]})
    rows = [("town", "parcels", 0, json.dumps({"error": {"message": "busy"}})), ("town", "parcels", 10, bad)]
    pages = spark.createDataFrame(rows, "jurisdiction string, layer string, offset bigint, body string")
    with pytest.raises(feature_load.IncompleteError):
        feature_load.load_dataset(spark, pages, "town", 8193, dataset, options(folder + "/refused"))
    feature_load.load_dataset(spark, pages, "town", 8193, dataset, options(folder, allow_incomplete=True))
    assert spark.read.parquet(f"{folder}/town/parcels").count() == 1
    noted = sorted(r.warning for r in spark.read.parquet(f"{folder}/town/load_warnings").collect())
    assert len(noted) == 2 and noted[0].startswith("1 geometries") and "busy" in noted[1]


def test_sampling_load(spark, folder):
    load(spark, folder, 95, 1.0, max_records=7)
    assert spark.read.parquet(f"{folder}/town/parcels").count() == 7


def test_sampling_behind_an_error_page(spark, folder):
    def body(at):
        return json.dumps({"features": [{"attributes": {"OBJECTID": i}, "geometry": None} for i in range(at, at + 10)]})

    rows = [("town", "roll", 0, json.dumps({"error": {"message": "busy"}})), ("town", "roll", 10, body(10)), ("town", "roll", 20, body(20))]
    pages = spark.createDataFrame(rows, "jurisdiction string, layer string, offset bigint, body string")
    dataset = CONFIG["jurisdictions"]["town"]["datasets"][1]
    feature_load.load_dataset(spark, pages, "town", 8193, dataset, options(folder, max_records=10))
    assert sorted(r.objectid for r in spark.read.parquet(f"{folder}/town/roll").collect()) == list(range(10, 20))


def test_gaps_and_other_errors_do_not_stop_the_rest(spark, folder):
    pages = landed(spark, 95, 1.0)
    gap = pages.where("layer = 'roll' or offset <> 30")
    found = feature_load.run(spark, CONFIG, gap, documents(spark), options(folder))
    assert "missing" in found["town/parcels"] and found["town/roll"] == "loaded"
    twice = json.dumps({"features": [{"attributes": {"AbId": 1, "ab_id": 2, "TotalTaxes": 1.0}, "geometry": None}]})
    rows = spark.createDataFrame([("town", "parcels", 0, twice)], pages.schema)
    found = feature_load.run(spark, CONFIG, rows.unionByName(pages.where("layer = 'roll'")), documents(spark), options(folder + "/b"))
    assert found == {"town/parcels": "loaded", "town/roll": "loaded"}
    assert spark.read.parquet(f"{folder}/b/town/parcels").columns[:2] != ["ab_id", "ab_id"]


def test_latest_baseline(spark, folder):
    load(spark, folder, 50, 1.0)
    later = feature_load.LoadOptions(root=folder, year=2026, run_time="t", page_size=10, baseline="latest")
    dataset = CONFIG["jurisdictions"]["town"]["datasets"][0]
    pages = landed(spark, 90, 1.0).where("layer = 'parcels'")
    with pytest.raises(gate.GateError):
        feature_load.load_dataset(spark, pages, "town", 8193, dataset, later)
    assert spark.read.parquet(f"{folder}/town/parcels").count() == 50


def test_catalog_from_config(spark):
    rows = catalog.explode_datasets(catalog.from_config(spark, CONFIG)).orderBy("name")
    assert [(r.jurisdiction, r.crs, r.name, r.non_spatial) for r in rows.collect()] == [("town", 8193, "parcels", None), ("town", 8193, "roll", True)]
    gated = rows.select("name", catalog.gate_enabled().alias("g")).collect()
    assert {r.name: r.g for r in gated} == {"parcels": True, "roll": False}
    assert catalog.only(rows, ["roll"]).count() == 1 and catalog.only(rows, None).count() == 2
    assert catalog.by_jurisdiction(rows).first().n_non_spatial == 1


def put(folder, name, data):
    with open(f"{folder}/{name}", "wb") as out:
        out.write(data if isinstance(data, bytes) else data.encode())


def run_files(spark, landing, root, names, kind, **more):
    found = discovery.manifest(spark.createDataFrame([(f"https://h/{n}",) for n in names], "url string"), [], {"year": r"\d{4}"})
    return file_load.run(spark, found, landing, root, "tax_roll", "town", kind, {"year": r"\d{4}"}, "2025-01-01T00:00:00", **more)


def test_file_load_is_incremental_and_skips_bad_files(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    put(landing, "2023taxroll.csv", "Parcel ID,Tax-Total\n1,2.5\n2,NA\n")
    put(landing, "2024taxroll.csv", "Parcel ID,Tax-Total\n3,4\n")
    put(landing, "2022taxroll.csv", "Parcel ID,Tax-Total\n3,4,5\n")
    put(landing, "2021taxroll.csv", "")
    names = ["2021taxroll.csv", "2022taxroll.csv", "2023taxroll.csv", "2024taxroll.csv"]
    bad = run_files(spark, landing, root, names, "csv").collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in bad) == ["2021taxroll.csv", "2022taxroll.csv"]
    stored = spark.read.parquet(f"{root}/town/tax_roll")
    assert sorted(map(tuple, stored.collect())) == [(1, 2.5, 2023), (2, None, 2023), (3, 4.0, 2024)]
    past = {r.filename: r for r in history.read_history(spark, f"{root}/town").collect()}
    assert {n: r.row_count for n, r in past.items()} == {"2023taxroll.csv": 2, "2024taxroll.csv": 1}
    assert past["2024taxroll.csv"].partition_values == '{"year":"2024"}' and len(past["2024taxroll.csv"].file_hash) == 32

    put(landing, "2025taxroll.csv", "Parcel ID,Tax-Total\n9,9\n")
    put(landing, "2022taxroll.csv", "Parcel ID,Tax-Total\n3,4\n")
    run_files(spark, landing, root, [*names, "2025taxroll.csv"], "csv")
    assert spark.read.parquet(f"{root}/town/tax_roll").count() == 5
    run_files(spark, landing, root, ["2025taxroll.csv"], "csv", force=True)
    assert spark.read.parquet(f"{root}/town/tax_roll").count() == 6
    run_files(spark, landing, root, ["2025taxroll.csv"], "csv", force=True, replace=True)
    assert spark.read.parquet(f"{root}/town/tax_roll").count() == 5
    put(landing, "2026taxroll.csv", "Parcel ID,Tax-Total\nabc,9\n")
    put(landing, "2027taxroll.csv", "Parcel ID,Tax-Total\n11,\n")
    bad = run_files(spark, landing, root, ["2026taxroll.csv", "2027taxroll.csv"], "csv").collect()
    assert [(r.path.rsplit("/", 1)[1], "parcel_id" in r.error) for r in bad] == [("2026taxroll.csv", True)]
    assert spark.read.parquet(f"{root}/town/tax_roll").where("year = 2027").first().tax_total is None


def test_an_address_landed_twice_is_refused(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / f"{name}.csv").write_text("a\n1\n")
    (tmp_path / "three.csv").write_text("a\n3\n")
    todo = spark.createDataFrame(
        [("https://x.org/2024.csv", "2024.csv", {"year": "2024"}, f"{tmp_path}/{n}.csv") for n in ("one", "two")]
        + [("https://x.org/2023.csv", "2023.csv", {"year": "2023"}, f"{tmp_path}/three.csv")],
        "url string, filename string, partition_values map<string,string>, path string",
    )
    bad = file_load.load_files(spark, todo, f"{tmp_path}/out", "d", "town", "csv", {"year": r"\d{4}"}, "2025-01-01").collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.error) for r in bad) == [(f"{n}.csv", "address is landed several times") for n in ("one", "two")]
    assert [r.a for r in spark.read.parquet(f"{tmp_path}/out/town/d").collect()] == [3]


def test_files_are_neither_lost_nor_in_the_way(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    put(landing, "2023r.csv", "a,b\n1,2\n")
    put(landing, "2024r.csv", "a,b\n")
    put(landing, "2025r.csv", "a,b\n5,6\n")
    put(landing, "2026r.csv", "")
    names = ["2023r.csv", "2024r.csv", "north/2025r.csv", "south/2025r.csv", "2026r.csv", "2027r.csv"]
    bad = {r.path.rsplit("/", 1)[1]: r.error for r in run_files(spark, landing, root, names, "csv").collect()}
    assert bad == {"2025r.csv": "several addresses have this file name", "2026r.csv": "file has no columns", "2027r.csv": "file is not landed"}
    assert [tuple(r) for r in spark.read.parquet(f"{root}/town/tax_roll").collect()] == [(1, 2, 2023)]
    past = {r.filename: r.row_count for r in history.read_history(spark, f"{root}/town").collect()}
    assert past == {"2023r.csv": 1, "2024r.csv": 0}
    (tmp_path / "in" / "s").mkdir()
    put(landing, "s/2025r.csv", "a,b\n7,8\n")
    landed = spark.createDataFrame([("https://h/north/2025r.csv", f"{landing}/2025r.csv"), ("https://h/south/2025r.csv", f"{landing}/s/2025r.csv")], "url string, path string")
    assert run_files(spark, landing, root, names[2:4], "csv", landed=landed).count() == 0
    assert sorted(map(tuple, spark.read.parquet(f"{root}/town/tax_roll").where("year = 2025").collect())) == [(5, 6, 2025), (7, 8, 2025)]


def test_empty_and_headed_workbooks(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    put(landing, "2022taxroll.xlsx", _workbook([["A", "B", "C"]]))
    put(landing, "2023taxroll.xlsx", _workbook([]))
    put(landing, "2024taxroll.xlsx", _workbook([["A", "B", "C"], ["1", "2", "3"]]))
    bad = run_files(spark, landing, root, [f"{y}taxroll.xlsx" for y in (2022, 2023, 2024)], "xlsx").collect()
    assert [(r.path.rsplit("/", 1)[1], r.error) for r in bad] == [("2023taxroll.xlsx", "file has no table")]
    past = {r.filename: r.row_count for r in history.read_history(spark, f"{root}/town").collect()}
    assert past == {"2022taxroll.xlsx": 0, "2024taxroll.xlsx": 1}


def test_excel_file_load(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    put(landing, "2024taxroll.xlsx", _workbook([["City"], ["Parcel ID", "Owner", "Tax Total"], ["1", "A", "007"], ["2", None, "5"]]))
    put(landing, "2023taxroll.xlsx", b"broken")
    bad = run_files(spark, landing, root, ["2024taxroll.xlsx", "2023taxroll.xlsx"], "xlsx", excel={"sheet": 0}).collect()
    assert len(bad) == 1
    rows = spark.read.parquet(f"{root}/town/tax_roll").orderBy("parcel_id").collect()
    assert [(r.parcel_id, r.owner, r.tax_total, r.year) for r in rows] == [("1", "A", "007", 2024), ("2", None, "5", 2024)]
    assert history.read_history(spark, f"{root}/town").first().row_count == 2


def test_stream_loads_each_file_once(spark, folder):
    source, root = folder + "/in", folder + "/out"
    schema = "id bigint, v string"
    wanted = [Metric("v", "sum")]

    def run(day):
        rows = spark.createDataFrame([], schema).schema
        ingest.ingest(spark, source, rows, root, "d", "town", f"2025-01-0{day}", wanted, files_per_batch=1)

    spark.createDataFrame([(1, "5"), (2, "x")], schema).coalesce(1).write.parquet(source)
    run(1)
    run(2)
    spark.createDataFrame([(3, "7")], schema).coalesce(1).write.mode("append").parquet(source)
    run(3)
    full = spark.createDataFrame([], schema).schema
    assert sorted(r.id for r in ingest.loaded(spark, root, "d", full).collect()) == [1, 2, 3]
    past = ingest.stream_history(spark, root).orderBy("loaded_at").collect()
    assert [(r.row_count, r.loaded_at, r.dataset_name) for r in past] == [(2, "2025-01-01", "d"), (1, "2025-01-03", "d")]
    values = {(r[ingest.BATCH], r.metric_name): r.value for r in ingest.batch_metrics(spark, root, "d").collect()}
    assert values == {(0, "row_count"): 2.0, (0, "v"): 5.0, (1, "row_count"): 1.0, (1, "v"): 7.0}


def test_stream_goes_on_behind_a_corrupt_file(spark, folder):
    source, root = f"{folder}/in", f"{folder}/out"
    schema = spark.range(1).schema
    for k in range(5):
        spark.range(k, k + 1).coalesce(1).write.mode("append").parquet(source)
    with open(f"{source}/part-broken.parquet", "wb") as out:
        out.write(b"PAR1 this is no data PAR1")
    open(f"{source}/part-empty.parquet", "wb").close()
    for day in (1, 2):
        ingest.ingest(spark, source, schema, root, "d", "town", f"2025-01-0{day}")
        assert sorted(r.id for r in ingest.loaded(spark, root, "d", schema).collect()) == [0, 1, 2, 3, 4]
        errors = {r.path.rsplit("/", 1)[1]: r.error for r in ingest.load_errors(spark, root, "d").collect()}
        assert set(errors) == {"part-broken.parquet", "part-empty.parquet"} and errors["part-empty.parquet"] == "file is empty"
    past = ingest.stream_history(spark, root).collect()
    assert len(past) == 5 and {r.loaded_at for r in past} == {"2025-01-01"}
    spark.range(9, 10).coalesce(1).write.mode("append").parquet(source)
    ingest.ingest(spark, source, schema, root, "d", "town", "2025-01-03")
    assert ingest.loaded(spark, root, "d", schema).count() == 6 and ingest.load_errors(spark, root, "d").count() == 2


def test_a_batch_of_bad_files_only(spark, folder):
    for k in range(3):
        with open(f"{folder}/{k}.parquet", "w") as out:
            out.write("no")
    ingest.ingest(spark, folder, spark.range(1).schema, f"{folder}-out", "d", "town", "2025-01-01")
    assert ingest.load_errors(spark, f"{folder}-out", "d").count() == 3


def test_repeated_batch_replaces_itself(spark, folder):
    df = spark.range(3)
    for _ in range(2):
        ingest._replace_batch(df, folder + "/t", 4)
    ingest._replace_batch(df, folder + "/t", 5)
    assert spark.read.parquet(folder + "/t").count() == 6


def test_totals_of_a_load_are_exact(spark, folder):
    """In every order the doubles of ``3-MEDIUM`` add up to less than the half they are."""
    prices = [48594652444.84, 70260534413.15, 17583450632.51]
    assert sum(Decimal(str(p)) for p in prices) == Decimal("136438637490.5")
    assert all((a + b) + c < 136438637490.5 for a, b, c in permutations(prices))
    rows = [(i, p, "3-MEDIUM") for i, p in enumerate(prices)]
    rows += [(10, 100.25, "1-URGENT"), (11, 10.0, "2-HIGH"), (12, 1.1, "4-NOT SPECIFIED"), (13, 2.4, "5-LOW")]
    spark.createDataFrame(rows, "o_orderkey long, o_totalprice double, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    found = {r.dataset_name: (r.outcome, r.n, r.total) for r in QUERIES["feature_load"](spark, folder).collect()}
    assert found == {
        "broken": ("failed", 3, 136438637491), "fails": ("failed", 1, 10), "first": ("loaded", 2, 4), "passes": ("loaded", 1, 102)
    }
