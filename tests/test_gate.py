import json

import pytest
from pyspark.sql import functions as F

from moorage.operators import gate, metrics, registry
from moorage.operators.metrics import Metric

KEYS = ["name"]


def long(spark, **values):
    return spark.createDataFrame([("d", k, float(v)) for k, v in values.items() if v is not None], "name string, metric_name string, value double")


def results(spark, wanted, baseline, incoming, dataset_tolerance=None):
    datasets = spark.createDataFrame([("d", dataset_tolerance)], "name string, dataset_tolerance double")
    expected = gate.checks(datasets, KEYS, wanted)
    rows = gate.compare(expected, long(spark, **baseline), long(spark, **incoming), KEYS)
    return datasets, rows


def test_pass_and_fail_cases(spark):
    wanted = [Metric("total", "sum")]
    base = {"row_count": 1000, "total": 500}
    for factor, total, status in ((1.03, 1.02, "passed"), (1.10, 0.88, "failed")):
        datasets, rows = results(spark, wanted, base, {"row_count": 1000 * factor, "total": 500 * total})
        assert gate.verdict(datasets, rows, KEYS).first().status == status
        assert [r.passed for r in rows.orderBy("position").collect()] == [status == "passed"] * 2


def test_bound_is_inclusive_and_zero_tolerances_differ(spark):
    wanted = [Metric("a", "sum", tolerance_percent=0.0), Metric("b", "sum", tolerance_percent=10.0)]
    _, rows = results(spark, wanted, {"row_count": 100, "a": 100, "b": 100}, {"row_count": 105, "a": 108, "b": 110}, dataset_tolerance=8.0)
    got = {r.metric_name: (r.passed, r.tolerance_percent) for r in rows.collect()}
    assert got == {"row_count": (True, 5.0), "a": (True, 8.0), "b": (True, 10.0)}
    _, rows = results(spark, [Metric("a", "sum")], {"row_count": 1, "a": 100}, {"row_count": 1, "a": 101}, dataset_tolerance=0.0)
    assert {r.metric_name: r.passed for r in rows.collect()} == {"row_count": True, "a": False}


def test_failures_without_a_percentage(spark):
    wanted = [Metric("zero", "sum"), Metric("gone", "min"), Metric("nan", "sum"), Metric("neg", "sum")]
    datasets, rows = results(
        spark, wanted, {"row_count": 10, "zero": 0, "gone": 3.5, "nan": 1, "neg": -100}, {"row_count": 10, "zero": 5, "nan": float("nan"), "neg": -103}
    )
    got = {r.metric_name: r for r in rows.collect()}
    assert got["zero"].error_message == "Baseline value is 0" and got["zero"].percent_difference is None
    assert got["gone"].error_message == "Missing metric value (baseline: 3.5, incoming: None)"
    assert not got["nan"].passed and got["neg"].passed
    text = gate.audit(datasets, rows, KEYS, "2025-01-01T00:00:00").first()
    listed = json.loads(text.results)
    assert text.status == "failed" and [e["metric"] for e in listed] == ["row_count", "zero", "gone", "nan", "neg"]
    assert listed[2] == {"metric": "gone", "baseline": 3.5, "incoming": None, "percent_diff": None, "passed": False}


def test_no_baseline_and_empty_baseline(spark):
    datasets, rows = results(spark, [Metric("a", "sum")], {}, {"row_count": 10, "a": 1})
    assert rows.count() == 0 and gate.verdict(datasets, rows, KEYS).first().status == "no_baseline"
    assert "first load" in gate.audit(datasets, rows, KEYS, "t").first().results
    _, rows = results(spark, [], {"row_count": 0}, {"row_count": 10})
    assert rows.first().error_message == "Baseline has 0 rows"


def test_accumulator_numbers(spark):
    df = spark.createDataFrame([("1", 1000.50), ("2", 2500.75), ("3", 1500.25), ("4", None)], "parcel string, TotalTaxes double")
    wanted = [Metric("total_taxes", "sum", api_field="TotalTaxes")]
    row = df.agg(*metrics.incoming_aggregates(df, wanted, source=True)).first()
    assert (row.row_count, row.total_taxes) == (4, pytest.approx(5001.50))


def test_metrics_of_odd_values(spark):
    df = spark.createDataFrame([("5", 1.0), ("x", float("nan")), ("12d", None), (" 7 ", 3.0), (None, 2.0)], "t string, n double")
    wanted = [Metric("t", a) for a in metrics.AGGREGATES] + [Metric("n", a) for a in ("min", "max", "sum")]
    row = df.agg(*metrics.incoming_aggregates(df, wanted)).first().asDict()
    assert (row["t:sum"], row["t:avg"], row["t:min"], row["t:max"], row["t:count"]) == (12.0, 6.0, 5.0, 7.0, 2)
    assert (row["n:min"], row["n:max"]) == (1.0, 3.0) and row["n:sum"] != row["n:sum"]
    empty = df.where("false")
    row = empty.agg(*metrics.incoming_aggregates(empty, wanted)).first().asDict()
    assert (row["row_count"], row["t:sum"], row["t:avg"], row["t:min"], row["t:count"]) == (0, 0.0, 0.0, None, 0)
    row = empty.agg(*metrics.baseline_aggregates(empty, wanted)).first().asDict()
    assert (row["t:sum"], row["t:avg"], row["t:count"]) == (None, None, 0)
    with pytest.raises(ValueError):
        Metric("a", "median")


def test_observed_equals_second_pass(spark, folder):
    df = spark.range(1000).select(F.col("id").cast("string").alias("v"))
    wanted = [Metric("v", "sum"), Metric("v", "max")]
    watched, seen = metrics.observed(df, wanted, "o")
    watched.repartition(3).write.parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    assert seen.get == stored.agg(*metrics.incoming_aggregates(stored, wanted)).first().asDict()


def test_registry(spark):
    datasets = spark.createDataFrame(
        [("a", "https://h/s/0/query", None, None), ("b", "https://h/s/1/query/", True, "Polygon"), ("c", "https://h/s/2/query", False, "Point")],
        "name string, layer_url string, non_spatial boolean, geometry_type string",
    )
    full = {
        "sourceSpatialReference": {"latestWkid": 8193, "wkid": 103412}, "geometryType": "esriGeometryPolyline",
        "extent": {"xmin": 1, "ymin": 2, "xmax": 3, "ymax": 4}, "hasM": True,
    }
    documents = spark.createDataFrame(
        [("https://h/s/0", json.dumps(full)), ("https://h/s/0", json.dumps(full)), ("https://h/s/1", "not json")], "service_url string, body string"
    )
    rows = {r.dataset_name: r for r in registry.label(registry.registry(datasets, documents, "t")).collect()}
    assert len(rows) == 3 and rows["a"].crs == "EPSG:8193" and rows["a"].geometry_type == "MultiLineString"
    assert (rows["a"].has_z, rows["a"].has_m, rows["a"].xmax, rows["a"].non_spatial) == (False, True, 3.0, False)
    assert (rows["b"].crs, rows["b"].geometry_type, rows["b"].non_spatial) == (None, "Polygon", True)
    assert rows["c"].has_z is None and rows["c"].extracted_at == "t"
