"""Metrics and the quality gate: is a year's snapshot in line with the year before?"""

from __future__ import annotations

from pyspark.sql import functions as F

from moorage.operators import gate, metrics
from moorage.operators.metrics import Metric
from moorage.plans.registered import query
from moorage.session import settled, workspace
from moorage.sinks import tables

KEYS = ["dataset_name"]
METRICS = [
    Metric("o_totalprice", "sum", tolerance_percent=3.0),
    Metric("o_orderkey", "avg", tolerance_percent=0.0),
    Metric("o_code", "max"),
]


def _orders(t):
    """Orders with their year, and a text column that is numeric in some rows only."""
    code = F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    return t.orders.withColumns({"year": F.year("o_orderdate"), "dataset_name": F.col("o_orderpriority"), "o_text": code})


def _in_year(year: int):
    first, after = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp") for y in (year, year + 1))
    return (F.col("o_orderdate") >= first) & (F.col("o_orderdate") < after)


def _snapshots(t):
    rows = _orders(t).select("dataset_name", "o_orderdate", "o_totalprice", "o_orderkey")
    # The maximum is of text, and no row of one dataset has a number in it.
    code = F.when(F.col("dataset_name") == "5-LOW", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    rows = rows.withColumn("o_code", code)
    # Ranges of the stored date reach the scan; a function of it would not.
    old = rows.where(_in_year(1999) & (F.col("dataset_name") != "1-URGENT"))
    new = rows.where(_in_year(2000))
    return old, new


def gate_parts(t, wanted=METRICS):
    old, new = _snapshots(t)
    # Metric rows are few and used several times; settled, each snapshot is scanned once.
    baseline = settled(metrics.grouped_metrics(old, KEYS, wanted, incoming=False), "baseline")
    incoming = settled(metrics.grouped_metrics(new, KEYS, wanted, incoming=True), "incoming")
    datasets = incoming.where(F.col("metric_name") == metrics.ROW_COUNT).select(*KEYS)
    datasets = datasets.withColumn("dataset_tolerance", F.when(F.col("dataset_name") == "2-HIGH", F.lit(1.0)))
    expected = gate.checks(datasets, KEYS, wanted)
    return datasets, gate.compare(expected, baseline, incoming, KEYS)


_GATE_SQL = """
  WITH o AS (
    SELECT o_orderpriority AS dataset_name, year(o_orderdate) AS y, o_totalprice, o_orderkey,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS o_code FROM orders),
  b AS (SELECT dataset_name, count(*)::DOUBLE AS n, sum(o_totalprice) AS s, avg(o_orderkey) AS a, max(o_code) AS m
        FROM o WHERE y = 1999 AND dataset_name <> '1-URGENT' GROUP BY 1),
  i AS (SELECT dataset_name, count(*)::DOUBLE AS n, sum(o_totalprice) AS s, avg(o_orderkey) AS a, max(o_code) AS m
        FROM o WHERE y = 2000 GROUP BY 1),
  r AS (
    SELECT i.dataset_name, 0 AS position, 'row_count' AS metric_name, b.n AS baseline_value, i.n AS incoming_value, 5.0::DOUBLE AS tol FROM i JOIN b USING (dataset_name)
    UNION ALL SELECT i.dataset_name, 1, 'o_totalprice', b.s, i.s, 3.0 FROM i JOIN b USING (dataset_name)
    UNION ALL SELECT i.dataset_name, 2, 'o_orderkey', b.a, i.a, CASE WHEN i.dataset_name = '2-HIGH' THEN 1.0 ELSE 5.0 END FROM i JOIN b USING (dataset_name)
    UNION ALL SELECT i.dataset_name, 3, 'o_code', b.m, i.m, CASE WHEN i.dataset_name = '2-HIGH' THEN 1.0 ELSE 5.0 END FROM i JOIN b USING (dataset_name)),
  q AS (SELECT *, abs(incoming_value - baseline_value) / abs(baseline_value) * 100 AS pct FROM r)
"""
_RESULT_SQL = _GATE_SQL + """
  SELECT dataset_name, metric_name, coalesce(pct <= tol, false) AS passed, round(baseline_value, 2) AS baseline_value,
         round(incoming_value, 2) AS incoming_value, round(pct, 4) AS percent_difference, tol AS tolerance_percent,
         CASE WHEN baseline_value IS NULL THEN 'Missing metric value (baseline: None, incoming: None)' END AS error_message
  FROM q
"""


@query("gate_results", _RESULT_SQL)
def gate_results(spark, t):
    _, results = gate_parts(t)
    return results.select(
        "dataset_name", "metric_name", "passed", F.round("baseline_value", 2).alias("baseline_value"),
        F.round("incoming_value", 2).alias("incoming_value"), F.round("percent_difference", 4).alias("percent_difference"),
        "tolerance_percent", "error_message",
    )


@query(
    "gate_verdict",
    _GATE_SQL
    + """SELECT i.dataset_name, CASE WHEN min(q.dataset_name) IS NULL THEN 'no_baseline'
              WHEN bool_and(coalesce(pct <= tol, false)) THEN 'passed' ELSE 'failed' END AS status
         FROM i LEFT JOIN q USING (dataset_name) GROUP BY 1""",
)
def gate_verdict(spark, t):
    datasets, results = gate_parts(t)
    return gate.verdict(datasets, results, KEYS)


@query(
    "gate_row_count_only",
    _GATE_SQL
    + """SELECT dataset_name, metric_name, coalesce(pct <= tol, false) AS passed, baseline_value, incoming_value,
                round(pct, 4) AS percent_difference FROM q WHERE position = 0""",
)
def gate_row_count_only(spark, t):
    _, results = gate_parts(t, [])
    return results.select(
        "dataset_name", "metric_name", "passed", "baseline_value", "incoming_value",
        F.round("percent_difference", 4).alias("percent_difference"),
    )


@query(
    "gate_audit",
    _GATE_SQL
    + """SELECT i.dataset_name, '2025-01-01T00:00:00' AS validation_timestamp, CASE WHEN min(q.dataset_name) IS NULL THEN 'no_baseline'
              WHEN bool_and(coalesce(pct <= tol, false)) THEN 'passed' ELSE 'failed' END AS status,
              CASE WHEN min(q.dataset_name) IS NULL THEN '{"message":"No baseline data found - first load"}'
              ELSE '[{"metric":"row_count","baseline":' || CAST(min(b.n) AS VARCHAR) || ',"incoming":' || CAST(min(i.n) AS VARCHAR)
                   || ',"percent_diff":' || CAST(min(round(pct, 2)) AS VARCHAR) || ',"passed":'
                   || CAST(bool_and(coalesce(pct <= tol, false)) AS VARCHAR) || '}]' END AS results
         FROM i LEFT JOIN b USING (dataset_name)
                LEFT JOIN (SELECT * FROM q WHERE position = 0) q USING (dataset_name) GROUP BY 1""",
)
def gate_audit(spark, t):
    datasets, results = gate_parts(t, [])
    results = results.withColumn("percent_difference", F.round("percent_difference", 2))
    path = workspace(spark, "gate_audit")
    tables.append(gate.audit(datasets, results, KEYS, "2025-01-01T00:00:00"), path)
    return spark.read.parquet(path).select("dataset_name", "validation_timestamp", "status", "results")


INFLIGHT = [
    Metric("o_text", "sum"), Metric("o_text", "avg"), Metric("o_text", "min"), Metric("o_text", "max"), Metric("o_text", "count"),
    Metric("o_orderstatus", "sum"),
]


@query(
    "inflight_metrics",
    """WITH o AS (SELECT try_cast(CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS v FROM orders),
            a AS (SELECT count(*)::DOUBLE AS n, coalesce(sum(v), 0) AS s, coalesce(avg(v), 0) AS a, min(v) AS lo, max(v) AS hi, count(v)::DOUBLE AS c FROM o)
       SELECT 'row_count' AS metric_name, n AS value FROM a
       UNION ALL SELECT 'o_text:sum', round(s, 1) FROM a UNION ALL SELECT 'o_text:avg', round(a, 2) FROM a
       UNION ALL SELECT 'o_text:min', lo FROM a UNION ALL SELECT 'o_text:max', hi FROM a
       UNION ALL SELECT 'o_text:count', c FROM a UNION ALL SELECT 'o_orderstatus', 0.0 FROM a""",
)
def inflight_metrics(spark, t):
    rows = _orders(t).select("o_orderkey", "o_text", "o_orderstatus")
    watched, seen = metrics.observed(rows, INFLIGHT, "inflight_metrics")
    watched.write.parquet(workspace(spark, "inflight_metrics"))
    digits = {"o_text:sum": 1, "o_text:avg": 2}
    found = [(k, round(float(v), digits.get(k, 9))) for k, v in seen.get.items() if v is not None]
    return spark.createDataFrame(found, "metric_name string, value double")


@query(
    "baseline_metrics",
    """SELECT count(*) AS row_count, round(sum(o_totalprice), 1) AS total, round(avg(o_totalprice), 2) AS mean,
              min(o_totalprice) AS low, max(o_totalprice) AS high, count(o_totalprice) AS n
       FROM orders WHERE year(o_orderdate) = 1999""",
)
def baseline_metrics(spark, t):
    path = workspace(spark, "baseline_metrics")
    tables.snapshot(_orders(t).select("o_orderkey", "o_totalprice", "year"), path)
    stored = spark.read.parquet(path).where("year = 1999")
    wanted = [Metric("o_totalprice", a) for a in metrics.AGGREGATES]
    row = stored.agg(*metrics.baseline_aggregates(stored, wanted))
    named = {f"o_totalprice:{a}": n for a, n in zip(metrics.AGGREGATES, ("total", "mean", "low", "high", "n"))}
    row = row.withColumnsRenamed(named)
    return row.withColumns({"total": F.round("total", 1), "mean": F.round("mean", 2)})
