"""Incremental file ingest as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from moorage.operators.metrics import Metric
from moorage.plans.registered import query
from moorage.session import workspace
from moorage.sources import files
from moorage.streaming import ingest

METRICS = [Metric("value", "sum"), Metric("user_id", "max")]


def _run(spark, t, label):
    """Events arrive in two steps, each followed by a run; a third run finds nothing."""
    root, source = workspace(spark, label), workspace(spark, f"{label}-in")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    for n, kinds in enumerate([F.col("event_type").isin("click", "view"), ~F.col("event_type").isin("click", "view"), None]):
        if kinds is not None:
            rows.where(kinds).write.mode("append").parquet(source)
        ingest.ingest(spark, source, rows.schema, root, "events", "j", f"2025-01-0{n + 1}T00:00:00", METRICS)
    return root, rows.schema


@query("stream_incremental_ingest", "SELECT event_id, user_id, event_type, value FROM events")
def stream_incremental_ingest(spark, t):
    root, schema = _run(spark, t, "stream_ingest")
    return ingest.loaded(spark, root, "events", schema)


@query(
    "stream_batch_metrics",
    """WITH e AS (SELECT CASE WHEN event_type IN ('click', 'view') THEN 0 ELSE 1 END AS batch, * FROM events),
            m AS (SELECT batch, count(*)::DOUBLE AS n, round(sum(value), 2) AS s, max(user_id)::DOUBLE AS u FROM e GROUP BY 1)
       SELECT CAST(batch AS BIGINT) AS batch, 'row_count' AS metric_name, n AS value FROM m
       UNION ALL SELECT batch, 'value', s FROM m UNION ALL SELECT batch, 'user_id', u FROM m""",
)
def stream_batch_metrics(spark, t):
    root, _ = _run(spark, t, "stream_metrics")
    rows = ingest.batch_metrics(spark, root, "events")
    return rows.select(F.col(ingest.BATCH).alias("batch"), "metric_name", F.round("value", 2).alias("value"))


@query(
    "stream_quarantine",
    """SELECT event_type AS name, 'loaded' AS status, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY 1
       UNION ALL SELECT event_type, 'error', CAST(NULL AS BIGINT) FROM events WHERE event_type = 'click' GROUP BY 1
       UNION ALL SELECT 'none', 'empty', NULL FROM (SELECT count(*) AS n FROM events) WHERE n > 0""",
)
def stream_quarantine(spark, t):
    """A file for each kind of event, one of them text under a data name, and one empty; a second run finds nothing new."""
    root, source = workspace(spark, "stream_quarantine"), workspace(spark, "stream_quarantine-in")
    rows = t.events.select("event_id", "user_id", "event_type")
    for kind in [r.event_type for r in rows.select("event_type").distinct().collect()]:
        own = rows.where(F.col("event_type") == kind).coalesce(1)
        if kind == "click":
            own.select(F.col("event_id").cast("string")).write.text(f"{source}/{kind}")
        else:
            own.write.parquet(f"{source}/{kind}")
    files.create_empty(rows.limit(1).select(F.lit(f"{source}/none/part-0.parquet").alias("path")))
    for day in (1, 2):
        ingest.ingest(spark, source, rows.schema, root, "events", "j", f"2025-01-0{day}T00:00:00", METRICS[1:])
    folder = F.element_at(F.split("path", "/"), -2)
    error = F.when(F.col("error") == "file is empty", "empty").otherwise("error")
    bad = ingest.load_errors(spark, root, "events").select(folder.alias("name"), error.alias("status"), F.lit(None).cast("long").alias("n"))
    good = ingest.loaded(spark, root, "events", rows.schema).groupBy(F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return good.select("name", F.lit("loaded").alias("status"), "n").unionByName(bad)
