"""Quality gate: incoming metrics against the stored baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.operators.metrics import ROW_COUNT, Metric, metric_names

DEFAULT_TOLERANCE = 5.0
RESULT_COLUMNS = [
    "passed", "metric_name", "baseline_value", "incoming_value", "percent_difference", "tolerance_percent",
    "error_message",
]

# Texts that are stored with the results.
NO_ROWS, NO_VALUE = "Baseline has 0 rows", "Baseline value is 0"
MISSING_VALUE = ("Missing metric value (baseline: ", ", incoming: ", ")")
FIRST_LOAD = "No baseline data found - first load"


class GateError(Exception):
    """A dataset failed its gate."""


def tolerance(metric_level: Column, dataset_level: Column) -> Column:
    """Metric tolerance (0 counts as unset), else the dataset's (0 is kept), else the default."""
    return F.coalesce(F.nullif(metric_level, F.lit(0.0)), dataset_level, F.lit(DEFAULT_TOLERANCE))


def checks(
    datasets: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric],
    row_count_tolerance: float = DEFAULT_TOLERANCE,
) -> DataFrame:
    """``keys, position, metric_name, tolerance_percent``: the row count first, then each metric.

    ``datasets`` may carry ``dataset_tolerance``.
    """
    dataset_level = F.col("dataset_tolerance") if "dataset_tolerance" in datasets.columns else F.lit(None)
    dataset_level = dataset_level.cast("double")
    rows = [F.struct(F.lit(0).alias("position"), F.lit(ROW_COUNT).alias("metric_name"), F.lit(float(row_count_tolerance)).alias("tolerance_percent"))]
    for i, (metric, name) in enumerate(zip(metrics, metric_names(metrics)), start=1):
        own = F.lit(metric.tolerance_percent).cast("double")
        rows.append(
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("metric_name"), tolerance(own, dataset_level).alias("tolerance_percent"))
        )
    return datasets.select(*keys, F.inline(F.array(*rows)))


def _as_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def compare(expected: DataFrame, baseline: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One result row per check of every dataset that has a baseline.

    ``baseline`` and ``incoming`` are long metrics (``keys, metric_name, value``). A value missing on
    either side is a failed check, not a dropped one. Datasets without any baseline row give none.
    """
    on = [*keys, "metric_name"]
    known = baseline.where(F.col("metric_name") == ROW_COUNT).select(*keys)
    joined = (
        expected.join(known, list(keys), "left_semi")
        .join(baseline.withColumnRenamed("value", "baseline_value"), on, "left")
        .join(incoming.withColumnRenamed("value", "incoming_value"), on, "left")
    )
    is_count = F.col("metric_name") == ROW_COUNT
    base = F.col("baseline_value")
    # An absent dataset has no rows; an absent metric has no value.
    new = F.when(is_count, F.coalesce("incoming_value", F.lit(0.0))).otherwise(F.col("incoming_value"))
    missing = base.isNull() | new.isNull()
    percent = F.when(~missing & (base != 0), F.abs(new - base) / F.abs(base) * 100)
    message = (
        F.when(is_count & (base == 0), F.lit(NO_ROWS))
        .when(
            missing,
            F.concat(F.lit(MISSING_VALUE[0]), _as_text(base), F.lit(MISSING_VALUE[1]), _as_text(new), F.lit(MISSING_VALUE[2])),
        )
        .when(base == 0, F.lit(NO_VALUE))
    )
    within = ~F.isnan(percent) & (percent <= F.col("tolerance_percent"))
    return joined.select(
        *keys,
        "position",
        F.coalesce(within, F.lit(False)).alias("passed"),
        "metric_name",
        base.alias("baseline_value"),
        new.alias("incoming_value"),
        percent.alias("percent_difference"),
        "tolerance_percent",
        message.alias("error_message"),
    )


def verdict(datasets: DataFrame, results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, status``: ``no_baseline`` (loads), ``passed`` or ``failed``."""
    passed = results.groupBy(*keys).agg(F.bool_and("passed").alias("_all"))
    status = F.when(F.col("_all").isNull(), "no_baseline").when(F.col("_all"), "passed").otherwise("failed")
    return datasets.select(*keys).distinct().join(passed, list(keys), "left").select(*keys, status.alias("status"))


def audit(datasets: DataFrame, results: DataFrame, keys: Sequence[str], run_time: str) -> DataFrame:
    """``keys, validation_timestamp, status, results``; results as JSON text with explicit nulls."""
    entry = F.struct(
        "position",
        F.col("metric_name").alias("metric"),
        F.col("baseline_value").alias("baseline"),
        F.col("incoming_value").alias("incoming"),
        F.col("percent_difference").alias("percent_diff"),
        "passed",
    )
    grouped = results.groupBy(*keys).agg(
        F.bool_and("passed").alias("_all"), F.array_sort(F.collect_list(entry)).alias("_entries")
    )
    listed = F.transform(F.col("_entries"), lambda e: e.dropFields("position"))
    text = F.when(
        F.col("_all").isNull(), F.to_json(F.struct(F.lit(FIRST_LOAD).alias("message")))
    ).otherwise(F.to_json(listed, {"ignoreNullFields": "false"}))
    status = F.when(F.col("_all").isNull(), "no_baseline").when(F.col("_all"), "passed").otherwise("failed")
    return (
        datasets.select(*keys)
        .distinct()
        .join(grouped, list(keys), "left")
        .select(*keys, F.lit(run_time).alias("validation_timestamp"), status.alias("status"), text.alias("results"))
    )
