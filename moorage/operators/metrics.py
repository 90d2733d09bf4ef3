"""Row counts and configured aggregates of incoming and stored data."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.values import numeric

AGGREGATES = ("sum", "avg", "min", "max", "count")
ROW_COUNT = "row_count"


@dataclass(frozen=True)
class Metric:
    """An aggregate of one stored column; ``api_field`` is its name in the source records."""

    column: str
    aggregate: str
    api_field: str | None = None
    tolerance_percent: float | None = None

    def __post_init__(self):
        if self.aggregate not in AGGREGATES:
            raise ValueError(f"unknown aggregate {self.aggregate!r}, expected one of {AGGREGATES}")


def metric_names(metrics: Sequence[Metric]) -> list[str]:
    """The column's name, made unique when several metrics share a column."""
    uses = Counter(m.column for m in metrics)
    return [m.column if uses[m.column] == 1 else f"{m.column}:{m.aggregate}" for m in metrics]


def _values(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.BinaryType)):
        return F.lit(None).cast("double")
    return numeric(F.col(f"`{name}`"), isinstance(kind, T.StringType))


def incoming_aggregates(df: DataFrame, metrics: Sequence[Metric], source: bool = False) -> list[Column]:
    """Aggregates over the numeric values of incoming columns.

    Without any value a sum and an average are 0, a count is 0 and min/max are null. NaN is left
    out of min and max but not of sums.
    """
    out = [F.count(F.lit(1)).alias(ROW_COUNT)]
    for metric, name in zip(metrics, metric_names(metrics)):
        value = _values(df, (metric.api_field or metric.column) if source else metric.column)
        number = F.nanvl(value, F.lit(None).cast("double"))
        found = {
            "sum": lambda: F.coalesce(F.sum(value), F.lit(0.0)),
            "avg": lambda: F.coalesce(F.avg(value), F.lit(0.0)),
            "min": lambda: F.nullif(F.min(number), F.lit(float("inf"))),
            "max": lambda: F.nullif(F.max(number), F.lit(float("-inf"))),
            "count": lambda: F.count(value),
        }[metric.aggregate]()
        out.append(found.alias(name))
    return out


def baseline_aggregates(df: DataFrame, metrics: Sequence[Metric]) -> list[Column]:
    """Aggregates over stored columns with SQL null rules; counts are of numeric values."""
    functions = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}
    return [F.count(F.lit(1)).alias(ROW_COUNT)] + [
        functions[m.aggregate](_values(df, m.column)).alias(name) for m, name in zip(metrics, metric_names(metrics))
    ]


def observed(
    df: DataFrame, metrics: Sequence[Metric], name: str, source: bool = False, **more: Column
) -> tuple[DataFrame, Observation]:
    """The frame with its metrics collected while it is written; no second pass over the data.

    Write the result directly: rows are then counted once per finished write task, also after retries.
    """
    observation = Observation(name)
    extra = [c.alias(n) for n, c in more.items()]
    return df.observe(observation, *incoming_aggregates(df, metrics, source), *extra), observation


def long_form(aggregated: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``keys, metric_name, value``: one row per metric that has a value."""
    entries = [F.struct(F.lit(n).alias("metric_name"), F.col(f"`{n}`").cast("double").alias("value")) for n in names]
    return aggregated.select(*keys, F.inline(F.array(*entries))).where(F.col("value").isNotNull())


def grouped_metrics(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[Metric], incoming: bool, source: bool = False
) -> DataFrame:
    """Metrics of many datasets at once, in long form. One partially aggregated pass."""
    aggregates = incoming_aggregates(df, metrics, source) if incoming else baseline_aggregates(df, metrics)
    return long_form(df.groupBy(*keys).agg(*aggregates), keys, [ROW_COUNT, *metric_names(metrics)])
