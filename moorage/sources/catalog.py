"""Dataset catalog: jurisdictions and their datasets, from nested configuration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC = "struct<parquet_column: string, aggregate: string, api_field: string, tolerance_percent: double>"
DATASET = (
    "struct<name: string, layer_url: string, description: string, geometry_type: string, non_spatial: boolean, "
    "base_url: string, file_type: string, url_patterns: array<string>, "
    "partition: array<struct<field: string, source: string, pattern: string>>, "
    "excel: struct<sheet: string, header_detection: string>, "
    f"validation: struct<enabled: boolean, tolerance_percent: double, metrics: array<{METRIC}>>>"
)
DOCUMENT = f"jurisdiction string, crs int, datasets array<{DATASET}>"


def from_config(spark: SparkSession, config: Mapping) -> DataFrame:
    """Catalog documents of a parsed configuration (a ``jurisdictions:`` mapping)."""
    import json

    docs = [
        (json.dumps({"jurisdiction": name, "crs": body.get("crs"), "datasets": body.get("datasets", [])}),)
        for name, body in (config.get("jurisdictions") or {}).items()
    ]
    return parse_documents(spark.createDataFrame(docs, "body string"))


def parse_documents(texts: DataFrame, body: str = "body") -> DataFrame:
    return texts.select(F.from_json(body, DOCUMENT).alias("d")).select("d.*")


def explode_datasets(documents: DataFrame) -> DataFrame:
    """One row per dataset, with the jurisdiction's name and CRS."""
    # The outer form keeps Spark from parsing each document a second time to test the array.
    rows = documents.select("jurisdiction", "crs", F.explode_outer("datasets").alias("d")).where(F.col("d").isNotNull())
    return rows.select("jurisdiction", "crs", "d.*")


def only(datasets: DataFrame, names: Sequence[str] | None) -> DataFrame:
    return datasets if not names else datasets.where(F.col("name").isin(*names))


def by_jurisdiction(datasets: DataFrame) -> DataFrame:
    """Summary per jurisdiction; the datasets themselves stay rows, so a large one needs no large array."""
    return datasets.groupBy("jurisdiction").agg(
        F.first("crs", ignorenulls=True).alias("crs"),
        F.count(F.lit(1)).alias("n_datasets"),
        F.count_if(F.coalesce("non_spatial", F.lit(False))).alias("n_non_spatial"),
    )


def gate_enabled(
    has_validator: bool | Column = True, skip: bool | Column = False, max_records: int | Column | None = None
) -> Column:
    """Whether a dataset's load is gated: on unless disabled, skipped, sampled or without a validator."""
    enabled = F.coalesce(F.col("validation.enabled"), F.lit(True))
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return enabled & as_col(has_validator) & ~as_col(skip) & as_col(max_records).isNull()
