"""Queries over the driver tables, one per operator, each with the SQL that checks it where SQL can."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, tables)`` under ``name``."""

    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(spark, Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


for _module in ("features", "files", "gates", "web", "geo", "streams"):
    importlib.import_module(f"{__name__}.{_module}")
