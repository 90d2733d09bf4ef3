"""Table writes: yearly snapshots, appends, full replacement, configurable Hive layouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_partitions(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Partition values as columns, replacing data columns of the same name."""
    return df.withColumns({field: F.lit(value) for field, value in values.items()})


def partitions_from_file_name(df: DataFrame, fields: Mapping[str, str], file: str = "source_file") -> DataFrame:
    """Partition columns read from each row's file name; null where the name has no match."""
    name = F.element_at(F.split(F.col(file), "/"), -1)
    found = {f: F.nullif(F.regexp_extract(name, pattern, 0), F.lit("")) for f, pattern in fields.items()}
    return df.withColumns(found)


def _spread(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows of a partition together, but a large partition over many tasks.

    A rebalance is sized at run time: small partitions share a task, big ones are split, so there is
    neither one file per task and partition nor one task per hot partition.
    """
    return df.hint("rebalance", *[F.col(f) for f in fields])


def snapshot(df: DataFrame, path: str, fields: Sequence[str] = ("year",)) -> None:
    """Replace the partitions that occur in ``df``; all others stay as they are."""
    (
        _spread(df, fields)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*fields)
        .parquet(path)
    )


def append(df: DataFrame, path: str, fields: Sequence[str] = ()) -> None:
    if not fields:
        df.write.mode("append").parquet(path)
    else:
        _spread(df, fields).write.mode("append").partitionBy(*fields).parquet(path)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"
