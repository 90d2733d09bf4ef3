"""Parquet scans: pruned partitions, and files whose column types have drifted."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from moorage.session import settled
from moorage.sources.delimited import literal_path
from moorage.sources.files import listing, open_input

# Numeric types from narrow to wide.
_WIDTH = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def partitioned(spark: SparkSession, root: str, condition: Column | str | None = None) -> DataFrame:
    """Hive-partitioned scan; a condition on partition columns prunes folders."""
    df = spark.read.parquet(root)
    return df if condition is None else df.where(condition)


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    x, y = a.simpleString(), b.simpleString()
    if x in _WIDTH and y in _WIDTH:
        wide = max(x, y, key=_WIDTH.index)
        # A float cannot hold every integer.
        if wide == "float" and {x, y} & {"int", "bigint"}:
            wide = "double"
        return T.DoubleType() if wide == "double" else {x: a, y: b}[wide]
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    return T.StringType()


# Fixed value: integers up to here are exact as doubles.
_EXACT = 1 << 53


def _cast(name: str, found: T.DataType, target: T.DataType) -> Column:
    """The column in its target type; an integer that a double cannot hold raises instead of changing."""
    col = F.col(f"`{name}`")
    if found == T.LongType() and target == T.DoubleType():
        lost = F.raise_error(F.concat(F.lit(f"column {name!r} has an integer that a double cannot hold: "), col))
        return F.when(~col.between(-_EXACT, _EXACT), lost.cast("double")).otherwise(col.cast("double"))
    return col.cast(target)


def _schema_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, schemas = batch.column("path").to_pylist(), []
        for path in paths:
            with open_input(path) as source:
                arrow = pq.read_schema(source)
            plain = pa.schema(
                [f.with_type(f.type.value_type) if pa.types.is_dictionary(f.type) else f for f in arrow]
            )
            schemas.append(from_arrow_schema(plain).json())
        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(schemas)], names=["path", "schema"])


def schema_groups(spark: SparkSession, root: str) -> list[tuple[T.StructType, list[str]]]:
    """Files grouped by footer schema. Footers are read on the executors; file names and the distinct
    schemas come back."""
    footers = listing(spark, root, "*.parquet").select("path").mapInArrow(_schema_text, "path string, schema string")
    known = settled(footers.withColumn("key", F.md5("schema")), "file-schemas")
    schemas = {r.key: r.schema for r in known.groupBy("key").agg(F.first("schema").alias("schema")).toLocalIterator()}
    members: dict[str, list[str]] = {}
    for r in known.select("key", "path").toLocalIterator():
        members.setdefault(r.key, []).append(r.path)
    return [(T.StructType.fromJson(json.loads(schemas[k])), sorted(members[k])) for k in sorted(members)]


def read_normalized(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root`` as one frame, each column in the widest type any file gives it.

    Path partitions are not added as columns.
    """
    groups = schema_groups(spark, root)
    if not groups:
        raise ValueError(f"no parquet files below {root}")
    target: dict[str, T.DataType] = {}
    for schema, _ in groups:
        for field in schema:
            target[field.name] = _wider(target.get(field.name, field.dataType), field.dataType)
    merged = None
    for schema, paths in groups:
        part = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*map(literal_path, paths))
        part = part.select(*[_cast(f.name, f.dataType, target[f.name]).alias(f.name) for f in schema])
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    return merged
