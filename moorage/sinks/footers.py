"""Audit of Parquet and GeoParquet footers."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.sources.files import open_input

_S, _L = T.StringType(), T.LongType()
AUDIT = T.StructType()
for _name, _kind in {
    "path": _S, "num_rows": _L, "num_columns": _L, "row_groups": _L, "footer_bytes": _L, "file_bytes": _L,
    "has_geo": T.BooleanType(), "geometry_column": _S, "encoding": _S, "geometry_types": T.ArrayType(_S),
    "crs_id": _S, "crs_name": _S, "crs_units": _S, "bbox": T.ArrayType(T.DoubleType()),
    "other_keys": T.MapType(_S, _S), "extension_keys": T.MapType(_S, _S), "error": _S,
}.items():
    AUDIT = AUDIT.add(_name, _kind)
_ARROW = {
    "string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
    "array<double>": pa.list_(pa.float64()), "map<string,string>": pa.map_(pa.string(), pa.string()),
}
_SCHEMA = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in AUDIT])


def _crs(crs: dict | None) -> dict:
    if not crs:
        return {}
    ident, axes = crs.get("id"), (crs.get("coordinate_system") or {}).get("axis") or [{}]
    unit = axes[0].get("unit")
    return {
        "crs_id": f"{ident.get('authority', 'Unknown')}:{ident.get('code', 'Unknown')}" if ident else None,
        "crs_name": crs.get("name"),
        "crs_units": unit.get("name", "unknown") if isinstance(unit, dict) else unit,
    }


def _rows(path: str) -> list[dict]:
    """One row per geometry column of the file, or a single row without one."""
    try:
        with open_input(path) as source:
            size = source.size()
            parquet = pq.ParquetFile(source)
            meta, schema = parquet.metadata, parquet.schema_arrow
    except (OSError, pa.ArrowException) as exc:
        return [{"path": path, "error": f"{type(exc).__name__}: {exc}"}]
    keys = {k.decode(): v.decode(errors="replace") for k, v in {**(schema.metadata or {}), **(meta.metadata or {})}.items()}
    geo = json.loads(keys.pop("geo", "null"))
    base = {
        "path": path, "num_rows": meta.num_rows, "num_columns": meta.num_columns, "row_groups": meta.num_row_groups,
        "footer_bytes": meta.serialized_size, "file_bytes": size, "has_geo": geo is not None,
        "other_keys": keys,
    }
    out = []
    for column, info in ((geo or {}).get("columns") or {}).items():
        at = schema.get_field_index(column)
        field = (schema.field(at).metadata or {}) if at >= 0 else {}
        out.append(
            {
                **base, "geometry_column": column, "encoding": info.get("encoding", "N/A"),
                "geometry_types": info.get("geometry_types", []), "bbox": info.get("bbox"), **_crs(info.get("crs")),
                "extension_keys": {
                    k.decode(): v.decode(errors="replace") for k, v in field.items() if k != b"ARROW:extension:metadata"
                },
            }
        )
    return out or [base]


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [row for path in batch.column("path").to_pylist() for row in _rows(path)]
        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def footer_audit(files: DataFrame) -> DataFrame:
    """Footer facts of every listed file, read by the tasks the listing is split into."""
    return files.select("path").mapInArrow(_audit, AUDIT)


def totals(audit: DataFrame) -> DataFrame:
    """Rows, row groups and bytes over all files (a file with several geometry columns counts once)."""
    once = audit.groupBy("path").agg(F.max("num_rows").alias("r"), F.max("row_groups").alias("g"), F.max("file_bytes").alias("b"))
    return once.agg(
        F.count(F.lit(1)).alias("files"), F.sum("r").alias("rows"), F.sum("g").alias("row_groups"), F.sum("b").alias("bytes")
    )
