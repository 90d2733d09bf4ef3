"""GeoParquet files: a data source for writing frames, and the footer rules both writers share.

Spark's own Parquet writer cannot add footer keys, so tasks write through Arrow. Register with
``register(spark)`` and use ``df.write.format("geoparquet")``; reading needs nothing special.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from moorage.functions import wkb
from moorage.session import ship
from moorage.sources.files import filesystem, open_input

ROW_GROUP_BYTES = 64 << 20
# Footer format version, and the codec of published files.
VERSION = "1.1.0"
CODEC = "snappy"


class GeoFile:
    """One GeoParquet file: batches in, WKB and footer out."""

    def __init__(self, sink, schema: pa.Schema, column: str, crs: dict | None):
        self.column, self.crs = column, crs
        at = schema.get_field_index(column)
        if at < 0:
            raise ValueError(f"no column {column!r} to publish as geometry")
        self.schema = schema.set(at, pa.field(column, pa.binary())).remove_metadata()
        # A stored Arrow schema would hide the footer key from readers that look for it in the schema.
        self.writer = pq.ParquetWriter(sink, self.schema, compression=CODEC, store_schema=False)
        self.types: set[str] = set()
        self.box: list[float] | None = None
        self.pending: list[pa.RecordBatch] = []
        self.pending_bytes = self.rows = 0

    def _geometry(self, values: pa.Array) -> pa.Array:
        if pa.types.is_dictionary(values.type):
            values = values.cast(values.type.value_type)
        text = pa.types.is_string(values.type) or pa.types.is_large_string(values.type)
        blobs = wkb.from_hex(values) if text else values.cast(pa.binary())
        parts = wkb.Parts(blobs)
        if parts.errors:
            raise ValueError(parts.errors[min(parts.errors)])
        box = wkb.bounds_of(parts)
        self.types.update(box.field("geometry_type").drop_null().unique().to_pylist())
        sides = [pc.min_max(box.field(name))[end].as_py() for name, end in (("xmin", "min"), ("ymin", "min"), ("xmax", "max"), ("ymax", "max"))]
        if sides[0] is not None:
            self._grow(*sides)
        # Only extended forms differ from what the format asks for.
        return wkb.iso_of(parts) if parts.extended() else blobs

    def _grow(self, xmin, ymin, xmax, ymax):
        b = self.box or [xmin, ymin, xmax, ymax]
        self.box = [float(min(b[0], xmin)), float(min(b[1], ymin)), float(max(b[2], xmax)), float(max(b[3], ymax))]

    def write(self, batch: pa.RecordBatch) -> None:
        at = batch.schema.get_field_index(self.column)
        columns = list(batch.columns)
        columns[at] = self._geometry(columns[at])
        plain = [
            c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, self.schema)
        ]
        ready = pa.RecordBatch.from_arrays(plain, schema=self.schema)
        self.pending.append(ready)
        self.pending_bytes += ready.nbytes
        self.rows += ready.num_rows
        if self.pending_bytes >= ROW_GROUP_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.pending:
            self.writer.write_table(pa.Table.from_batches(self.pending, self.schema))
            self.pending, self.pending_bytes = [], 0

    def close(self) -> None:
        self._flush()
        # The CRS key is always present: null means unknown, absence would mean lon/lat.
        info = {"encoding": "WKB", "geometry_types": sorted(self.types), "crs": self.crs}
        if self.box:
            info["bbox"] = self.box
        geo = {"version": VERSION, "primary_column": self.column, "columns": {self.column: info}}
        self.writer.add_key_value_metadata({"geo": json.dumps(geo, allow_nan=False)})
        self.writer.close()


    def abandon(self) -> None:
        """Close a file that will not be used."""
        self.pending = []
        self.writer.close()


@dataclass
class _Written(WriterCommitMessage):
    name: str | None
    rows: int


class _Writer(DataSourceArrowWriter):
    """Tasks write under a staging folder; the commit moves finished files into place.

    A file of a lost or repeated task attempt has its own name and no commit message, so it is
    never published and goes with the staging folder.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.column = options.get("geometrycolumn", options.get("geometryColumn", "geometry"))
        self.crs = json.loads(options["crs"]) if options.get("crs") else None
        self.overwrite = overwrite
        self.staging = f"{self.path}/_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, folder = filesystem(self.staging)
        name, geo, sink = f"part-{uuid.uuid4().hex}.snappy.parquet", None, None
        for batch in iterator:
            if geo is None:
                fs.create_dir(folder, recursive=True)
                sink = fs.open_output_stream(f"{folder}/{name}")
                geo = GeoFile(sink, batch.schema, self.column, self.crs)
            geo.write(batch)
        if geo is None:
            return _Written(None, 0)
        geo.close()
        sink.close()
        return _Written(name, geo.rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, final = filesystem(self.path)
        _, staged = filesystem(self.staging)
        fs.create_dir(final, recursive=True)
        old = []
        if self.overwrite:
            listed = fs.get_file_info(pafs.FileSelector(final, recursive=False))
            old = [f.path for f in listed if f.base_name.endswith(".parquet")]
        names = [m.name for m in messages if m is not None and m.name]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda n: fs.move(f"{staged}/{n}", f"{final}/{n}"), names))
            list(pool.map(fs.delete_file, old))
        self._clean(fs, staged)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, staged = filesystem(self.staging)
        self._clean(fs, staged)

    @staticmethod
    def _clean(fs: pafs.FileSystem, staged: str) -> None:
        if fs.get_file_info(staged).type == pafs.FileType.Directory:
            fs.delete_dir(staged)


class GeoParquetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geoparquet"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(GeoParquetSource)


def write(df, path: str, crs: dict | None = None, column: str = "geometry", mode: str = "append") -> None:
    """Write a frame with a WKB (or WKB hex) column as GeoParquet; ``crs`` is PROJJSON, None if unknown."""
    register(df.sparkSession)
    writer = df.write.format("geoparquet").mode(mode).option("geometryColumn", column)
    if crs is not None:
        writer = writer.option("crs", json.dumps(crs))
    writer.save(path)


def is_published(path: str) -> bool:
    """Whether a Parquet file has a GeoParquet footer."""
    with open_input(path) as stream:
        return b"geo" in (pq.read_metadata(stream).metadata or {})


def publish_file(source: str, target: str, column: str, crs: dict | None) -> int:
    """Rewrite one Parquet file as GeoParquet at ``target``, batch by batch; returns its rows.

    The result is written beside the target and moved over it, so readers never see half a file and
    a repeated attempt does no harm.
    """
    fs, final = filesystem(target)
    folder, _, name = final.rpartition("/")
    fs.create_dir(folder, recursive=True)
    temp = f"{folder}/.{name}.{uuid.uuid4().hex}"
    try:
        with open_input(source) as stream:
            parquet = pq.ParquetFile(stream)
            schema = pa.schema(
                [f.with_type(f.type.value_type) if pa.types.is_dictionary(f.type) else f for f in parquet.schema_arrow]
            )
            if schema.get_field_index(column) < 0:
                raise ValueError(f"{source} has no column {column!r}")
            with fs.open_output_stream(temp) as sink:
                geo = GeoFile(sink, schema, column, crs)
                try:
                    for batch in parquet.iter_batches(batch_size=16_384):
                        geo.write(batch)
                except BaseException:
                    geo.abandon()
                    raise
                geo.close()
        # Hadoop's local file system keeps checksums beside the files; an old one no longer fits.
        checksum = f"{folder}/.{name}.crc"
        if fs.get_file_info(checksum).type == pafs.FileType.File:
            fs.delete_file(checksum)
        fs.move(temp, final)
    except BaseException:
        if fs.get_file_info(temp).type == pafs.FileType.File:
            fs.delete_file(temp)
        raise
    return geo.rows


