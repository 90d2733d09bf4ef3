"""GeoJSON files: each file is one FeatureCollection, read in byte ranges by many tasks.

Where a feature begins depends on all text before it. Each range first reports how many quotes it has, and what it does to
the depth of brackets if it begins outside of a string, and if inside. The state and depth at each start follow from running
sums of these reports. Then the ranges of the ``features`` array cut out the features that begin in them, the last one
whole, and send them on as pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.session import settled
from moorage.sources import files, pages
from moorage.sources.files import filesystem
from moorage.sources.records import COMPRESSED, ranges

# Bytes of a range, of one read, and of the features of a page.
RANGE, READ, PAGE = 32 << 20, 4 << 20, 1 << 20
# How far before a range its first bracket looks for the name of its array.
LOOK = 4096
_FEATURES = re.compile(rb'"features"\s*:\s*\[')
_QUOTE, _BACKSLASH, _OPEN, _CLOSE = 0x22, 0x5C, (0x7B, 0x5B), (0x7D, 0x5D)


def _chunks(path: str, start: int) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the text from ``start`` on."""
    fs, name = filesystem(path)
    if path.lower().endswith(COMPRESSED):
        source = fs.open_input_stream(name, compression="detect")
    else:
        source = fs.open_input_file(name)
        source.seek(start)
    with source:
        at = start
        while chunk := source.read(READ):
            yield at, chunk
            at += len(chunk)


def _before(path: str, start: int) -> tuple[bytes, bool]:
    """Some text before a range, and whether it ends with a backslash that takes the next character along."""
    if start == 0:
        return b"", False
    fs, name = filesystem(path)
    with fs.open_input_file(name) as source:
        size = LOOK
        while True:
            source.seek(max(start - size, 0))
            text = source.read(min(size, start))
            run = len(text) - len(text.rstrip(b"\\"))
            if run < len(text) or size >= start:
                return text[-LOOK:], run % 2 == 1
            size *= 2


class _Scan:
    """Structure of consecutive chunks: which bytes are quotes, and the depth behind each byte."""

    def __init__(self, inside: bool, depth: int, escaped: bool):
        self.inside, self.depth, self.escaped = inside, depth, escaped

    def read(self, chunk: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, whether each stands in a string, and the depth behind it."""
        data = np.frombuffer(chunk, np.uint8)
        quote = data == _QUOTE
        back = np.flatnonzero(data == _BACKSLASH)
        if self.escaped and len(data):
            quote[0] = False
        ends_escaped = False
        if len(back):
            # Of a run of backslashes every second one is taken along itself; the character behind an odd run is.
            first = np.flatnonzero(np.diff(back, prepend=-2) != 1)
            begin, stop = back[first], np.append(back[first[1:] - 1], back[-1]) + 1
            if self.escaped and begin[0] == 0:
                begin = begin.copy()
                begin[0] = 1
            odd = stop[(stop - begin) % 2 == 1]
            ends_escaped = bool(len(odd)) and odd[-1] == len(data)
            quote[odd[odd < len(data)]] = False
        string = (np.cumsum(quote) % 2 == 1) != self.inside
        steps = np.isin(data, _OPEN).astype(np.int32) - np.isin(data, _CLOSE)
        steps[string] = 0
        depth = np.cumsum(steps, dtype=np.int64) + self.depth
        if len(data):
            self.inside, self.depth, self.escaped = bool(string[-1]), int(depth[-1]), ends_escaped
        return data, string, depth


_REPORT = (
    "path string, start long, stop long, quotes long, delta array<long>, low array<long>, "
    "arrays array<struct<at:long,inside:boolean,depth:long,low:long>>"
)
_FAR = 1 << 40


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range and both states at its start: change and least of the depth, and arrays called features."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    kinds.append(pa.list_(pa.struct([("at", pa.int64()), ("inside", pa.bool_()), ("depth", pa.int64()), ("low", pa.int64())])))
    names = ["path", "start", "stop", "quotes", "delta", "low", "arrays"]
    for batch in batches:
        for row in batch.to_pylist():
            tail, escaped = _before(row["path"], row["start"])
            scans = [_Scan(inside, 0, escaped) for inside in (False, True)]
            low, arrays = [0, 0], []
            for at, chunk in _chunks(row["path"], row["start"]):
                chunk = chunk[: max(row["stop"] - at, 0)]
                if not chunk:
                    break
                joined = tail + chunk
                named = [m.end() - 1 - len(tail) for m in _FEATURES.finditer(joined) if m.end() > len(tail)]
                for k, scan in enumerate(scans):
                    _, string, depth = scan.read(chunk)
                    low[k] = min(low[k], int(depth.min()))
                    for own in arrays:
                        if own["inside"] == bool(k):
                            own["low"] = min(own["low"], int(depth.min()))
                    for place in named:
                        if not string[place]:
                            arrays.append({"at": at + place, "inside": bool(k), "depth": int(depth[place]) - 1, "low": int(depth[place:].min())})
                tail = joined[-LOOK:]
            quotes = int(scans[0].inside)
            values = [row["path"], row["start"], row["stop"], quotes, [s.depth for s in scans], low, arrays]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)


def range_states(spark: SparkSession, sized: DataFrame, size: int = RANGE) -> DataFrame:
    """``path, start, stop, inside, depth, opened``: the state at the start of each range that has features to look for.

    ``opened`` is where the ``features`` array begins. Files without one, and those whose brackets or strings do not close,
    have no ranges.
    """
    parts = ranges(sized, size).repartition(4 * spark.sparkContext.defaultParallelism, "path", "start")
    reports = settled(parts.mapInArrow(_report, _REPORT), "geojson-ranges")
    until = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    odd = F.coalesce(F.sum("quotes").over(until), F.lit(0)) % 2
    told = reports.withColumn("inside", odd == 1)
    side = F.when(F.col("inside"), 1).otherwise(0)
    told = told.withColumns({"delta": F.get("delta", side), "low": F.get("low", side)})
    told = told.withColumn("depth", F.coalesce(F.sum("delta").over(until), F.lit(0)))
    own = F.filter("arrays", lambda a: (a["inside"] == F.col("inside")) & (F.col("depth") + a["depth"] == 1))
    told = told.withColumn("array", F.get(F.array_sort(own), F.lit(0)))
    told = told.withColumn("opened", F.min("array.at").over(whole))
    # Depth 1 behind the array's begin is its end.
    here = F.col("array.at") == F.col("opened")
    low = F.when(here, F.col("depth") + F.col("array.low")).when(F.col("start") > F.col("opened"), F.col("depth") + F.col("low"))
    told = told.withColumn("_ended", F.coalesce(F.min(low).over(until), F.lit(_FAR)) < 2)
    sound = (F.sum("delta").over(whole) == 0) & (F.sum("quotes").over(whole) % 2 == 0)
    active = here | (F.col("start") > F.col("opened")) & ~F.col("_ended")
    return told.withColumn("_sound", sound).where(active & F.col("_sound")).select("path", "start", "stop", "inside", "depth", "opened")


def _features(row: dict) -> Iterator[tuple[int, bytes]]:
    """Place and text of the features that begin in a range."""
    scan = _Scan(row["inside"], row["depth"], _before(row["path"], row["start"])[1])
    begun, parts = None, []
    for at, chunk in _chunks(row["path"], row["start"]):
        data, string, depth = scan.read(chunk)
        places = np.arange(at, at + len(data))
        plain = ~string & (places > row["opened"])
        ends = np.flatnonzero(plain & (data == _CLOSE[1]) & (depth == 1))
        last = int(ends[0]) if len(ends) else len(data)
        starts = np.flatnonzero(plain[:last] & (data[:last] == _OPEN[0]) & (depth[:last] == 3) & (places[:last] < row["stop"])).tolist()
        closes = np.flatnonzero(plain[:last] & (data[:last] == _CLOSE[0]) & (depth[:last] == 2))
        if begun is not None:
            stop = closes[0] + 1 if len(closes) else len(chunk)
            parts.append(chunk[:stop])
            if not len(closes):
                continue
            yield begun, b"".join(parts)
            begun, parts = None, []
        for start, k in zip(starts, np.searchsorted(closes, starts).tolist()):
            if k < len(closes):
                yield at + start, chunk[start : closes[k] + 1]
            else:
                begun, parts = at + start, [chunk[start:]]
        if last < len(data) or begun is None and at + len(data) >= row["stop"]:
            return


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def page(path: str, offset: int, found: list[bytes]) -> pa.RecordBatch:
        body = (b'{"features":[' + b",".join(found) + b"]}").decode("utf-8", "replace")
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([offset], pa.int64()), pa.array([body])], names=["layer", "offset", "body"])

    for batch in batches:
        for row in batch.to_pylist():
            found: list[bytes] = []
            size = first = 0
            for at, text in _features(row):
                first = first if found else at
                found.append(text)
                size += len(text)
                if size > PAGE:
                    yield page(row["path"], first, found)
                    found, size = [], 0
            if found:
                yield page(row["path"], first, found)


def file_pages(spark: SparkSession, path: str | list[str], size: int = RANGE) -> DataFrame:
    """``layer, offset, body``: files as pages of features, with the path as layer and the place of the first feature.

    Every file has a page without features at offset -1, so that one without any is still seen.
    """
    listed = settled(files.listing(spark, path).select("path", "length"), "geojson-files")
    states = settled(range_states(spark, listed, size), "geojson-states")
    dealt = states.repartition(4 * spark.sparkContext.defaultParallelism, "path", "start")
    found = dealt.mapInArrow(_pages, "layer string, offset long, body string")
    empty = listed.select(F.col("path").alias("layer"), F.lit(-1).cast("long").alias("offset"), F.lit('{"features":[]}').alias("body"))
    return empty.unionByName(found)


def read_geojson(
    spark: SparkSession, path: str | list[str], attributes: T.StructType | str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Feature rows of collection files. Without a declared schema the attributes are inferred first."""
    bodies = file_pages(spark, path)
    if attributes is None:
        attributes = pages.infer_attributes(bodies, "properties")
    return pages.geojson_rows(bodies, attributes, keep)
