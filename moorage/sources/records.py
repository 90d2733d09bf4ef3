"""Records of delimited files whose quoted fields span lines, read in byte ranges by many tasks.

Whether a line break ends a record depends on every quote before it. So each range first reports what it does to either
state a file can be in at its start, between records or inside a quoted field; the states of all ranges follow from a
running composition of these reports; then each range yields the records that begin in it, the last one whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moorage.session import settled
from moorage.sources import files
from moorage.sources.files import filesystem

# Bytes of a range, of one read, and of the records sent on together.
RANGE, READ, BATCH = 32 << 20, 1 << 20, 4 << 20
MARK = b"\xef\xbb\xbf"
# Files that can only be read from their start; fixed values, by file extension.
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")


def ends_inside(line: bytes, separator: bytes, inside: bool) -> bool:
    """Whether a quoted field is open behind ``line``, given whether one is before it.

    A field is quoted if a quote is its first character; two quotes in it stand for one; what follows the closing quote
    belongs to the field. Quotes anywhere else are characters like others.
    """
    at, opening = 0, separator + b'"'
    if not inside:
        if line[:1] == b'"':
            at, inside = 1, True
        else:
            found = line.find(opening)
            if found < 0:
                return False
            at, inside = found + len(opening), True
    while True:
        at = line.find(b'"', at)
        if at < 0:
            return True
        if line[at + 1 : at + 2] == b'"':
            at += 2
            continue
        # Closed: on to the next field that opens with a quote.
        found = line.find(opening, at + 1)
        if found < 0:
            return False
        at = found + len(opening)


def lines_from(path: str, start: int) -> Iterator[tuple[int, list[bytes]]]:
    """Place and pieces of every line behind the first line feed at ``start - 1`` or later, or from the file's start.

    Lines end with a line feed; carriage returns inside one part it into pieces, which keep their ends.
    """
    fs, name = filesystem(path)
    if path.lower().endswith(COMPRESSED):
        source = fs.open_input_stream(name, compression="detect")
    else:
        source = fs.open_input_file(name)
        source.seek(max(start - 1, 0))
    with source:
        at, rest, started = max(start - 1, 0), [], start == 0
        while chunk := source.read(READ):
            if not started:
                cut = chunk.find(b"\n") + 1
                if not cut:
                    at += len(chunk)
                    continue
                at, chunk, started = at + cut, chunk[cut:], True
            *whole, tail = chunk.split(b"\n")
            for line in whole:
                line = b"".join([*rest, line, b"\n"]) if rest else line + b"\n"
                rest = []
                yield at, [line] if b"\r" not in line[:-2] else line.splitlines(keepends=True)
                at += len(line)
            if tail:
                rest.append(tail)
        if rest:
            yield at, b"".join(rest).splitlines(keepends=True)


def first_record(path: str, separator: bytes) -> bytes | None:
    """The first record that is not blank, without its line end; None in a file without any."""
    record, inside = b"", False
    for _, pieces in lines_from(path, 0):
        for piece in pieces:
            if inside or record or piece.removeprefix(MARK).strip():
                record += piece
                inside = ends_inside(piece.removeprefix(MARK) if record == piece else piece, separator, inside)
                if not inside:
                    return _bare(record)
    return _bare(record) or None


def _bare(record: bytes) -> bytes:
    return record.removesuffix(b"\n").removesuffix(b"\r")


def _effects(separator: bytes):
    """For each range, whether a field is open at its end if none, and if one, is open at its start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                closed, opened = False, True
                for at, pieces in lines_from(row["path"], row["start"]):
                    if at >= row["stop"]:
                        break
                    for piece in pieces:
                        if b'"' in piece:
                            piece = piece.removeprefix(MARK) if at == 0 else piece
                            closed, opened = ends_inside(piece, separator, closed), ends_inside(piece, separator, opened)
                row |= {"from_closed": closed, "from_open": opened}
            yield pa.RecordBatch.from_pylist(rows, _EFFECT)

    return run


_EFFECT = pa.schema(
    [("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("from_closed", pa.bool_()), ("from_open", pa.bool_())]
)


def ranges(sized: DataFrame, size: int = RANGE) -> DataFrame:
    """``path, start, stop`` of the ranges of files (``path, length``); a compressed file is one range."""
    whole = F.lower("path").rlike("(" + "|".join(f"\\{e}" for e in COMPRESSED) + ")$")
    step = F.when(whole, F.greatest("length", F.lit(1))).otherwise(F.lit(size))
    starts = sized.where("length > 0").select("path", whole.alias("whole"), F.explode(F.sequence(F.lit(0), F.col("length") - 1, step)).alias("start"))
    stop = F.when(F.col("whole"), F.lit((1 << 62))).otherwise(F.col("start") + size)
    return starts.select("path", "start", stop.alias("stop"))


def range_states(spark: SparkSession, paths: list[str], separator: str, size: int = RANGE) -> DataFrame:
    """``path, start, stop, inside``: whether a quoted field is open where the lines of each range begin."""
    parts = ranges(files.sizes(spark.createDataFrame([(p,) for p in paths], "path string")), size)
    dealt = parts.repartition(4 * spark.sparkContext.defaultParallelism, "path", "start")
    effects = dealt.mapInArrow(_effects(separator.encode()), "path string, start long, stop long, from_closed boolean, from_open boolean")
    effects = settled(effects, "range-effects")
    # An effect sets the state, or keeps it, or turns it over: the state before a range is what the last one that set it
    # left behind, turned over as often as later ones do.
    sets = F.col("from_closed") == F.col("from_open")
    turns = F.when(F.col("from_closed") & ~F.col("from_open"), 1).otherwise(0)
    until = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counted = effects.withColumn("turned", F.sum(turns).over(until.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(sets, F.struct("from_closed", "turned")), ignorenulls=True).over(until)
    before = F.coalesce(F.last("turned").over(until), F.lit(0))
    told = counted.select("path", "start", "stop", last.alias("last"), before.alias("before"))
    odd = (F.col("before") - F.coalesce("last.turned", F.lit(0))) % 2 == 1
    inside = F.coalesce("last.from_closed", F.lit(False)) != odd
    return settled(told.select("path", "start", "stop", inside.alias("inside")), "range-states")


def records(states: DataFrame, separator: str, encoding: str) -> DataFrame:
    """``source_file, record`` of every record behind the first of its file; blank lines between records are skipped."""
    mark, sep = (MARK if encoding == "UTF-8" else b""), separator.encode()

    def of_range(row: dict) -> Iterator[bytes]:
        inside, header, parts = row["inside"], row["start"] == 0, []
        # What is open at the start belongs to an earlier range.
        foreign = inside
        for at, pieces in lines_from(row["path"], row["start"]):
            if at >= row["stop"] and not inside:
                return
            for piece in pieces:
                if at == 0 and not parts:
                    piece = piece.removeprefix(mark)
                if not inside and not piece.strip():
                    continue
                inside = ends_inside(piece, sep, inside) if b'"' in piece else inside
                if not foreign:
                    parts.append(piece)
                if inside:
                    continue
                if foreign:
                    foreign = False
                    continue
                if header:
                    header = False
                else:
                    yield _bare(b"".join(parts))
                parts = []
            if at >= row["stop"] and not inside:
                return
        if parts and not header:
            yield _bare(b"".join(parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found: list[bytes] = []
                size = 0
                for record in of_range(row):
                    found.append(record)
                    size += len(record)
                    if size > BATCH:
                        yield table(row["path"], found)
                        found, size = [], 0
                if found:
                    yield table(row["path"], found)

    def table(path: str, found: list[bytes]) -> pa.RecordBatch:
        rows = [r.decode(encoding, "replace") for r in found]
        return pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), pa.array(rows, pa.string())], names=["source_file", "record"])

    dealt = states.repartition(4 * states.sparkSession.sparkContext.defaultParallelism, "path", "start")
    return dealt.mapInArrow(run, "source_file string, record string")
