"""Document fingerprints by locally consistent parsing.

A text is parsed level by level. Runs of one symbol become one symbol; deterministic coin tossing (the lowest bit in which a
symbol differs from the one before, with that bit) shrinks symbols to six labels in which neighbours differ; a phrase
begins at each local maximum of the labels. The name of a phrase hashes its symbols and is a symbol of the next
level. Where a phrase begins depends on a few symbols around it, so equal substrings have equal phrases inside,
whatever their offset. A fingerprint keeps, in each of 128 parts of the hash space, one byte of the smallest phrase
name of the upper levels; the share of equal parts estimates how many phrases two texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorage.llm.common import mix, run_starts, tasks, texts
from moorage.session import settled

# Levels whose phrases are kept: of about 6 and 15 characters in prose.
KEPT = (2, 3)
PARTS = 128
# Rounds of coin tossing that bring 64-bit symbols to labels below six.
TOSSES = 4
# Code points parsed at a time.
BLOCK = 1 << 18

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit that differs from the symbol before, plus that bit."""
    differ = x.copy()
    differ[1:] ^= x[:-1]
    differ[first] = 1
    np.maximum(differ, 1, out=differ)
    lowest = differ & (~differ + differ.dtype.type(1))
    place = np.bitwise_count(lowest - differ.dtype.type(1))
    return 2 * place + ((x >> place.astype(x.dtype)) & x.dtype.type(1)).astype(np.uint8)


def next_level(symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of each text, and how many each text has."""
    if not len(symbols):
        return symbols, counts
    first = np.zeros(len(symbols) + 1, bool)
    first[run_starts(counts)] = True
    first = first[:-1]

    change = first.copy()
    change[1:] |= symbols[1:] != symbols[:-1]
    at = np.flatnonzero(change)
    run = np.diff(np.append(at, len(symbols))).astype(np.uint64)
    own, first = symbols[at], first[at]
    if len(at) < len(symbols):
        own = np.where(run > 1, mix(own + run * _B), own)

    labels = own
    for _ in range(TOSSES):
        labels = _toss(labels, first)
    height = labels + np.uint8(1)
    before = np.zeros_like(height)
    before[1:] = height[:-1]
    before[first] = 0
    after = np.zeros_like(height)
    after[:-1] = np.where(first[1:], 0, height[1:])
    cut = first | ((height > before) & (height > after))

    begin = np.flatnonzero(cut)
    size = np.diff(np.append(begin, len(own)))
    place = (np.arange(len(own)) - np.repeat(begin, size)).astype(np.uint64)
    x = (own + place * _A) * _C
    names = mix(np.add.reduceat(x ^ (x >> np.uint64(31)), begin) + size.astype(np.uint64) * _B)
    owner = np.cumsum(first[begin])
    return names, np.bincount(np.flatnonzero(counts)[owner - 1], minlength=len(counts))


def _symbols(own: list[str]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return points, np.array([len(t) for t in own], np.int64)


def _blocks(own: list[str]) -> Iterator[list[str]]:
    block, size = [], 0
    for text in own:
        if block and size + len(text) > BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def fingerprints(own: list[str]) -> np.ndarray:
    """A row of ``PARTS`` bytes for each text; 0 marks a part without phrases, so an empty text has zeros only."""
    out = [np.zeros((0, PARTS), np.uint8)]
    for block in _blocks(own):
        symbols, counts = _symbols(block)
        keys = []
        for level in range(1, max(KEPT) + 1):
            symbols, counts = next_level(symbols, counts)
            if level in KEPT:
                drawn = mix(symbols + np.uint64(level))
                part = np.repeat(np.arange(len(block)), counts).astype(np.uint64) * np.uint64(PARTS) + (drawn >> np.uint64(57))
                keys.append((part << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF)))
        key = np.sort(np.concatenate(keys))
        part = key >> np.uint64(32)
        least = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(key) else np.zeros(0, int)
        rows = np.zeros(len(block) * PARTS, np.uint8)
        rows[part[least].astype(np.int64)] = (key[least] & np.uint64(0xFFFF)) % np.uint64(255) + np.uint64(1)
        out.append(rows.reshape(len(block), PARTS))
    return np.concatenate(out)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for rows of fingerprints: equal parts among those that either has, less what bytes agree by chance."""
    either = ((a > 0) | (b > 0)).sum(1)
    equal = ((a == b) & (a > 0)).sum(1)
    share = np.where(either > 0, equal / np.maximum(either, 1), 1.0)
    return np.clip((share - 1 / 255) / (1 - 1 / 255), 0.0, 1.0)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the beginning of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


SCHEMA = (
    "doc_id {id}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _rows(ids: pa.Array, own: list[str], prints: np.ndarray, following: list[str], next_prints: np.ndarray) -> dict[str, pa.Array]:
    changed = [edited(a, b) for a, b in zip(own, following)]
    changed_prints = fingerprints(changed)
    hexes = lambda rows: pa.array([r.tobytes().hex() for r in rows], pa.string())
    return {
        "doc_id": ids,
        "n_chars": pa.array([len(t) for t in own], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
        "fingerprint": hexes(prints),
        "edited_fingerprint": hexes(changed_prints),
        "near_edited": pa.array(likeness(prints, changed_prints)),
        "near_next": pa.array(likeness(prints, next_prints)),
    }


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike the next text in ascending id order is.

    Null texts are empty. Null ids come first; rows with equal ids are ordered by a hash of their text. After the last
    row comes the first; a single row is followed by itself. An empty table gives no rows. Rows are range-partitioned
    by id, streamed in order, and only the last row of each partition waits for the first of the next.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("tie"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "tie", "row"]
    sorted_rows = rows.repartitionByRange(tasks(docs), *order).sortWithinPartitions(*order)
    sorted_rows = sorted_rows.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = SCHEMA.format(id=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: str | None = None
        wait: tuple[pa.Array, str, np.ndarray] | None = None

        def out(columns: dict[str, pa.Array], head: str | None, tail: str | None, part: int) -> pa.RecordBatch:
            n = len(columns["doc_id"])
            heads = pa.array([head] + [None] * (n - 1) if n else [], pa.string())
            return pa.RecordBatch.from_pydict(
                {**columns, "part": pa.array([part] * n, pa.int32()), "head": heads, "tail": pa.array([tail] * n, pa.string())}
            )

        part = 0
        for batch in batches:
            if not len(batch):
                continue
            part = batch.column("part")[0].as_py()
            ids, own = batch.column("doc_id"), texts(batch.column("text"))
            prints = fingerprints(own)
            if wait is not None:
                ids = pa.concat_arrays([wait[0], ids])
                own, prints = [wait[1], *own], np.concatenate([wait[2], prints])
            wait = (ids[-1:], own[-1], prints[-1:])
            if len(own) > 1:
                opening = own[0] if head is None else None
                head = own[0] if head is None else head
                yield out(_rows(ids[:-1], own[:-1], prints[:-1], own[1:], prints[1:]), opening, None, part)
        if wait is not None:
            last = {
                "doc_id": wait[0],
                "n_chars": pa.array([len(wait[1])], pa.int64()),
                "edited_sha256": pa.array([None], pa.string()),
                "fingerprint": pa.array([wait[2][0].tobytes().hex()]),
                "edited_fingerprint": pa.array([None], pa.string()),
                "near_edited": pa.array([None], pa.float64()),
                "near_next": pa.array([None], pa.float64()),
            }
            yield out(last, wait[1] if head is None else None, wait[1], part)

    told = settled(sorted_rows.mapInArrow(run, f"{schema}, part int, head string, tail string"), "fingerprints")

    # One row a partition from here on.
    heads = told.where("head is not null").select("part", "head", F.col("fingerprint").alias("next_fingerprint"))
    everything = Window.orderBy("part")
    following = heads.select("part", F.coalesce(F.lead("part").over(everything), F.first("part").over(everything)).alias("next_part"))
    edge = told.where("tail is not null").select("part", "doc_id", F.col("tail").alias("text"), "fingerprint")
    edge = edge.join(following, "part").join(heads.withColumnRenamed("part", "next_part"), "next_part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, next_prints = (
                np.frombuffer(bytes.fromhex("".join(batch.column(c).to_pylist())), np.uint8).reshape(-1, PARTS)
                for c in ("fingerprint", "next_fingerprint")
            )
            own, following = texts(batch.column("text")), texts(batch.column("head"))
            yield pa.RecordBatch.from_pydict(_rows(batch.column("doc_id"), own, prints, following, next_prints))

    closed = edge.select("doc_id", "text", "head", "fingerprint", "next_fingerprint").mapInArrow(close, schema)
    return told.where("tail is null").drop("part", "head", "tail").unionByName(closed)
