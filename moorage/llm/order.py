"""Training-order materialisation: every sequence gets a global slot, and slots lie in fixed-stride shard files.

Documents are tokenised and cut into sequences. A first pass counts the sequences of each document, which numbers them
0 to N - 1; a keyed Feistel network permutes a power of four above N, and walking its cycle until the value is below N
makes it a permutation of 0 to N - 1. Sequences are then range-partitioned by slot, and each partition writes one
shard: records of equal length in slot order, so a reader finds any slot by arithmetic and resumes anywhere.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import mix, texts
from moorage.llm.tokens import ByteIds, shared
from moorage.session import settled
from moorage.sources.files import filesystem

LENGTH, END, TOKENIZER = 512, 50_256, "byte_bpe_50k.json"
KEY, FEISTEL_ROUNDS = 0x5EED, 6
# Sequences of one shard file.
PER_SHARD = 32_768


def feistel(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slots of ``index`` under the permutation of 0 to n - 1 named by ``key``."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    # Keys wrap as 64-bit words do.
    keys = mix(np.arange(1, FEISTEL_ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & (1 << 64) - 1))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return (left << half) | right

    slots = once(index.astype(np.uint64))
    while (walking := slots >= n).any():
        slots[walking] = once(slots[walking])
    return slots.astype(np.int64)


def _numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.spark_partition_id().alias("part"), F.col(key).alias("doc_id"), F.col(text).alias("text"))


def _first_numbers(numbered: DataFrame, length: int, tokenizer: str) -> dict[int, tuple[int, int]]:
    """For each partition of the scan, the number of its first sequence and how many it has: one entry a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared(ByteIds, tokenizer)
        part, many = None, 0
        for batch in batches:
            many += sum((n + length) // length for n in ids.lengths(texts(batch.column("text"))))
            part = batch.column("part")[0].as_py() if len(batch) else part
        if many:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([many], pa.int64())], names=["part", "many"])

    firsts, total = {}, 0
    for part, many in sorted(numbered.select("part", "text").mapInArrow(run, "part int, many long").collect()):
        firsts[part] = (total, many)
        total += many
    return firsts


def cut_records(ids: bytes, most: int, fill: bytes) -> Iterator[bytes]:
    """Records of at most ``most`` bytes of ids: their count, the ids, and ``fill`` behind them."""
    for at in range(0, len(ids), most):
        own = ids[at : at + most]
        yield (len(own) // 2).to_bytes(2, "little") + own + fill[len(own) :]


def training_order(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    seed: int = KEY,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    tokenizer: str = TOKENIZER,
) -> DataFrame:
    """Writes the shard files below ``path`` and returns a row for each sequence, its place and digest.

    A record is the count of its tokens and ``length`` ids, all little-endian unsigned 16-bit; the end id fills up. Null
    texts are empty and make one sequence of an end id. Equal rows and ids are numbered row by row; an empty table
    writes nothing. An id beyond 16 bits raises. Numbers follow the scan: both passes read the same partitions, which is checked, so ``docs`` must
    be a deterministic frame, such as files. A repeated task replaces its file by an equal one.
    """
    numbered = _numbered(docs, key, text)
    firsts = _first_numbers(numbered, length, tokenizer)
    n = sum(many for _, many in firsts.values())
    kind = numbered.schema["doc_id"].dataType.simpleString()
    end = np.array([END], "<u2").tobytes() if END <= 0xFFFF else b""
    if not end:
        raise OverflowError("the end id does not fit 16 bits")
    fill = end * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared(ByteIds, tokenizer)
        number = stop = None
        for batch in batches:
            if not len(batch):
                continue
            if number is None:
                number, many = firsts[batch.column("part")[0].as_py()]
                stop = number + many
            whole = ids.short(texts(batch.column("text")))
            many = np.array([(len(own) // 2 + length) // length for own in whole], np.int64)
            doc = np.repeat(np.arange(len(whole)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            records = [record for own in whole for record in cut_records(own + end, 2 * length, fill)]
            slots = feistel(np.arange(number, number + len(doc)), n, seed)
            number += len(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(slots),
                    batch.column("doc_id").take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(records, pa.binary()),
                ],
                names=["slot", "doc_id", "piece", "record"],
            )
        if number != stop:
            raise RuntimeError("the documents changed between the two passes")

    shards = max(1, -(-n // per_shard))
    records = numbered.mapInArrow(cut, f"slot long, doc_id {kind}, piece int, record binary")
    dealt = records.repartitionById(shards, F.floor(F.col("slot") / per_shard).cast("int")).sortWithinPartitions("slot")
    schema = f"slot long, shard int, byte_offset long, doc_id {kind}, piece int, n_tokens int, ids_crc32 long"
    return settled(dealt.mapInArrow(_writer(path, per_shard), schema), "training-order")


def shard_name(path: str, shard: int) -> str:
    return f"{path}/shard-{shard:06d}.bin"


def _writer(path: str, per_shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = out = None
        fs, root = filesystem(path)
        staged = f"{root}/.{uuid.uuid4().hex}"
        for batch in batches:
            if not len(batch):
                continue
            slots = batch.column("slot").to_numpy()
            records = batch.column("record").to_pylist()
            if out is None:
                shard = int(slots[0]) // per_shard
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(staged)
            out.write(b"".join(records))
            counts = [int.from_bytes(r[:2], "little") for r in records]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("slot"),
                    pa.array(np.full(len(slots), shard, np.int32)),
                    pa.array((slots - shard * per_shard) * len(records[0])),
                    batch.column("doc_id"),
                    batch.column("piece"),
                    pa.array(counts, pa.int32()),
                    pa.array([zlib.crc32(memoryview(r)[2 : 2 + 2 * c]) for r, c in zip(records, counts)], pa.int64()),
                ],
                names=["slot", "shard", "byte_offset", "doc_id", "piece", "n_tokens", "ids_crc32"],
            )
        if out is not None:
            out.close()
            fs.move(staged, filesystem(shard_name(path, shard))[1])

    return run


def read_slots(path: str, first: int, many: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> Iterator[np.ndarray]:
    """Token ids of ``many`` slots from ``first`` on, read in sequence with one seek a file."""
    stride, slot, stop = 2 * (length + 1), first, first + many
    while slot < stop:
        shard, place = divmod(slot, per_shard)
        here = min(stop - slot, per_shard - place)
        fs, name = filesystem(shard_name(path, shard))
        with fs.open_input_file(name) as data:
            data.seek(place * stride)
            for _ in range(here):
                record = np.frombuffer(data.read(stride), "<u2")
                yield record[1 : 1 + record[0]]
        slot += here
