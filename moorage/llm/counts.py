"""Token counts, with huge documents encoded in overlapping chunks that are spliced again.

Chunks of one document are rows of their own, so many tasks share it. Neighbours overlap; both report the token
boundaries they see in the overlap and the tokens before each. They are spliced at a boundary that both have and that is
proven stable: white space stands beside it, which no token of the vocabulary spans. Where the two have no such
boundary in common, the document is cut again with an overlap four times as wide, at last until a chunk is the whole document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import tasks, texts
from moorage.llm.tokens import WordCounts, shared
from moorage.session import settled

CHUNK, OVERLAP, LIMIT = 16_384, 256, 2048
TOKENIZER = "word_bpe_49k.json"


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``; null texts are empty and count 0.

    Repeated rows and equal or null ids are counted row by row. An empty table gives no rows. Special strings inside
    texts count as the library counts them; white space beside them is as stable as elsewhere.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias("text"))
    first = settled(_short_counts(rows, tokenizer, chunk + overlap), "token-counts")
    short = first.where("rest is null").select("doc_id", "n_bytes", "n_tokens")
    huge = first.where("rest is not null").select(F.monotonically_increasing_id().alias("rid"), "doc_id", "n_bytes", F.col("rest").alias("text"))
    counted = short.unionByName(spliced(settled(huge, "huge-texts"), tokenizer, chunk, overlap))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def _short_counts(rows: DataFrame, tokenizer: str, most: int) -> DataFrame:
    """Counts of texts up to ``most`` code points; longer ones come back as ``rest``, to be cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared(WordCounts, tokenizer)
        for batch in batches:
            own = texts(batch.column("text"))
            short = [len(t) <= most for t in own]
            found = iter(counts.count([t for t, is_short in zip(own, short) if is_short]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_bytes"),
                    pa.array([next(found) if is_short else None for is_short in short], pa.int64()),
                    pa.array([None if is_short else t for t, is_short in zip(own, short)], pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "rest"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, rest string")


MARKS = "array<struct<at:long,before:long>>"


def spliced(huge: DataFrame, tokenizer: str = TOKENIZER, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Counts of long texts (rid, doc_id, n_bytes, text), each encoded in chunks.

    A text has the tokens of its last chunk and, for each joint, those its left chunk has before the splice less those
    its right chunk has before it.
    """
    done, left = None, huge
    while True:
        pieces = _cut(left, chunk, overlap).repartition(tasks(huge), "rid", "k")
        ends = settled(pieces.mapInArrow(_encode(tokenizer, chunk, overlap), f"rid long, k int, last boolean, total long, low {MARKS}, high {MARKS}"), "chunk-ends")
        a, b = ends.where("not last"), ends.where("k > 0")
        joints = a.select("rid", (F.col("k") + 1).alias("k"), "high").join(b.select("rid", "k", "low"), ["rid", "k"])
        common = F.array_intersect("high.at", "low.at")
        before = lambda marks: F.get(F.filter(marks, lambda m: m["at"] == F.col("splice")), F.lit(0))["before"]
        joints = joints.withColumn("splice", F.try_element_at(common, F.lit(1)))
        joints = joints.select("rid", F.col("splice").isNull().alias("failed"), (before("high") - before("low")).alias("n"))
        parts = joints.unionByName(ends.where("last").select("rid", F.lit(False).alias("failed"), F.col("total").alias("n")))
        told = settled(parts.groupBy("rid").agg(F.sum("n").alias("n_tokens"), F.max("failed").alias("failed")), "splices")
        good = left.join(told.where("not failed"), "rid").select("doc_id", "n_bytes", "n_tokens")
        done = good if done is None else done.unionByName(good)
        if told.where("failed").isEmpty():
            return done
        left = settled(left.join(told.where("failed"), "rid", "left_semi"), "unaligned")
        overlap *= 4


def _cut(huge: DataFrame, chunk: int, overlap: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text in zip(batch.column("rid").to_pylist(), texts(batch.column("text"))):
                many = -(-len(text) // chunk)
                for k in range(many):
                    base = max(0, k * chunk - overlap)
                    row = (rid, k, k == many - 1, base, len(text), text[base : (k + 1) * chunk + overlap])
                    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], t) for v, t in zip(row, kinds)], names=["rid", "k", "last", "base", "n", "piece"]
                    )

    return huge.select("rid", "text").mapInArrow(run, "rid long, k int, last boolean, base long, n long, piece string")


def _encode(tokenizer: str, chunk: int, overlap: int):
    """Tokens of each chunk and its stable boundaries around either end, with the tokens before them."""
    marks = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))

    def stable(begins: np.ndarray, piece: str, base: int, n: int, at: int) -> list[dict]:
        inside = np.unique(begins[(begins >= at - overlap) & (begins <= at + overlap)])
        own = [p for p in inside.tolist() if p == 0 or p > base and piece[p - base - 1].isspace() and not "\x1c" <= piece[p - base - 1] <= "\x1f"]
        own += [n] if at + overlap >= n and base + len(piece) == n else []
        own = [0, *own] if at - overlap <= 0 and base == 0 and own[:1] != [0] else own
        return [{"at": p, "before": b} for p, b in zip(own, np.searchsorted(begins, own).tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = shared(WordCounts, tokenizer).tokenizer
        for batch in batches:
            rows = batch.to_pylist()
            low, high, total = [], [], []
            for row in rows:
                found = library.encode(row["piece"], add_special_tokens=False).offsets
                begins = np.array([a for a, _ in found], np.int64) + row["base"]
                low.append(stable(begins, row["piece"], row["base"], row["n"], row["k"] * chunk))
                high.append(stable(begins, row["piece"], row["base"], row["n"], (row["k"] + 1) * chunk))
                total.append(len(begins))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("k"), batch.column("last"), pa.array(total, pa.int64()), pa.array(low, marks), pa.array(high, marks)],
                names=["rid", "k", "last", "total", "low", "high"],
            )

    return run
