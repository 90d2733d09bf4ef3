"""What the operators share: session preparation, Arrow columns, word codes and 64-bit mixing."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from moorage.session import ship

# Bytes and rows of one Arrow batch sent to Python: they bound a task's memory whatever the length of the texts.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1000
# Words that one worker remembers before it starts anew.
WORD_LIMIT = 200_000


def prepare(spark: SparkSession) -> SparkSession:
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def tasks(df: DataFrame) -> int:
    """How many partitions a shuffle of this session makes."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def tidy(run: Callable) -> Callable:
    """An Arrow function that gives back what each batch has freed; workers live on after their task."""

    @functools.wraps(run)
    def out(batches):
        for result in run(batches):
            yield result
            del result
            _give_back()

    return out


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while the frame has such a column."""
    while name.lower() in (c.lower() for c in df.columns):
        name = "_" + name
    return name


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Whole texts, null as empty."""
    return [t or "" for t in column.to_pylist()]


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of whole texts, null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


class WordCodes(dict):
    """64-bit codes of words (bytes), remembered while a worker lives."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = self.code(word)
        return code

    def code(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)

    def of(self, split: Iterable[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words one after another, and how many each text has."""
        if len(self) > WORD_LIMIT:
            self.clear()
        words: list[bytes] = []
        counts: list[int] = []
        for own in split:
            words += own
            counts.append(len(own))
        return (
            np.fromiter(map(self.__getitem__, words), np.uint64, len(words)),
            np.array(counts, np.int64),
        )


# One memory for all operators that take words as they are.
WORDS = WordCodes()


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: a bijection of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def run_starts(counts: np.ndarray) -> np.ndarray:
    """First position of each run, and the total at the end."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


# Odd multipliers of the five places of a shingle.
_PLACES = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(codes: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Codes of every window of ``size`` words inside each text, and how many each text has.

    A text of fewer words has one window, the whole sequence; a text without words has none.
    """
    starts = run_starts(counts)
    many = np.maximum(counts - size + 1, np.minimum(counts, 1))
    first = np.repeat(starts[:-1], many) + _within(many)
    total = np.zeros(len(first), np.uint64)
    ends = np.repeat(starts[1:], many)
    short = bool(len(counts)) and bool((counts < size).any())
    padded = np.concatenate([codes, np.zeros(size, np.uint64)])
    for place in range(size):
        word = padded[first + place]
        if short:
            word = np.where(first + place < ends, word, np.uint64(0))
        total += (word ^ (word >> np.uint64(29))) * _PLACES[place]
    return mix(total), many


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. inside each run."""
    starts = run_starts(counts)
    return np.arange(starts[-1]) - np.repeat(starts[:-1], counts)
