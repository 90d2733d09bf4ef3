"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata of a text.

Words are hashed into slots, with normalised logarithmic counts; statistics of form (letters, marks, lines, repeats) and
metadata (lengths) are cut into bins, one slot each. Every slot has a weight and a low-rank vector; interactions of all
pairs of a document's slots are summed in linear time as half of (square of the sum less the sum of squares).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import WORDS, raw_texts, run_starts, shingles, tidy

SLOTS, BINS, RANK = 1 << 14, 8, 8
# Labelled rows to learn from at most: those with the smallest hashes.
SAMPLE = 8192
EPOCHS, BATCH, RATE, DECAY, SEED = 12, 128, 0.05, 1e-4, 11
KEEP = 0.7

# Classes of bytes whose shares of the text are statistics.
_CLASSES = [
    bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), b" ", b"\n", b".,;:?'\"()-", b"!", b"|", b"#$%&*",
    b"@/\\_<>{}[]=+~^`", bytes(range(128, 256)),
]
_CLASS = np.full(256, len(_CLASSES), np.uint8)
for _i, _members in enumerate(_CLASSES):
    _CLASS[list(_members)] = _i
STATISTICS = len(_CLASSES) + 1 + 11


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[starts[1:]] - sums[starts[:-1]]


def describe(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Statistics of each text, and its word slots with values (slots, values, how many each text has)."""
    n = np.array([len(t) for t in raw], np.int64)
    starts = run_starts(n)
    kinds = _CLASS[np.frombuffer(b"".join(raw), np.uint8)]
    shares = [_share(_per_text(kinds == k, starts), n) for k in range(len(_CLASSES) + 1)]

    codes, words = WORDS.of(t.split() for t in raw)
    first = run_starts(words)
    text = np.repeat(np.arange(len(raw)), words)
    grams, many = shingles(codes, words)
    gram_text = np.repeat(np.arange(len(raw)), many)
    again = np.concatenate([[False], (codes[1:] == codes[:-1]) & (text[1:] == text[:-1])]) if len(codes) else np.zeros(0, bool)

    def distinct(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((values, owner))
        v, o = values[order], owner[order]
        new = np.concatenate([[True], (v[1:] != v[:-1]) | (o[1:] != o[:-1])]) if len(v) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        return o[at], np.diff(np.append(at, len(v)))

    owner, repeats = distinct(codes, text)
    top = np.zeros(len(raw), np.int64)
    np.maximum.at(top, owner, repeats)
    gram_owner, _ = distinct(grams, gram_text)
    letters = _per_text(kinds <= 1, starts)
    lines = _per_text(kinds == 4, starts) + 1
    stats = np.column_stack(
        [
            *shares,
            _share(_per_text(kinds == 0, starts), letters),
            _share(np.bincount(owner, minlength=len(raw)), words),
            _share(top, words),
            _share(_per_text(again, first), words),
            _share(np.bincount(gram_owner, minlength=len(raw)), many),
            _share(n, words),
            _share(words, lines),
            _share(_per_text(kinds == 5, starts), words),
            np.log1p(words),
            np.log1p(n),
            np.log1p(lines),
        ]
    )
    slots, owners = (codes >> np.uint64(50)).astype(np.int64), text
    both = owners * SLOTS + slots
    both.sort()
    new = np.concatenate([[True], both[1:] != both[:-1]]) if len(both) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    value = np.log1p(np.diff(np.append(at, len(both))))
    owner, slot = both[at] // SLOTS, both[at] % SLOTS
    norm = np.sqrt(np.bincount(owner, value**2, len(raw)))
    return stats, slot, (value / norm[owner]).astype(np.float32), np.bincount(owner, minlength=len(raw))


class Machine:
    """Weights and vectors of all slots; learns by AdaGrad on the logistic loss."""

    def __init__(self, edges: np.ndarray):
        self.edges = edges
        total = SLOTS + STATISTICS * BINS
        draw = np.random.default_rng(SEED)
        self.bias, self.weight = 0.0, np.zeros(total, np.float32)
        self.vector = draw.normal(0, 0.02, (total, RANK)).astype(np.float32)

    def rows(self, stats: np.ndarray, slot: np.ndarray, value: np.ndarray, many: np.ndarray):
        """Slots and values of whole rows: the bins of statistics, then words."""
        bins = np.zeros(stats.shape, np.int64)
        for k, edge in enumerate(self.edges):
            bins[:, k] = np.searchsorted(edge, stats[:, k], "right")
        fixed = SLOTS + np.arange(STATISTICS) * BINS + bins
        starts = run_starts(many + STATISTICS)
        slots, values = np.empty(starts[-1], np.int64), np.ones(starts[-1], np.float32)
        places = starts[:-1, None] + np.arange(STATISTICS)
        slots[places] = fixed
        values[places] = 1 / np.sqrt(STATISTICS)
        free = np.ones(len(slots), bool)
        free[places] = False
        slots[free], values[free] = slot, value
        return slots, values, starts

    def score(self, slots: np.ndarray, values: np.ndarray, starts: np.ndarray):
        v = self.vector[slots] * values[:, None]
        linear = np.add.reduceat(self.weight[slots] * values, starts[:-1])
        total = np.add.reduceat(v, starts[:-1])
        squares = np.add.reduceat(v**2, starts[:-1])
        return self.bias + linear + 0.5 * (total**2 - squares).sum(1), v, total

    def probability(self, raw: list[bytes]) -> np.ndarray:
        if not raw:
            return np.zeros(0)
        z = self.score(*self.rows(*describe(raw)))[0]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def learn(self, stats, slot, value, many, labels: np.ndarray) -> None:
        slots, values, starts = self.rows(stats, slot, value, many)
        draw = np.random.default_rng(SEED)
        size = len(self.weight)
        g0, gw, gv = 1e-8, np.full(size, 1e-8, np.float32), np.full((size, RANK), 1e-8, np.float32)
        for _ in range(EPOCHS):
            for own in np.array_split(draw.permutation(len(labels)), -(-len(labels) // BATCH)):
                many_own = starts[own + 1] - starts[own]
                at = np.repeat(starts[own] - run_starts(many_own)[:-1], many_own) + np.arange(many_own.sum())
                s, x, begins = slots[at], values[at], run_starts(many_own)
                z, v, total = self.score(s, x, begins)
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[own]) / len(own)
                spread = np.repeat(error, many_own)
                used, where = np.unique(s, return_inverse=True)
                w_step = np.bincount(where, spread * x) + DECAY * self.weight[used]
                each = (spread * x)[:, None] * (np.repeat(total, many_own, 0) - v)
                v_step = np.column_stack([np.bincount(where, each[:, f]) for f in range(RANK)]) + DECAY * self.vector[used]
                step = float(error.sum())
                g0 += step**2
                self.bias -= RATE * step / g0**0.5
                gw[used] += w_step**2
                self.weight[used] -= RATE * w_step / np.sqrt(gw[used])
                gv[used] += v_step**2
                self.vector[used] -= RATE * v_step / np.sqrt(gv[used])


def learning(key: Column) -> Column:
    """Rows whose labels may be learnt; the others are held out."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) != 2


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Machine:
    """A machine learnt from at most ``sample`` labelled documents, the same for the same rows in any order.

    Rows without label or id are not learnt from. With no labelled rows every score is 0.5.
    """
    usable = labels.where(learning(F.col(key)) & F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(label).alias("label"))
    chosen = usable.orderBy(F.xxhash64("key"), "key").limit(sample)
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats, slot, value, many = describe(raw_texts(batch.column("text")))
            ends = run_starts(many)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("label"),
                    pa.array([row.tobytes() for row in stats], pa.binary()),
                    pa.array([slot[a:b].astype("<u2").tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                    pa.array([value[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                ],
                names=["key", "label", "stats", "slots", "values"],
            )

    kind = own.schema["key"].dataType.simpleString()
    rows = own.join(chosen, "key").select("key", F.col("label").cast("int").alias("label"), "text")
    got = rows.mapInArrow(run, f"key {kind}, label int, stats binary, slots binary, values binary")
    # A key may be repeated in the documents; the bound holds all the same.
    got = got.orderBy("key", F.xxhash64("slots", "values"), "stats").limit(sample).toArrow()
    if not len(got):
        blank = Machine(np.zeros((STATISTICS, BINS - 1)))
        blank.vector[:] = 0
        return blank
    stats = np.frombuffer(b"".join(got.column("stats").to_pylist())).reshape(len(got), STATISTICS)
    slots = [np.frombuffer(b, "<u2") for b in got.column("slots").to_pylist()]
    values = np.frombuffer(b"".join(got.column("values").to_pylist()), np.float32)
    machine = Machine(np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T.copy())
    machine.learn(stats, np.concatenate(slots).astype(np.int64), values, np.array([len(s) for s in slots]), np.array(got.column("label").to_pylist(), np.float64))
    return machine


def quality(machine: Machine, text: Column) -> Column:
    """The score of a text: how likely its label is 1. Null texts are empty."""

    @tidy
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            yield pa.array(machine.probability(raw_texts(array)))

    return F.arrow_udf(run, "double")(text)


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; null ids count as learnt from (their crc is null)."""
    machine = fit(docs, labels, key, text)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(~learning(F.col(key)), F.lit(False)).alias("held_out"), quality(machine, F.col(text)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= keep).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    return docs.where(quality(fit(docs, labels, key, text), F.col(text)) >= keep)
