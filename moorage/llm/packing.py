"""Best-fit packing of documents into fixed-length sequences, improved by swap-based local search.

Documents are tokenised once. A document longer than a sequence is cut into full pieces behind a shorter first one, so
each document has at most one piece that must share a sequence. Those pieces are dealt into blocks of bounded size;
each block is packed best-fit and then improved: documents are moved, exchanged one for one or two for one between
underfull bins wherever that increases the sum of squared fills, until bins run empty. Bins still underfull meet those of
other blocks in a second round.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import texts
from moorage.llm.tokens import ByteIds, shared
from moorage.session import settled

LENGTH, END, TOKENIZER = 1024, 2, "byte_bpe_50k.json"
# Pieces packed by one task at a time.
BLOCK = 32_768
ROUNDS = 2

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, tokenizer: str = TOKENIZER) -> DataFrame:
    """Token pieces of every document, each with a number ``pid`` of its own; null texts are empty, one end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared(ByteIds, tokenizer)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            whole = [i + end for i in ids.encode(texts(batch.column("text")))]
            n = np.array([len(w) // 4 for w in whole], np.int64)
            many = -(-n // length)
            doc = np.repeat(np.arange(len(n)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            first = n - (many - 1) * length
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * length)
            size = np.where(piece == 0, first[doc], length)
            crc = [zlib.crc32(memoryview(whole[d])[4 * a : 4 * (a + m)]) for d, a, m in zip(doc.tolist(), start.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, PIECES.format(id=kind)).withColumn("pid", F.monotonically_increasing_id())


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, tokenizer: str = TOKENIZER, block: int = BLOCK) -> DataFrame:
    """Every piece of every document with its sequence and offset there.

    ``sequence_id`` is the ``pid`` of a member, so numbers are distinct without counting. Null ids, repeated rows and
    empty texts are packed like others (one end token at least); an empty table gives no rows.
    """
    own = settled(pieces(docs, key, text, length, tokenizer), "pieces")
    full = own.where(F.col("length") == length).select("pid", F.col("pid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_ = own.where(F.col("length") < length).select("pid", F.col("length").cast("int").alias("length"), F.col("pid").alias("bin"))
    blocks = max(1, -(-open_.count() // block))

    placed = None
    for turn in range(ROUNDS):
        dealt = open_.withColumn("block", F.pmod(F.xxhash64(F.lit(turn), "bin"), F.lit(blocks)))
        done = settled(dealt.groupBy("block").applyInPandas(_packer(length, fresh=turn == 0), "pid long, length int, bin long, offset long, fill int"), "bins")
        closed = done.where(F.col("fill") == length) if turn < ROUNDS - 1 else done
        closed = closed.select("pid", F.col("bin").alias("sequence_id"), "offset")
        placed = closed if placed is None else placed.unionByName(closed)
        open_ = done.where(F.col("fill") < length).select("pid", "length", "bin")
    return own.join(full.unionByName(placed), "pid").drop("pid")


def _packer(length: int, fresh: bool):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        pids, sizes = block["pid"].to_numpy(), block["length"].to_numpy()
        order = np.lexsort((pids, sizes))
        pids, sizes = pids[order], sizes[order]
        waiting: dict[int, list[int]] = defaultdict(list)
        for pid, size in zip(pids.tolist(), sizes.tolist()):
            waiting[size].append(pid)
        if fresh:
            bins = best_fit(sizes.tolist(), length)
        else:
            bins = [own.tolist() for _, own in block.groupby("bin")["length"]]
        bins = improve(bins, length)
        out = []
        # Pieces of one length are alike; bins take them in order.
        for own in bins:
            chosen, offset, fill = [], 0, sum(own)
            for size in own:
                chosen.append((waiting[size].pop(), size))
            name = min(pid for pid, _ in chosen)
            for pid, size in chosen:
                out.append((pid, size, name, offset, fill))
                offset += size
        return pd.DataFrame(out, columns=["pid", "length", "bin", "offset", "fill"])

    return run


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Best fit in falling order of size: each piece goes to the fullest bin that takes it."""
    by_room: dict[int, list[list[int]]] = defaultdict(list)
    rooms: list[int] = []
    for size in sorted(sizes, reverse=True):
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            own = by_room[room].pop()
            if not by_room[room]:
                del rooms[at]
        else:
            room, own = length, []
        own.append(size)
        if room > size:
            if not by_room[room - size]:
                insort(rooms, room - size)
            by_room[room - size].append(own)
        else:
            by_room[0].append(own)
    return [own for bins in by_room.values() for own in bins]


def fewest(sizes: list[int], length: int) -> int:
    """A lower bound of the bins: for each limit, large pieces need bins of their own and middle ones fill their rest."""
    if not sizes:
        return 0
    many = np.bincount(np.array(sizes), minlength=length + 1)
    count, total = np.cumsum(many), np.cumsum(many * np.arange(length + 1))
    half, bound = length // 2, -(-int(total[-1]) // length)
    for limit in range(half + 1):
        alone = int(count[length] - count[length - limit])
        large, taken = int(count[length - limit] - count[half]), int(total[length - limit] - total[half])
        middle = int(total[half] - (total[limit - 1] if limit else 0))
        bound = max(bound, alone + large + max(0, -(-(middle - (large * length - taken)) // length)))
    return bound


def improve(bins: list[list[int]], length: int) -> list[list[int]]:
    """Local search over underfull bins until no exchange increases the sum of squared fills.

    Fuller bins are served first. A bin takes a piece (move), a larger piece for one of its own (one for one) or two
    pieces for one (two for one), always so that the giving bin ends less full than the taking one: each step
    increases the sum, and the largest gain that fits is taken first. The search ends early where a lower bound
    proves that no bin can run empty any more.
    """
    spare = len(bins) - fewest([size for own in bins for size in own], length)
    done = [own for own in bins if sum(own) == length]
    state = _Bins([list(own) for own in bins if own and sum(own) < length])
    for target in sorted(range(len(state.bins)), key=lambda i: (-state.fills[i], i)):
        while spare and 0 < state.fills[target] < length:
            step = state.best(target, length - state.fills[target])
            if step is None:
                break
            giver, taken, given = step
            state.change(giver, taken, (given,) if given else ())
            state.change(target, (given,) if given else (), taken)
            spare -= not state.bins[giver]
    return done + [own for own in state.bins if own]


class _Bins:
    """Underfull bins, found by the size of a piece or of a pair of pieces that they hold."""

    def __init__(self, bins: list[list[int]]):
        self.bins, self.fills = bins, [sum(own) for own in bins]
        self.one: dict[int, set[int]] = defaultdict(set)
        self.two: dict[int, set[int]] = defaultdict(set)
        for i in range(len(bins)):
            self._enter(i)

    def _pairs(self, i: int) -> set[int]:
        own = sorted(self.bins[i])
        kinds = sorted(set(own))
        sums = {a + b for k, a in enumerate(kinds) for b in kinds[k + 1 :]}
        return sums | {2 * a for a, b in zip(own, own[1:]) if a == b}

    def _enter(self, i: int) -> None:
        for size in set(self.bins[i]):
            self.one[size].add(i)
        for size in self._pairs(i):
            self.two[size].add(i)

    def change(self, i: int, out: tuple[int, ...], into: tuple[int, ...]) -> None:
        for size in set(self.bins[i]):
            self.one[size].discard(i)
        for size in self._pairs(i):
            self.two[size].discard(i)
        for size in out:
            self.bins[i].remove(size)
        self.bins[i].extend(into)
        self.fills[i] += sum(into) - sum(out)
        self._enter(i)

    def best(self, target: int, room: int) -> tuple[int, tuple[int, ...], int] | None:
        """The giving bin, what it gives, and what it gets back (0: nothing)."""
        own = (0, *sorted(set(self.bins[target])))
        for gain in range(room, 0, -1):
            for given in own:
                i = self._giver(self.one.get(given + gain), target, gain)
                if i is not None:
                    return i, (given + gain,), given
                i = self._giver(self.two.get(given + gain), target, gain)
                if i is not None:
                    a = next(x for x in self.bins[i] if given + gain - x in self.bins[i] and (2 * x != given + gain or self.bins[i].count(x) > 1))
                    return i, (a, given + gain - a), given
        return None

    def _giver(self, holders: set[int] | None, target: int, gain: int) -> int | None:
        limit = self.fills[target] + gain
        for i in holders or ():
            if i != target and self.fills[i] < limit:
                return i
        return None
