"""Runs of periodic words inside texts, found through suffix trees, and texts without their repetitions.

A run is a stretch of words in which words q apart are equal, q being its smallest period, that no neighbour extends.
Every run of at least two periods has a Lyndon root: for one of two opposite orders of the words, the longest Lyndon word
at some place of its first period is as long as the period. So the longest Lyndon words at all places, in both orders,
are all candidates, twice as many as words; each is extended to both sides by the longest common extension of two
places. Those come from Ukkonen suffix trees of the words and of their reversal: the depth of the lowest common ancestor
of two leaves, looked up in a sparse table over the Euler tour.

Trees are built of the parts that can hold a run at all. In a run of 24 words and three periods or more, every window of
eight words has its like one period away, so words in no window that occurs twice in their text lie in no run, and a run
never reaches beyond the stretch of words between them. Parts of several texts, each closed by a symbol of its own,
share a tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.llm.bytebpe import blocks
from moorage.llm.common import WORDS, mix, raw_texts, run_starts, tidy

# A run has at least this many words and this many periods.
WORDS_LEAST, PERIODS_LEAST = 24, 3
# Words of the windows that tell where runs can be. A window of w words in a run of period q has its like inside the run
# if the run has 2 * q + w - 1 words or more: 24 suffice up to q = 8, and 3 * q from there on.
WINDOW = 8
# Symbols of one tree, where parts are that short.
TREE = 1 << 15
# Bytes of text handled together.
TEXT_BLOCK = 1 << 21


class SuffixTree:
    """Ukkonen's suffix tree of whole numbers whose last is unique; ``extensions`` gives common prefixes of suffixes."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        parent, first, symbol, depth, leaf_of = _ukkonen(symbols)
        self._tour(parent, symbol, depth, leaf_of)

    def _tour(self, parent: np.ndarray, symbol: np.ndarray, depth: np.ndarray, leaf_of: np.ndarray) -> None:
        """Euler tour with children in the order of their first symbols, and a sparse table of least depths over it."""
        nodes = len(parent)
        children = np.lexsort((symbol[1:], parent[1:])) + 1
        begin = np.searchsorted(parent[children], np.arange(nodes + 1)).tolist()
        order, depths = children.tolist(), depth.tolist()
        seen = [0] * nodes
        tour: list[int] = []
        stack = [0]
        upcoming = begin[:nodes]
        # Each visit of a node is a step: on entry, and after each child.
        while stack:
            node = stack[-1]
            at = upcoming[node]
            if at == begin[node]:
                seen[node] = len(tour)
            tour.append(depths[node])
            if at < begin[node + 1]:
                upcoming[node] = at + 1
                child = order[at]
                if begin[child] == begin[child + 1]:
                    seen[child] = len(tour)
                    tour.append(depths[child])
                else:
                    stack.append(child)
            else:
                stack.pop()
        self.at = np.array(seen, np.int64)[leaf_of]
        # Suffixes in their order: leaves as the tour meets them.
        self.rank = np.empty(self.n, np.int64)
        self.rank[np.argsort(self.at)] = np.arange(self.n)
        levels = [np.array(tour, np.int32)]
        while 2 << (len(levels) - 1) <= len(tour):
            half = 1 << (len(levels) - 1)
            levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
        self.levels = levels

    def extensions(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``i`` and ``j``, which differ; n itself has none."""
        inside = (i < self.n) & (j < self.n)
        a, b = self.at[np.minimum(i, self.n - 1)], self.at[np.minimum(j, self.n - 1)]
        low, high = np.minimum(a, b), np.maximum(a, b) + 1
        level = np.frexp(high - low)[1] - 1
        out = np.zeros(len(low), np.int64)
        for k in np.unique(level).tolist():
            own = np.flatnonzero(level == k)
            table = self.levels[k]
            out[own] = np.minimum(table[low[own]], table[high[own] - (1 << k)])
        return np.where(inside, out, 0)


def _ukkonen(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parent, first position, first symbol and depth of every node, the root being 0, and the leaf of every suffix."""
    s, n = symbols.tolist(), len(symbols)
    # Edges are named by node and first symbol.
    wide = int(symbols.max()) + 1
    edges: dict[int, int] = {}
    first, end, link, above = [0], [0], [0], [0]
    leaf_of: list[int] = []
    node = length = edge = pending = 0
    for i in range(n):
        symbol = s[i]
        pending += 1
        last = 0
        while pending:
            if not length:
                edge = i
            key = node * wide + s[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(first)
                leaf_of.append(len(first))
                first.append(i)
                end.append(n)
                link.append(0)
                above.append(node)
                if last:
                    link[last] = node
                    last = 0
            else:
                start = first[child]
                span = (end[child] if end[child] < i else i + 1) - start
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                if s[start + length] == symbol:
                    length += 1
                    if last:
                        link[last] = node
                    break
                # Split the edge: an inner node, the rest of the old edge, and a new leaf.
                inner = len(first)
                edges[key] = inner
                edges[inner * wide + symbol] = inner + 1
                edges[inner * wide + s[start + length]] = child
                first += (start, i)
                end += (start + length, n)
                link += (0, 0)
                above += (node, inner)
                leaf_of.append(inner + 1)
                first[child] = start + length
                above[child] = inner
                if last:
                    link[last] = inner
                last = inner
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    parent, begin = np.array(above, np.int64), np.array(first, np.int64)
    spans = np.array(end, np.int64) - begin
    depth = np.zeros(len(parent), np.int64)
    leaves = np.array(leaf_of, np.int64)
    depth[leaves] = n - np.arange(n)
    # Depths of inner nodes: sums along the path, doubled until all have reached the root.
    jump, sums = parent.copy(), spans.copy()
    while jump.any():
        sums = sums + sums[jump]
        jump = jump[jump]
    inner = np.ones(len(parent), bool)
    inner[leaves] = False
    depth[inner] = sums[inner]
    return parent, begin, symbols[np.minimum(begin, n - 1)], depth, leaves


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each suffix the next one that is smaller: where the longest Lyndon word at its place ends."""
    n = len(rank)
    out, stack = [n] * n, []
    for i, r in enumerate(rank.tolist()):
        while stack and stack[-1][0] > r:
            out[stack.pop()[1]] = i
        stack.append((r, i))
    return np.array(out, np.int64)


def runs_of(symbols: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs of at least two periods, by start and period; the last symbol is unique.

    Symbols that occur once never lie in a run, so they part texts that share a tree.
    """
    n = len(symbols)
    forward, backward = SuffixTree(symbols), SuffixTree(np.append(symbols[-2::-1], symbols[-1]) if n > 1 else symbols)
    found = []
    # No suffix is a prefix of another, so the opposite order of words is the opposite order of suffixes.
    for rank in (forward.rank, n - 1 - forward.rank):
        j = _next_smaller(rank)
        i = np.flatnonzero(j < n)
        j = j[i]
        period = j - i
        right = forward.extensions(i, j)
        # The reversal of the first n - 1 symbols: what ends at x - 1 begins at n - 1 - x.
        left = backward.extensions(n - 1 - i, n - 1 - j)
        left = np.where(i == 0, 0, left)
        good = left + right >= period
        found.append(np.stack([i - left, left + period + right, period], axis=1)[good])
    return np.unique(np.concatenate(found), axis=0)[:, [0, 1, 2]] if n else np.zeros((0, 3), np.int64)


def _long(runs: np.ndarray) -> np.ndarray:
    return runs[runs[:, 1] >= np.maximum(WORDS_LEAST, PERIODS_LEAST * runs[:, 2])]


def _parts(codes: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first, last) of the stretches of each text whose windows all occur twice in it; whole texts without a window."""
    starts = run_starts(counts)
    if not window:
        some = np.flatnonzero(counts)
        return some, starts[:-1][some], starts[1:][some]
    text = np.repeat(np.arange(len(counts)), counts)
    total = len(codes) - window + 1
    if total <= 0:
        return (np.zeros(0, np.int64),) * 3
    sums = np.zeros(total, np.uint64)
    for k in range(window):
        sums = (sums + codes[k : k + total]) * np.uint64(0x9E3779B97F4A7C15)
        sums ^= sums >> np.uint64(29)
    begin = np.flatnonzero(text[:total] == text[window - 1 :])
    own = mix(sums[begin] + (text[begin].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    begin = begin[twice]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + window, -1)
    covered = np.cumsum(edge[:-1]) > 0
    # A stretch ends with its text, too.
    breaks = np.zeros(len(codes) + 1, bool)
    breaks[starts] = True
    inside = np.concatenate([[False], covered, [False]])
    first = np.flatnonzero(covered & (~inside[:-2] | breaks[:-1]))
    last = np.flatnonzero(covered & (~inside[2:] | breaks[1:])) + 1
    enough = last - first >= WORDS_LEAST
    first, last = first[enough], last[enough]
    return text[first], first, last


def find_runs(codes: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Text and (start, length, period) of the runs of several texts, whose word codes lie one after another."""
    text, first, last = _parts(codes, counts, window)
    starts = run_starts(counts)[:-1]
    texts_, rows = [np.zeros(0, np.int64)], [np.zeros((0, 3), np.int64)]
    for a, b in blocks((last - first + 1).tolist(), TREE):
        many = last[a:b] - first[a:b]
        total = int(many.sum())
        place = np.repeat(first[a:b], many) + np.arange(total) - np.repeat(run_starts(many)[:-1], many)
        words = np.unique(codes[place], return_inverse=True)[1]
        # A symbol of its own behind each part.
        ends = np.cumsum(many + 1) - 1
        symbols = np.empty(total + b - a, np.int64)
        part = np.repeat(np.arange(b - a), many + 1)
        is_end = np.zeros(len(symbols), bool)
        is_end[ends] = True
        symbols[~is_end] = words
        symbols[is_end] = total + np.arange(b - a)
        runs = _long(runs_of(symbols))
        own = part[runs[:, 0]]
        runs[:, 0] += first[a:b][own] - (ends - many)[own] - starts[text[a:b][own]]
        texts_.append(text[a:b][own])
        rows.append(runs)
    owners, found = np.concatenate(texts_), np.concatenate(rows)
    order = np.lexsort((found[:, 2], found[:, 0], owners))
    return owners[order], found[order]


def dropped(runs: np.ndarray, many: int) -> np.ndarray:
    """Which of ``many`` words stand in a run behind its first period."""
    edge = np.zeros(many + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


RUN = "struct<start:long,length:long,period:long>"


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, runs (start, length, period by start, then period) and collapsed, the text without repeated periods, of every row.

    Words are what ASCII white space parts; ``collapsed`` joins those that are left by blanks. A null or empty text has no
    runs and collapses to an empty one. Rows are handled one by one, so repeated rows and equal or null ids come as they
    are; an empty table gives no rows and other columns do not matter. A text is handled in one task, whose memory grows
    with the longest periodic part. ``window`` 0 builds trees of whole texts, with the same result.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = raw_texts(batch.column("text"))
            for a, b in blocks(list(map(len, raw)), TEXT_BLOCK):
                split = [t.split() for t in raw[a:b]]
                codes, counts = WORDS.of(split)
                owners, found = find_runs(codes, counts, window)
                bounds = np.searchsorted(owners, np.arange(b - a + 1))
                collapsed = []
                for words, lo, hi in zip(split, bounds[:-1].tolist(), bounds[1:].tolist()):
                    if lo < hi:
                        words = [words[i] for i in np.flatnonzero(~dropped(found[lo:hi], len(words))).tolist()]
                    collapsed.append(b" ".join(words))
                structs = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], fields=list(run_type))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "runs", "collapsed"],
                )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, runs array<{RUN}>, collapsed string")


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """doc_id and text of every row; where 10 divides crc32 of the decimal id, the words from a on repeat the first p of them.

    a and p follow from the same number: with g = crc32 / 10 and n words, a = g mod n and p = 1 + (n - a) / (3 + g mod 8). A
    null id leaves its text alone.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g = F.floor(F.col("_h") / 10)
    n = F.size("_words").cast("long")
    rows = docs.select("doc_id", "text", h.alias("_h"))
    rows = rows.withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    rows = rows.withColumn("_a", g % F.nullif(n, F.lit(0))).withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + g % 8)))
    body = F.slice("_words", F.lit(1), F.col("_a").cast("int"))

    def moved(i: Column) -> Column:
        return F.get("_words", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))

    tail = F.transform(F.sequence(F.col("_a"), n - 1), moved)
    edited = F.when(n > 0, F.array_join(F.concat(body, tail), " "))
    return rows.select("doc_id", F.coalesce(edited, "text").alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of most periods (ties: smallest start, then period), and digests of all runs and of the collapsed text.

    The columns of that run are null where there is none.
    """

    def ahead(x: Column, y: Column) -> Column:
        more = y["length"] * x["period"] - x["length"] * y["period"]
        return F.when(more != 0, F.sign(more)).when(x["start"] != y["start"], F.sign(x["start"] - y["start"])).otherwise(F.sign(x["period"] - y["period"])).cast("int")

    best = F.get(F.array_sort("runs", ahead), F.lit(0))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), "runs", "collapsed").select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
