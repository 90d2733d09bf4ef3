"""N-gram Jaccard self-join of documents with token-combination prefixes.

A token is a code of five words. Tokens are ordered by class and then by code: those of a single document, rare ones,
frequent ones. Two documents with a Jaccard similarity of at least 0.8 share at least ``n - floor(n / 5)`` tokens,
counted from either side, so their m-th common token in this order stands within the first ``floor(n / 5) + m``.

- If a common token is rare, so is the first one: single rare tokens of the prefix are indexed.
- Otherwise all common tokens are frequent. The prefix is extended to hold ``groups + 1`` of them; frequent tokens are
  split into ``groups`` by their code, so two common ones fall in one group: pairs of tokens of a group are indexed.
  ``groups`` grows with the document, so pairs do not; it depends on a size class, and each document is indexed for
  its own and the next, so that similar documents meet in one.

Documents with equal token sets are one set from the start. Sets that share a code are compared with one of them
first; what these links connect is left out when the remaining pairs are compared, so a group of near copies costs a
star and not all its pairs, and no link between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import WORDS, free_name, mix, raw_texts, run_starts, shingles, tidy
from moorage.llm.components import components
from moorage.session import settled

# Percent of the union that the intersection must be.
SIMILAR = 80
# Documents in which a token may occur and still be rare.
RARE = 16
# Bits of each of the two maps of shared and of frequent tokens: their size is fixed, whatever the input.
MAP_BITS = 26
# Text whose tokens one task counts.
RANGE_BYTES = 16 << 20


def token_sets(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of each text in falling or rising code order, one text after another, and how many each has."""
    codes, words = WORDS.of(t.lower().split() for t in raw)
    tokens, many = shingles(codes, words)
    starts = run_starts(many)
    for a, b in zip(starts.tolist(), starts[1:].tolist()):
        tokens[a:b].sort()
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    new[starts[:-1][many > 0]] = True
    before = np.concatenate([[0], np.cumsum(new)])
    return tokens[new], before[starts[1:]] - before[starts[:-1]]


def set_ids(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit name for each token set; 0 for the empty one."""
    a = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)))])
    b = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens + np.uint64(0x14057B7EF767814F)))])
    starts = run_starts(counts)
    names = mix(mix(a[starts[1:]] - a[starts[:-1]]) + (b[starts[1:]] - b[starts[:-1]]) * np.uint64(0x9E3779B97F4A7C15))
    names[counts == 0] = 0
    return names.view(np.int64)


def shared_maps(texts: DataFrame) -> tuple[bytes, bytes]:
    """Two bit maps over the leading bits of tokens: those of several documents, and those of more than ``RARE``.

    Every token of every document is counted. Tasks send sorted runs of tokens by range; one task counts a range.
    Tokens that share their leading bits share their bits in the maps: some seem more frequent than they are,
    none less, and all documents see the same.
    """
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(20, max(4, math.ceil(math.log2(total / RANGE_BYTES + 1))))
    low = np.uint64(64 - bits)

    @tidy
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            tokens, counts = token_sets(raw_texts(batch.column("text")))
            tokens = tokens[np.repeat(_unseen(set_ids(tokens, counts), seen), counts)]
            tokens.sort()
            ranges = (tokens >> low).astype(np.int64)
            cuts = np.flatnonzero(np.diff(ranges)) + 1
            rest = (tokens >> (low - np.uint64(32))).astype("<u4")
            parts = np.split(rest, cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges[np.append(0, cuts)] if len(tokens) else [], pa.int32()), pa.array([p.tobytes() for p in parts] if len(tokens) else [], pa.binary())],
                names=["range", "tokens"],
            )

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tokens = np.frombuffer(b"".join(table.column("tokens").to_pylist()), "<u4").copy()
        tokens.sort()
        at = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        many = np.diff(np.append(at, len(tokens)))
        place = tokens[at] >> np.uint32(32 + bits - MAP_BITS)
        size = 1 << (MAP_BITS - bits)
        maps = []
        for most in (1, RARE):
            own = np.zeros(size, bool)
            own[place[many > most]] = True
            maps.append(pa.array([np.packbits(own).tobytes()], pa.binary()))
        return pa.table([pa.array([key[0].as_py()], pa.int32()), *maps], names=["range", "shared", "frequent"])

    sent = texts.mapInArrow(send, "range int, tokens binary")
    slices = sent.groupBy("range").applyInArrow(count, "range int, shared binary, frequent binary").toArrow().to_pylist()
    size = 1 << (MAP_BITS - bits - 3)
    maps = bytearray(1 << (MAP_BITS - 3)), bytearray(1 << (MAP_BITS - 3))
    for row in slices:
        for own, name in zip(maps, ("shared", "frequent")):
            own[row["range"] * size : (row["range"] + 1) * size] = row[name]
    return bytes(maps[0]), bytes(maps[1])


def _unseen(names: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which sets this task meets for the first time; the empty one never counts."""
    new = np.zeros(len(names), bool)
    for i, name in enumerate(names.tolist()):
        if name and name not in seen:
            seen.add(name)
            new[i] = True
    return new


def _bit(bitmap: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    place = tokens >> np.uint64(64 - MAP_BITS)
    return (bitmap[place >> np.uint64(3)] >> (np.uint8(7) - (place & np.uint64(7)).astype(np.uint8))) & np.uint8(1)


def codes_of(tokens: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Index codes of a token set (kinds 0: of one document, 1: rare, 2: frequent), None if it can have no partner.

    With each code comes how many tokens a partner found by it can have in common. A single token need only find those
    of which it is the first common one, so tokens before it do not count. A pair need only find those whose common
    tokens are frequent, and of which it is the first common pair of a group, so that at most ``groups + 1`` common
    tokens stand up to its later one. The number is negative in the size class that is not the document's own: two
    documents of one class need not meet in the next as well.
    """
    n = len(tokens)
    spare = n * (100 - SIMILAR) // 100
    single, frequent = int((kind == 0).sum()), tokens[kind == 2]
    if single > spare or n < 2:
        return None
    codes = [tokens[kind == 1][: spare + 1 - single]]
    most = [n - single - np.arange(len(codes[0]))]
    allowed = spare - (n - len(frequent))
    if allowed >= 0:
        own = int(math.log(n, 1.25))
        for level in (own, own + 1):
            groups = max(1, int(1.25**level / 10))
            prefix = frequent[: allowed + groups + 1]
            group = mix(prefix ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(groups)
            order = np.argsort(group, kind="stable")
            group, prefix = group[order], prefix[order]
            left = np.minimum(len(frequent), groups + len(frequent) - order)
            for step in range(1, len(prefix)):
                same = group[step:] == group[:-step]
                if not same.any():
                    break
                pairs = prefix[:-step][same] * np.uint64(0x9E3779B97F4A7C15) + mix(prefix[step:][same] + np.uint64(level))
                codes.append(mix(pairs))
                # The order is stable, so the later token of a pair has the higher place.
                most.append(left[step:][same] * (1 if level == own else -1))
    return np.concatenate(codes), np.concatenate(most)


def indexed_sets(rows: DataFrame, maps: tuple[bytes, bytes]) -> DataFrame:
    """Each row (doc_id, text) with its set; the first of equal sets in a task also has tokens and index codes."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(maps)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, frequent = (np.frombuffer(m, np.uint8) for m in sent.value)
        seen: set[int] = set()
        for batch in batches:
            tokens, counts = token_sets(raw_texts(batch.column("text")))
            names, starts = set_ids(tokens, counts), run_starts(counts)
            kinds = _bit(shared, tokens) + _bit(frequent, tokens)
            new = _unseen(names, seen)
            codes, most, blobs = [None] * len(names), [None] * len(names), [None] * len(names)
            for i in np.flatnonzero(new).tolist():
                own = slice(starts[i], starts[i + 1])
                found = codes_of(tokens[own], kinds[own])
                if found is not None and len(found[0]):
                    codes[i], most[i], blobs[i] = found[0].view(np.int64), found[1], tokens[own].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts.astype(np.int64)),
                    pa.array(names, mask=counts == 0),
                    pa.array(codes, pa.list_(pa.int64())),
                    pa.array(most, pa.list_(pa.int64())),
                    pa.array(blobs, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_id", "codes", "most", "tokens"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, n_shingles long, set_id long, codes array<long>, most array<long>, tokens binary")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted token sets reach the similarity."""
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= SIMILAR * (len(both) - shared)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that are similar."""

    def run(lefts_rights: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in lefts_rights:
            views = zip(left.to_pylist(), right.to_pylist())
            yield pa.array([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in views], pa.bool_())

    joined = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("tokens").alias("left")), "a")
    joined = joined.join(sets.select(F.col("set_id").alias("b"), F.col("tokens").alias("right")), "b")
    return joined.where(F.arrow_udf(run, "boolean")("left", "right")).select("a", "b")


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and set_id of every row of ``docs``.

    Null texts and texts without words have the empty set, no ``set_id``, and are linked with nothing: their component
    is their own id. A text of fewer than five words is one token. Rows with equal sets are linked, whatever their ids;
    rows with a null id belong to their component, which takes its name from the others. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    own = settled(indexed_sets(rows, shared_maps(rows.select("text"))), "token-sets")

    sets = own.where("codes is not null").groupBy("set_id").agg(F.first("tokens").alias("tokens"))
    sets = settled(sets, "sets")
    zipped = F.inline(F.arrays_zip(F.col("codes").alias("code"), F.col("most").alias("most")))
    entries = own.where("codes is not null").select("set_id", F.col("n_shingles").alias("n"), zipped).distinct()
    # Codes of one set join nothing. The pivot of a code is the set with the least that others lack.
    lone = F.struct((F.col("n") - F.abs("most")).alias("lack"), "set_id", "n", "most")
    groups = entries.groupBy("code").agg(F.min(lone).alias("pivot"), F.min("set_id").alias("x"), F.max("set_id").alias("y")).where("x <> y")
    entries = settled(entries.join(groups.select("code", "pivot"), "code"), "entries")

    star = entries.where((F.col("set_id") != F.col("pivot.set_id")) & _possible("n", "most", "pivot.n", "pivot.most"))
    star = star.select(F.least("set_id", "pivot.set_id").alias("a"), F.greatest("set_id", "pivot.set_id").alias("b")).distinct()
    star = settled(star, "stars")
    links = settled(verified(star, sets), "star-links")

    joined = components(links)
    placed = entries.join(joined.withColumnRenamed("id", "set_id"), "set_id", "left")
    placed = placed.select("code", "set_id", "n", "most", F.coalesce("component", "set_id").alias("component"))
    split = placed.groupBy("code").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    placed = settled(placed.join(split.select("code"), "code"), "unlinked")
    a, b = placed.alias("a"), placed.alias("b")
    apart = (F.col("a.code") == F.col("b.code")) & (F.col("a.set_id") < F.col("b.set_id")) & (F.col("a.component") != F.col("b.component"))
    pairs = a.join(b, apart & _possible("a.n", "a.most", "b.n", "b.most"))
    pairs = pairs.select(F.col("a.set_id").alias("a"), F.col("b.set_id").alias("b")).distinct()
    pairs = settled(pairs.join(star, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(settled(verified(pairs, sets), "pair-links"))

    named = components(links).withColumnRenamed("id", "set_id")
    firsts = own.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("first"))
    firsts = firsts.join(named, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    smallest = firsts.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = settled(firsts.join(smallest, "component").select("set_id", "component_id"), "labels")
    return own.join(labels, "set_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "set_id")


def _possible(n: str, most: str, m: str, other: str):
    """Sets of these sizes can be similar if they have no more in common than either allows, in a class of one of them."""
    shared = F.least(F.abs(most), F.abs(other))
    return (100 * shared >= SIMILAR * (F.col(n) + F.col(m) - shared)) & (F.greatest(most, other) > 0)


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with all their columns, one of each component: that of the smallest id.

    Texts without words stay. Of rows with the smallest id, the first in the input stays.
    """
    row = free_name(docs, "row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    at = F.struct(F.col(key).alias("id"), F.col(row).alias("row"))
    found = similar_documents(numbered.select(at.alias("at"), F.col(text).alias("text")), "at", "text")
    dropped = settled(found.where("doc_id <> component_id").select(F.col("doc_id.row").alias(row)), "copies")
    return numbered.join(dropped, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
