"""Benchmark decontamination: SimHash of item-sized windows, a multi-index over Hamming blocks, exact checks.

A window can be similar to an item only if they share a shingle, so windows lie where a document has a shingle of an item,
as that item would lie there, and have its word count. Which items a window is compared with is decided by its 64-bit
SimHash alone: fingerprints within the radius differ in at most ``FLIPS`` bits of one of the blocks, so looking up each
block's value with up to so many bits turned over finds all of them. Those are compared exactly. What the radius leaves
out is measured (README); ``exact`` compares a window with the items that placed it, too, whatever their distance.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from moorage.llm.common import WordCodes, mix, raw_texts, run_starts, shingles, tidy
from moorage.session import settled

SHINGLE, SIMILARITY = 5, 0.8
# Fingerprints that differ in up to 17 bits differ in at most two bits of one of six blocks.
BLOCKS, FLIPS = 6, 2
RADIUS = BLOCKS * (FLIPS + 1) - 1
# Bags of items that a worker keeps at hand, and windows looked up together.
BAGS, WINDOWS = 20_000, 512
# Text of items held by one pass over the documents; more items take more passes.
ITEM_BYTES = 16 << 20

_MARKS = re.compile(r"[\W_]+")


class PlainCodes(WordCodes):
    """Codes of words in lower case without marks; 0 for what has no letter or digit."""

    def code(self, word: bytes) -> int:
        plain = _MARKS.sub("", word.decode("utf-8", "replace").lower())
        return xxhash.xxh3_64_intdigest(plain.encode()) or 1 if plain else 0


_codes = PlainCodes()


def plain_codes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = _codes.of(t.split() for t in raw)
    kept = codes != 0
    if not kept.all():
        ends = run_starts(counts)
        before = np.concatenate([[0], np.cumsum(kept)])
        counts = before[ends[1:]] - before[ends[:-1]]
        codes = codes[kept]
    return codes, counts


def simhash(windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of word codes; places from a row's size on do not count."""
    bits = np.unpackbits(mix(windows.copy()).view(np.uint8).reshape(*windows.shape, 8), axis=2).astype(np.int16) * 2 - 1
    bits[np.arange(windows.shape[1])[None, :] >= sizes[:, None]] = 0
    return np.packbits(bits.sum(1) > 0, axis=1).view(np.uint64).reshape(-1)


class ItemBag(dict):
    """How often an item has each shingle, and their weights, which do not depend on the block of items it is in."""

    def __init__(self, bag: dict[int, int], holders: list[int]):
        super().__init__(bag)
        # A shingle that many distinct texts share tells less; one that the item lacks weighs as the item's own on average.
        self.weight = {code: 1.0 / many for code, many in zip(bag, holders)}
        self.words = sum(bag.values())
        self.total = sum(many * self.weight[code] for code, many in bag.items())
        self.other = self.total / self.words if self.words else 1.0


class _Bags:
    """The bags of items, made when they are asked for."""

    def __init__(self, items: Items):
        self.items, self.made = items, {}

    def __len__(self) -> int:
        return len(self.items.sizes)

    def __getitem__(self, item: int) -> ItemBag:
        if item >= len(self):
            raise IndexError(item)
        found = self.made.get(item)
        if found is None:
            if len(self.made) >= BAGS:
                self.made.clear()
            found = self.made[item] = self.items.bag_of(item)
        return found


class Items:
    """Benchmark items by shingle, and by the blocks of their fingerprints, all in flat arrays."""

    def __init__(
        self, ids: list, raw: list[bytes], similarity: float = SIMILARITY, shared: dict[int, int] | None = None, exact: bool = False, index: bool = True
    ):
        """``shared``: of how many distinct texts of the whole benchmark a shingle is, if of several; without it these are all items.

        ``exact`` also compares windows with the items that placed them; ``index`` off looks no fingerprint up.
        """
        codes, counts = plain_codes(raw)
        keep = np.flatnonzero(counts > 0)
        self.similarity, self.exact, self.indexed = similarity, exact, index
        self.ids = [ids[k] for k in keep.tolist()]
        # Items without words have no codes, so leaving them out moves nothing.
        self.sizes, self.codes = counts[keep], codes
        self.starts = run_starts(self.sizes)
        self.seen, many = shingles(codes, self.sizes)
        self.seen_starts = run_starts(many)
        item = np.repeat(np.arange(len(self.sizes)), many)
        order = np.argsort(self.seen, kind="stable")
        self.sorted_codes, self.item_at = self.seen[order], item[order].astype(np.int32)
        self.place_at = (np.arange(len(item)) - self.seen_starts[:-1][item])[order].astype(np.int32)
        self.known = np.unique(self.sorted_codes)
        if shared is None:
            distinct = {w.tobytes(): k for k, w in enumerate(self.words)}
            shared = Counter(c for k in distinct.values() for c in set(self._own(k).tolist()))
        pairs = sorted((c, n) for c, n in shared.items() if n > 1)
        self.shared_codes, self.shared_many = np.array([c for c, _ in pairs], np.uint64), np.array([n for _, n in pairs], np.int64)
        self.hint = np.zeros(1 << 20, bool)
        self.hint[self.known >> np.uint64(44)] = True
        # Items of fewer words than a shingle are shingles of their own size.
        first = self.seen[self.seen_starts[:-1]] if len(self.sizes) else self.seen
        self.short = {size: np.unique(first[self.sizes == size]) for size in np.unique(self.sizes[self.sizes < SHINGLE]).tolist()}
        self.prints = np.zeros(len(self.sizes), np.uint64)
        by_size = np.argsort(self.sizes, kind="stable")
        for part in np.array_split(by_size, max(1, len(by_size) // WINDOWS)):
            if len(part):
                width = int(self.sizes[part].max())
                rows = codes[np.minimum(self.starts[:-1][part][:, None] + np.arange(width), len(codes) - 1)]
                self.prints[part] = simhash(rows, self.sizes[part])
        cuts = np.linspace(0, 64, BLOCKS + 1).astype(int)
        self.blocks = []
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            turned = [sum(1 << bit for bit in bits) for many in range(FLIPS + 1) for bits in combinations(range(b - a), many)]
            keys = self._keys(self.sizes, self.prints, a, b)
            order = np.argsort(keys, kind="stable")
            self.blocks.append((a, b, np.array(turned, np.uint64), keys[order], order.astype(np.int32)))
        self.bags = _Bags(self)

    @staticmethod
    def _keys(size: np.ndarray | int, prints: np.ndarray, a: int, b: int) -> np.ndarray:
        """Word count and block value in one number."""
        return np.asarray(size).astype(np.uint64) << np.uint64(16) | (prints >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)

    @property
    def words(self) -> list[np.ndarray]:
        return [self.codes[a:b] for a, b in zip(self.starts, self.starts[1:])]

    def _own(self, item: int) -> np.ndarray:
        return self.seen[self.seen_starts[item] : self.seen_starts[item + 1]]

    def bag_of(self, item: int) -> ItemBag:
        values, many = np.unique(self._own(item), return_counts=True)
        holders = np.ones(len(values), np.int64)
        if len(self.shared_codes):
            at = np.minimum(np.searchsorted(self.shared_codes, values), len(self.shared_codes) - 1)
            held = self.shared_codes[at] == values
            holders[held] = self.shared_many[at[held]]
        return ItemBag(dict(zip(values.tolist(), many.tolist())), holders.tolist())

    def bag(self, codes: np.ndarray) -> dict[int, int]:
        values, many = np.unique(codes, return_counts=True)
        return dict(zip(values.tolist(), many.tolist()))

    def near_pairs(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``prints`` and the items of ``size`` words within the radius of them."""
        rows, items = [], []
        for a, b, turned, keys, order in self.blocks:
            wanted = (self._keys(size, prints, a, b)[:, None] ^ turned).reshape(-1)
            low, high = np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, "right")
            own, at = _ranges(low, high)
            met, row = order[at], own // len(turned)
            close = np.bitwise_count(prints[row] ^ self.prints[met]) <= RADIUS
            rows.append(row[close])
            items.append(met[close])
        pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(items)], axis=1).astype(np.int64), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def near(self, size: int, prints: np.ndarray) -> list[list[int]]:
        """For each fingerprint the items of ``size`` words within the radius."""
        row, item = self.near_pairs(size, prints)
        ends = np.searchsorted(row, np.arange(len(prints) + 1))
        return [item[a:b].tolist() for a, b in zip(ends, ends[1:])]

    def _placed(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """(words, text, first, last, item) of the windows where texts share shingles with items, cut at the ends of the texts."""
        found = [np.zeros((0, 5), np.int64)]
        for size in (SHINGLE, *self.short):
            seen, many = shingles(codes, counts, size)
            known = self.known if size == SHINGLE else self.short[size]
            at = np.flatnonzero(self.hint[seen >> np.uint64(44)])
            at = at[np.isin(seen[at], known)]
            ends = np.cumsum(many)
            text = np.searchsorted(ends, at, "right")
            own, pair = _ranges(np.searchsorted(self.sorted_codes, seen[at]), np.searchsorted(self.sorted_codes, seen[at], "right"))
            item, text, place = self.item_at[pair].astype(np.int64), text[own], (at - (ends - many)[text])[own]
            width = self.sizes[item]
            first = place - self.place_at[pair]
            rows = np.stack([width, text, np.maximum(first, 0), np.minimum(first + width, counts[text]), item], axis=1)
            found.append(rows if size == SHINGLE else rows[width == size])
        return np.unique(np.concatenate(found), axis=0)

    def leaks(self, raw: list[bytes]) -> list[tuple[int, int, int, int, int, float]]:
        """(text, item, first word, words, distance, similarity) of the best window at each place of a leak."""
        codes, counts = plain_codes(raw)
        starts = run_starts(counts)
        placed = self._placed(codes, counts)
        windows, place = np.unique(placed[:, :4], axis=0, return_inverse=True)
        found = []
        bounds = np.flatnonzero(np.diff(windows[:, 0], prepend=-1, append=-1))
        for low, high in zip(bounds.tolist(), bounds[1:].tolist()):
            for begin in range(low, high, WINDOWS):
                part = windows[begin : min(begin + WINDOWS, high)]
                size = int(part[0, 0])
                first, long = starts[part[:, 1]] + part[:, 2], part[:, 3] - part[:, 2]
                prints = simhash(codes[np.minimum(first[:, None] + np.arange(size), len(codes) - 1)], long)
                row, item = self.near_pairs(size, prints) if self.indexed else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                if self.exact:
                    own = placed[(place >= begin) & (place < begin + len(part))]
                    also = place[(place >= begin) & (place < begin + len(part))] - begin
                    pairs = np.unique(np.stack([np.concatenate([row, also]), np.concatenate([item, own[:, 4]])], axis=1), axis=0)
                    row, item = pairs[:, 0], pairs[:, 1]
                last, bag = -1, {}
                for r, i in zip(row.tolist(), item.tolist()):
                    if r != last:
                        last, words = r, codes[first[r] : first[r] + long[r]]
                        bag = self.bag(shingles(words, np.array([len(words)]))[0])
                    alike = similarity(bag, self.bags[i])
                    if alike >= self.similarity:
                        distance = int(prints[r] ^ self.prints[i]).bit_count()
                        found.append((int(part[r, 1]), i, int(part[r, 2]), int(long[r]), distance, alike))
        return _best(found)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and members of each range, one after another."""
    many = high - low
    owner = np.repeat(np.arange(len(low)), many)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + low[owner]


def similarity(window: dict[int, int], item: ItemBag) -> float:
    """The larger of the weighted and the plain Jaccard similarity of a window and an item."""
    shared = heavy = own = 0
    weight = 0.0
    for code, many in window.items():
        own += many
        if code in item:
            both = min(many, item[code])
            shared += both
            heavy += both * item.weight[code]
            weight += many * item.weight[code]
        else:
            weight += many * item.other
    total, weight = own + item.words - shared, weight + item.total - heavy
    return max(shared / total, heavy / weight) if total else 0.0


def _best(found: list[tuple]) -> list[tuple]:
    """Of windows of one item that overlap, the most similar, then the first."""
    out = []
    for t, item, a, n, d, alike in sorted(found):
        last = out[-1] if out else None
        if last and last[:2] == (t, item) and a < last[2] + last[3]:
            if alike > last[5]:
                out[-1] = (t, item, a, n, d, alike)
        else:
            out.append((t, item, a, n, d, alike))
    return out


def item_blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text", most: int = ITEM_BYTES, **options) -> Iterator[Items]:
    """The items in blocks of bounded size."""
    rows = benchmark.select(F.col(key).alias("id"), F.col(text).alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // most))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)))
    held = settled(_shared(rows), "shared-shingles")
    for block in range(blocks):
        own = rows.where(F.col("block") == block).orderBy("id", "text").toArrow()
        many = held.where(F.col("block") == block).toArrow()
        codes = many.column("code").to_numpy().astype(np.int64).view(np.uint64).tolist()
        shared = dict(zip(codes, many.column("texts").to_pylist()))
        yield Items(own.column("id").to_pylist(), raw_texts(own.column("text")), shared=shared, **options)


def _shared(rows: DataFrame) -> DataFrame:
    """block, code, texts: the shingles of each block of items that several distinct texts of all blocks have, and how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, counts = plain_codes(raw_texts(batch.column("text")))
            seen, many = shingles(codes, counts)
            starts = run_starts(counts)
            names = [xxhash.xxh3_128_digest(codes[a:b].tobytes()) for a, b in zip(starts, starts[1:])]
            item = np.repeat(np.arange(len(counts)), many)
            columns = [batch.column("block").take(pa.array(item)), pa.array(names, pa.binary()).take(pa.array(item)), pa.array(seen.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "name", "code"])

    own = rows.select("block", "text").mapInArrow(run, "block long, name binary, code long")
    own = own.groupBy("code", "name").agg(F.collect_set("block").alias("blocks"))
    own = own.groupBy("code").agg(F.count(F.lit(1)).alias("texts"), F.array_distinct(F.flatten(F.collect_set("blocks"))).alias("blocks"))
    return own.where("texts > 1").select(F.explode("blocks").alias("block"), "code", "texts")


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", **options) -> DataFrame:
    """doc_id, item_id, start_word, n_words, distance, similarity of every place where a document repeats an item.

    Null and empty texts have no words and no leaks, nor do items without words. Items of fewer than five words are found
    wherever their words stand. Repeated rows are reported row by row, items with equal texts each. Empty tables give no rows.
    Ids may be of any type, null or missing. ``options`` go to ``item_blocks`` and ``Items``.
    """
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind, item_kind = own.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    item_type = to_arrow_type(benchmark.schema[item_key].dataType)
    schema = f"doc_id {kind}, item_id {item_kind}, start_word int, n_words int, distance int, similarity double"
    out = None
    for items in item_blocks(benchmark, item_key, text, **options):

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = items.leaks(raw_texts(batch.column("text")))
                columns = list(zip(*found)) if found else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(columns[0], pa.int64())),
                        pa.array([items.ids[i] for i in columns[1]], item_type),
                        *(pa.array(c, pa.int32()) for c in columns[2:5]),
                        pa.array(columns[5], pa.float64()),
                    ],
                    names=["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"],
                )

        found = own.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that repeat no item, with all their columns; those without words stay, as all do without items."""
    for items in item_blocks(benchmark, text=text, **options):
        docs = docs.where(F.arrow_udf(_clean(items), "boolean")(F.col(text)))
    return docs


def _clean(items: Items):
    @tidy
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            kept = np.ones(len(array), bool)
            kept[[leak[0] for leak in items.leaks(raw_texts(array))]] = False
            yield pa.array(kept)

    return run
