"""Byte-level BPE: texts to token ids by the ranks of a vocabulary, and back.

Texts are cut into pre-tokens with array operations over the classes of their code points. A pre-token that is a token
as a whole, the usual case, is found through a minimal perfect hash of the vocabulary: its hash names a bucket, the
bucket's displacement names the one place where it can stand, and its bytes are compared there. All pre-tokens of a
block are looked up at once, so none of them becomes a Python object. The others are merged from single bytes: a heap
holds the ranks of adjacent pairs, and bytes are linked to their neighbours, so a piece of n bytes takes n log n steps.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import mix, run_starts, texts, tidy
from moorage.llm.tokens import place, shared

VOCABULARY = "byte_bpe_50k.tiktoken"
# Code points encoded together: they bound the memory of a worker, whatever the length of a text.
BLOCK = 1 << 20
# Merged pieces that one worker remembers before it starts anew, and the longest it remembers.
PIECE_LIMIT, PIECE_BYTES = 500_000, 64
# Mean keys of a bucket of the minimal perfect hash.
BUCKET = 2
# Displacements of a bucket tried at once.
TRIES = 32

LETTER, NUMBER, SPACE, OTHER, END = range(5)
_ALPHABET = 0x110000


def _classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    table = np.full(_ALPHABET, OTHER, np.uint8)
    every = np.arange(_ALPHABET, dtype="<u4")
    every[0xD800:0xE000] = 0x24
    points = every.tobytes().decode("utf-32-le")
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for span in regex.finditer(pattern, points):
            table[span.start() : span.end()] = kind
    return table


# Letters after an apostrophe that make one pre-token with it; fixed values of the pattern.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def pre_token_starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the pre-tokens begin in texts that each have a code point of kind END behind them.

    Runs of one class are pre-tokens. The last white space before a word stands alone, or belongs to it if it is a
    blank. An apostrophe between words takes its ending along.
    """
    before = np.concatenate([[END], kinds[:-1]])
    starts = kinds != before
    word = starts & (kinds != SPACE) & (kinds != END)
    after_space = np.flatnonzero(word & (before == SPACE))
    starts[after_space - 1] = True
    starts[after_space[points[after_space - 1] == 0x20]] = False
    lone = np.flatnonzero(starts & (points == 0x27))
    lone = lone[kinds[np.minimum(lone + 1, len(kinds) - 1)] == LETTER]
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    for ending in _ENDINGS:
        fits = np.ones(len(lone), bool)
        for k, letter in enumerate(ending, 1):
            fits &= padded[lone + k] == ord(letter)
        starts[lone[fits] + 1] = False
        starts[lone[fits] + 1 + len(ending)] = True
        lone = lone[~fits]
    return np.flatnonzero(starts)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit codes: n codes, n places, one place for each."""

    def __init__(self, codes: np.ndarray):
        self.n = n = len(codes)
        self.buckets = np.uint64(max(1, n // BUCKET))
        self.displacement = np.zeros(int(self.buckets), np.int64)
        bucket = (codes % self.buckets).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=int(self.buckets))
        starts = run_starts(sizes)
        taken = np.zeros(n, bool)
        by_size = np.argsort(-sizes, kind="stable")
        for b in by_size[: np.searchsorted(-sizes[by_size], -1)].tolist():
            own, d = codes[order[starts[b] : starts[b + 1]]], np.arange(1, TRIES + 1)
            while True:
                places = np.sort(self._displaced(own, d[:, None]), axis=1)
                good = np.flatnonzero(~taken[places].any(axis=1) & (np.diff(places, axis=1) > 0).all(axis=1))
                if len(good):
                    break
                d += TRIES
            taken[places[good[0]]] = True
            self.displacement[b] = d[good[0]]
        # A bucket of one code names its place itself.
        single = by_size[sizes[by_size] == 1]
        self.displacement[single] = -1 - np.flatnonzero(~taken)[: len(single)]

    def _displaced(self, codes: np.ndarray, d: np.ndarray) -> np.ndarray:
        salted = mix(codes + np.asarray(d).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return (salted % np.uint64(max(1, self.n))).astype(np.int64)

    def places(self, codes: np.ndarray) -> np.ndarray:
        """The place of each code; codes outside the set get any place, so what stands there has to be compared."""
        d = self.displacement[(codes % self.buckets).astype(np.int64)]
        return np.where(d < 0, -1 - d, self._displaced(codes, d))


class ByteBpe:
    """Encoder and decoder of a rank file."""

    def __init__(self, name: str = VOCABULARY):
        with open(place(name), "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"{name} has no token for bytes {missing[:5]}")
        self.classes = _classes()
        tokens = list(self.ranks)
        ids = np.fromiter(self.ranks.values(), np.int64, len(tokens))
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        data = np.frombuffer(b"".join(tokens), np.uint8)
        self.longest = int(lengths.max())
        self.weights = mix(np.arange(1, self.longest + 1, dtype=np.uint64)) | np.uint64(1)
        codes = self._codes(data, run_starts(lengths)[:-1], lengths)
        if len(np.unique(codes)) < len(codes):
            raise ValueError(f"two tokens of {name} have one hash")
        self.hash = PerfectHash(codes)
        # Tokens in the order of their places, one after another.
        at = np.argsort(self.hash.places(codes))
        self.id_at, self.length_at = ids[at], lengths[at]
        self.data = np.frombuffer(b"".join([tokens[i] for i in at.tolist()]), np.uint8)
        self.start_at = run_starts(self.length_at)[:-1]
        # And by id, for decoding.
        self.place_of = np.full(int(ids.max()) + 1, -1, np.int64)
        self.place_of[self.id_at] = np.arange(len(tokens))
        self.known: dict[bytes, bytes] = {}

    def _codes(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each run of bytes: the sum of its bytes, each weighted by its place."""
        within = np.arange(int(lengths.sum())) - np.repeat(run_starts(lengths)[:-1], lengths)
        terms = (data[np.repeat(starts, lengths) + within].astype(np.uint64) + np.uint64(1)) * self.weights[within]
        return mix(np.add.reduceat(terms, run_starts(lengths)[:-1])) if len(terms) else np.zeros(0, np.uint64)

    def _whole(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The id of each piece that is a token, -1 for the others."""
        ids = np.full(len(starts), -1, np.int64)
        able = np.flatnonzero(lengths <= self.longest)
        where = self.hash.places(self._codes(data, starts[able], lengths[able]))
        same = self.length_at[where] == lengths[able]
        able, where = able[same], where[same]
        if len(able):
            many = lengths[able]
            first = run_starts(many)
            within = np.arange(first[-1]) - np.repeat(first[:-1], many)
            equal = self.data[np.repeat(self.start_at[where], many) + within] == data[np.repeat(starts[able], many) + within]
            hit = np.logical_and.reduceat(equal, first[:-1])
            ids[able[hit]] = self.id_at[where[hit]]
        return ids

    def merged(self, piece: bytes) -> bytes:
        """Ids of a piece that is no token: the adjacent pair of lowest rank, of equal ones the first, merges until none is a token."""
        found = self.known.get(piece)
        if found is not None:
            return found
        n, rank = len(piece), self.ranks.get
        # Each part is named by its first byte; ``end`` and ``previous`` link it to its neighbours.
        end, previous, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j] = False
            end[i] = stop
            if stop < n:
                previous[stop] = i
                if (r := rank(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (left := previous[i]) >= 0 and (r := rank(piece[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        ids = np.array([self.ranks[piece[i : end[i]]] for i in range(n) if alive[i]], "<u4").tobytes()
        if n <= PIECE_BYTES:
            if len(self.known) >= PIECE_LIMIT:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def _block(self, own: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of several texts one after another, and how many each has."""
        joined = "\0".join(own) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kinds = self.classes[points]
        ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
        kinds[ends] = END
        begins = pre_token_starts(points, kinds)
        raw = joined.encode()
        data = np.frombuffer(raw, np.uint8)
        byte = np.flatnonzero((data & 0xC0) != 0x80)[begins] if len(data) > len(points) else begins
        lengths = np.diff(byte, append=len(data))
        real = kinds[begins] != END
        begins, byte, lengths = begins[real], byte[real], lengths[real]
        ids = self._whole(data, byte, lengths)
        many = np.ones(len(ids), np.int64)
        missed = np.flatnonzero(ids < 0)
        pieces = [self.merged(raw[s : s + n]) for s, n in zip(byte[missed].tolist(), lengths[missed].tolist())]
        many[missed] = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        first = run_starts(many)
        out = np.empty(first[-1], "<u4")
        out[first[:-1][many == 1]] = ids[many == 1]
        if pieces:
            inner = np.repeat(first[missed], many[missed])
            runs = run_starts(many[missed])
            out[inner + np.arange(runs[-1]) - np.repeat(runs[:-1], many[missed])] = np.frombuffer(b"".join(pieces), "<u4")
        return out, np.diff(first[np.searchsorted(begins, ends)], prepend=0)

    def encode(self, own: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        done: list[bytes] = []
        for first, last in blocks([len(t) for t in own], BLOCK):
            if last == first + 1 and len(own[first]) > BLOCK:
                done.append(b"".join(self._block([part])[0].tobytes() for part in parted(own[first], BLOCK)))
                continue
            ids, many = self._block(own[first:last])
            starts = run_starts(many)
            done += [ids[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
        return done

    def decode(self, own: list[bytes]) -> list[bytes]:
        """The bytes that ids stand for; an id outside the vocabulary raises."""
        done: list[bytes] = []
        for ids in own:
            parts = []
            whole = np.frombuffer(ids, "<u4").astype(np.int64)
            for at in range(0, len(whole), BLOCK):
                block = whole[at : at + BLOCK]
                if block.max() >= len(self.place_of) or (where := self.place_of[block]).min() < 0:
                    raise ValueError("an id is not in the vocabulary")
                many = self.length_at[where]
                first = run_starts(many)
                within = np.arange(first[-1]) - np.repeat(first[:-1], many)
                parts.append(self.data[np.repeat(self.start_at[where], many) + within].tobytes())
            done.append(b"".join(parts))
        return done


def blocks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that together have at most ``most``, or are one that has more."""
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and total + size > most:
            yield first, i
            first = i
            total = 0
        total += size
    if sizes:
        yield first, len(sizes)


# A letter, a blank and a letter: the blank begins a pre-token, whatever surrounds them.
_JOINT = regex.compile(r"(?<=\p{L})(?= \p{L})")


def parted(text: str, most: int) -> Iterator[str]:
    """A text in parts of about ``most`` code points, cut where a pre-token begins in the whole text too."""
    at = 0
    while len(text) - at > most and (joint := _JOINT.search(text, at + most)):
        yield text[at : joint.start()]
        at = joint.start()
    yield text[at:]


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (binary: little-endian unsigned 32-bit integers) of every row; other columns do not matter.

    Null texts are empty and have no ids. Repeated rows and equal or null ids are encoded row by row; an empty table
    gives no rows. Special strings are ordinary text. A text longer than ``BLOCK`` is encoded in parts that end where
    its pre-tokens do, so one task holds a text and its ids, but no more than a block of the rest.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = shared(ByteBpe, vocabulary)
        for batch in batches:
            ids = library.encode(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decoded(ids: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The rows of ``encoded`` with ``data``, the bytes their ids stand for.

    Null ids are none. Ids need not end at whole characters, so ``data`` is binary. Unknown ids raise.
    """
    rows = ids.select("doc_id", "ids")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = shared(ByteBpe, vocabulary)
        for batch in batches:
            data = library.decode([i or b"" for i in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=["doc_id", "ids", "data"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, data binary")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of ``docs``, as ``encoded`` and ``decoded`` give them."""
    both = decoded(encoded(docs, vocabulary, key, text), vocabulary)
    return both.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
