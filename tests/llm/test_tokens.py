"""Token ids and counts against the libraries, packing, training order and their round trips."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from moorage.llm import counts, order, packing, tokens
from moorage.llm.common import prepare
from moorage.llm.tokens import ByteIds, WordCounts, load, shared

ODD = [
    "", " ", "\n", "  a  b ", "x <|endoftext|> y<|startoftext|>", "it's 's don't", " foo\x1cbar baz\x1f", "é́ ́x\x85y z", "a\n b\n\n  c ",
    "漢字かな 😀😀  🏳️‍🌈", "İSTANBUL ΣΑΣ ß", "1234567 12 ٣", " x　y", "w" * 3000, "no" + "​" + "break",
]


def library(name, texts):
    tokenizer = load(name)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def check(texts):
    ids = [np.frombuffer(b, "<u4").tolist() for b in shared(ByteIds, "byte_bpe_50k.json").encode(texts)]
    assert ids == library("byte_bpe_50k.json", texts)
    assert shared(WordCounts, "word_bpe_49k.json").count(texts) == [len(i) for i in library("word_bpe_49k.json", texts)]


def test_odd_texts():
    check(ODD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=4), st.sampled_from(ODD))
def test_any_text(texts, odd):
    check([*texts, odd.join(texts)])


def table(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")


def rows_of(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, {"a": 1}, 5) for i, t in rows], "doc_id long, text string, bin map<string,int>, length int")


MIXED = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "x y z"), (4, "w" * 5000), (5, "many words here " * 4000)]


def test_counts_of_whole_table(spark):
    prepare(spark)
    rows = table(spark).select("doc_id", "text").collect()
    want = {r.doc_id: (len(r.text.encode()), n, n > 2048) for r, n in zip(rows, map(len, library(counts.TOKENIZER, [r.text for r in rows])))}
    for chunk, overlap in ((counts.CHUNK, counts.OVERLAP), (500, 16)):
        found = counts.token_counts(table(spark), chunk=chunk, overlap=overlap).collect()
        assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found} == want


def test_counts_of_edge_cases(spark):
    draw = random.Random(2)
    rows = MIXED + [(10 + i, t) for i, t in enumerate(ODD)]
    rows += [(40, "x" * 900 + " " + "y" * 900), (41, "é" * 2000), (42, "".join(draw.choice("ab1. \n😀é'") for _ in range(6000))), (43, "<|endoftext|>" * 300)]
    found = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in counts.token_counts(rows_of(spark, rows), chunk=200, overlap=8).collect()), key=repr)
    want = [(i, len((t or "").encode()), n) for (i, t), n in zip(rows, map(len, library(counts.TOKENIZER, [t or "" for _, t in rows])))]
    assert found == sorted(want, key=repr)
    assert counts.token_counts(rows_of(spark, [])).count() == 0


def unpack(rows, docs, length=packing.LENGTH):
    """Checks sequences and pieces against the documents; returns how many sequences there are."""
    ids = {i: own + [packing.END] for i, own in zip((d for d, _ in docs), library(packing.TOKENIZER, [t or "" for _, t in docs]))}
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for own in by_sequence.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at and n > 0
            at += n
        assert at <= length
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        at = 0
        for k, (piece, start, n, crc) in enumerate(sorted(own)):
            assert (piece, start) == (k, at) and (k == 0 or n == length)
            assert crc == zlib.crc32(np.array(ids[doc][start : start + n], "<u4").tobytes())
            at += n
        assert at == len(ids[doc])
    return len(by_sequence)


def test_packing_of_whole_table(spark):
    prepare(spark)
    docs = [tuple(r) for r in table(spark).select("doc_id", "text").collect()]
    rows = packing.packed(table(spark)).collect()
    total = sum(r.length for r in rows)
    many = unpack(rows, docs)
    assert many <= 1.03 * total / packing.LENGTH + 1
    assert unpack(packing.packed(table(spark), block=16).collect(), docs) <= 1.1 * many


def test_packing_of_edge_cases(spark):
    rows = [r for r in MIXED if r != (3, "one two")]
    assert unpack(packing.packed(rows_of(spark, rows)).collect(), rows) == -(-(1 + 1 + 3 + 4) // 1024) + unpack_only(rows) - 1
    twice = packing.packed(rows_of(spark, [(3, "one two")] * 2)).collect()
    assert len(twice) == 2 and {r.sequence_id for r in twice} == {twice[0].sequence_id} and {r.offset for r in twice} == {0, 3}
    assert packing.packed(rows_of(spark, [])).count() == 0


def unpack_only(rows):
    """Fewest sequences: full pieces, and the others as best fit finds them."""
    sizes = [len(i) + 1 for i in library(packing.TOKENIZER, [t or "" for _, t in rows])]
    rest = [n % 1024 for n in sizes if n % 1024]
    return sum(n // 1024 for n in sizes) + len(packing.best_fit(rest, 1024))


@pytest.mark.parametrize("seed", range(5))
def test_local_search_only_improves(seed):
    draw = random.Random(seed)
    sizes = [draw.randint(1, 60) for _ in range(200)]
    first = []
    for size in sizes:
        if first and sum(first[-1]) + size <= 64:
            first[-1].append(size)
        else:
            first.append([size])
    better = packing.improve([list(b) for b in first], 64)
    assert sorted(s for b in better for s in b) == sorted(sizes) and all(0 < sum(b) <= 64 for b in better)
    assert sum(sum(b) ** 2 for b in better) > sum(sum(b) ** 2 for b in first)
    assert packing.fewest(sizes, 64) <= len(better) <= 1.1 * len(packing.best_fit(sizes, 64))
    assert len(better) < len(first)


def test_exchanges_of_each_kind():
    assert len(packing.improve([[6, 2], [1, 1]], 10)) == 1
    assert sorted(map(sorted, packing.improve([[6, 3], [4, 3], [4]], 10))) == [[3, 3, 4], [4, 6]]
    assert sorted(map(sorted, packing.improve([[6, 3], [2, 2], [7]], 10))) == [[2, 2, 6], [3, 7]]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    slots = order.feistel(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    if n >= 1000:
        assert not np.array_equal(slots, order.feistel(np.arange(n), n, key=7))
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.15


def test_training_order_round_trip(spark, folder):
    rows = MIXED + [(20 + i, f"document number {i} " * i) for i in range(60)]
    found = order.training_order(rows_of(spark, rows), folder, length=32, per_shard=50).collect()
    assert sorted(r.slot for r in found) == list(range(len(found)))
    read = list(order.read_slots(folder, 0, len(found), length=32, per_shard=50))
    by_doc = {}
    for r in sorted(found, key=lambda r: r.slot):
        own = read[r.slot]
        assert len(own) == r.n_tokens and zlib.crc32(own.tobytes()) != 0 or r.n_tokens == 0
        assert (r.shard, r.byte_offset) == (r.slot // 50, r.slot % 50 * 66)
        by_doc.setdefault(r.doc_id, []).append((r.piece, own.tolist()))
    for (doc, _), ids in zip(rows, library(order.TOKENIZER, [t or "" for _, t in rows])):
        if doc != 3:
            assert [t for _, own in sorted(by_doc[doc]) for t in own] == ids + [order.END]
    again = list(order.read_slots(folder, 37, 60, length=32, per_shard=50))
    assert all(np.array_equal(a, b) for a, b in zip(again, read[37:97]))
    assert order.training_order(rows_of(spark, []), folder + "/none").count() == 0


def test_ids_beyond_16_bits_raise(spark, folder, monkeypatch):
    ids = shared(ByteIds, "byte_bpe_50k.json")
    texts = [*ODD, "plain text"]
    assert [np.frombuffer(b, "<u2").tolist() for b in ids.short(texts)] == [np.frombuffer(b, "<u4").tolist() for b in ids.encode(texts)]
    assert ids.lengths(texts) == [len(b) // 4 for b in ids.encode(texts)]
    with pytest.raises(OverflowError):
        tokens._sixteen([1, 70_000])
    monkeypatch.setattr(order, "END", 70_000)
    with pytest.raises(OverflowError):
        order.training_order(rows_of(spark, [(1, "a b")]), folder)
