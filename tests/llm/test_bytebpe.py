"""Byte-level BPE against the library of its vocabulary, and round trips."""

import hashlib
import random

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from moorage.llm import bytebpe, registered
from moorage.llm.bytebpe import ByteBpe, PerfectHash
from moorage.llm.common import prepare
from moorage.llm.tokens import ranked, shared

LIBRARY = ranked(bytebpe.VOCABULARY)
PIECES = ["a", "b", " ", "  ", "'", "s", "t", "re", "'ll", "'ve", "\n", "\t", "1", "!", "é", "漢", "😀", "\x00", " ", "́", "'s", "D", "the", "<|endoftext|>"]


def own() -> ByteBpe:
    return shared(ByteBpe, bytebpe.VOCABULARY)


def check(texts):
    ids = own().encode(texts)
    for text, found in zip(texts, ids):
        assert np.frombuffer(found, "<u4").tolist() == LIBRARY.encode_ordinary(text), text[:80]
    assert [data.decode() for data in own().decode(ids)] == texts


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), max_size=5), st.text(st.characters(exclude_categories=["Cs"])))
def test_any_text(texts, other):
    check([*texts, other])


def test_every_character_beside_others():
    points = [*range(0, 0xD800), *range(0xE000, 0x20000), *range(0xE0000, 0xE0200)]
    for at in range(0, len(points), 4096):
        text = "".join(f"a{c}a{c} 1{c}  {c}!" for c in map(chr, points[at : at + 4096]))
        assert np.frombuffer(own().encode([text])[0], "<u4").tolist() == LIBRARY.encode_ordinary(text)


def test_pre_tokens_are_matches_of_the_pattern():
    draw = random.Random(5)
    import public_tokenizers

    for _ in range(300):
        text = "".join(draw.choices(PIECES, k=30))
        points = np.frombuffer((text + "\0").encode("utf-32-le"), "<u4")
        kinds = own().classes[points]
        kinds[-1] = bytebpe.END
        begins = bytebpe.pre_token_starts(points, kinds).tolist()
        assert [text[a:b] for a, b in zip(begins, begins[1:])] == regex.findall(public_tokenizers.PATTERN, text)


@pytest.mark.parametrize("n", [1, 2, 3, 50, 5000])
def test_perfect_hash_is_minimal(n):
    codes = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
    table = PerfectHash(codes)
    assert sorted(table.places(codes).tolist()) == list(range(len(codes)))
    others = table.places(codes + np.uint64(1))
    assert ((others >= 0) & (others < len(codes))).all()


def test_vocabulary_words_resolve_without_merging(monkeypatch):
    monkeypatch.setattr(ByteBpe, "merged", lambda *_: pytest.fail("merged"))
    assert np.frombuffer(own().encode(["the whole world"])[0], "<u4").tolist() == LIBRARY.encode_ordinary("the whole world")


def test_long_pieces_and_blocks(monkeypatch):
    draw = random.Random(1)
    check(["ab" * 20_000, "é" * 3000, " " * 5000 + "x", "zq" + "x" * 999])
    long = "".join(draw.choices(PIECES, k=20_000)) + " and some words " * 500
    whole = own().encode([long])
    monkeypatch.setattr(bytebpe, "BLOCK", 700)
    check([long, "", long[:600], "b" * 701, "x"])
    assert own().encode([long]) == whole


def test_unknown_ids_raise():
    with pytest.raises(ValueError):
        own().decode([np.array([5, 60_000], "<u4").tobytes()])
    with pytest.raises(ValueError):
        own().decode([np.array([50_256], "<u4").tobytes()])


def test_whole_table(spark):
    want = {}
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = LIBRARY.encode_ordinary(row.text or "")
        want[row.doc_id] = (
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((row.text or "").encode()).hexdigest(),
        )
    found = registered.QUERIES["op12_byte_bpe"](spark, "/root/testdata/sf0.001")
    assert dict(found.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()} == want


def test_nulls_repeats_and_clashing_columns(spark):
    prepare(spark)
    rows = [(1, None, "x"), (2, "", "x"), (3, "one two", "x"), (3, "one two", "x"), (None, "é", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("data", bytebpe.F.lit(1))
    found = sorted((tuple(r) for r in bytebpe.round_trip(docs).collect()), key=repr)
    none = hashlib.sha256(b"").hexdigest()
    assert [f[0] for f in found] == [1, 2, 3, 3, None]
    assert found[0][1:] == found[1][1:] == (0, none, none)
    assert found[2] == found[3] and found[2][1] == len(LIBRARY.encode_ordinary("one two"))
    assert bytebpe.round_trip(docs.limit(0)).count() == 0
