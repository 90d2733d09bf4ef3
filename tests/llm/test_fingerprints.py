"""Fingerprints: the query against a plain loop, and local consistency of the parse."""

import hashlib
import random

import numpy as np
import pytest

from moorage.llm import fingerprints as f
from moorage.llm.common import prepare


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (doc, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        n = len(text)
        changed = text[: n - n // 4] + following[: n // 4]
        own, other, after = (f.fingerprints([t]) for t in (text, changed, following))
        out.append(
            (
                doc, n, hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(), other.tobytes().hex(),
                float(f.likeness(own, other)[0]), float(f.likeness(own, after)[0]),
            )
        )
    return sorted(out, key=repr)


def run(spark, rows):
    prepare(spark)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int")
    return sorted(map(tuple, f.compared(docs).collect()), key=repr)


def test_edge_cases(spark):
    draw = random.Random(3)
    rows = [(1, "é" * 9), (5, None), (2, ""), (3, "abc"), (None, "none"), (40, "x" * 300_000), (41, "longer text " * 30), (42, "😀 ok")]
    rows += [(i, "".join(draw.choice("abcde ") for _ in range(draw.randint(0, 90)))) for i in range(50, 120)]
    draw.shuffle(rows)
    assert run(spark, rows) == expected(rows)


@pytest.mark.parametrize("rows", [[], [(7, "alone with enough text to edit")], [(7, None)]])
def test_few_rows(spark, rows):
    assert run(spark, rows) == expected(rows)


def test_repeated_rows(spark):
    rows = [(1, "the same text again and again")] * 40
    assert run(spark, rows) == expected(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert run(spark, rows) == expected(rows)


def test_equal_substrings_share_interior_phrases():
    draw = random.Random(1)
    inner = "".join(draw.choice("abcdefgh ") for _ in range(4000))
    parses = []
    for left, right in (("", ""), ("xyz", "tail"), ("q" * 101, "w" * 7)):
        symbols, counts = f._symbols([left + inner + right])
        levels = []
        for _ in range(4):
            symbols, counts = f.next_level(symbols, counts)
            levels.append(symbols.tolist())
        parses.append(levels)
    for level in range(4):
        plain, *others = (p[level] for p in parses)
        margin = 8
        for other in others:
            text, want = str(other), str(plain[margin:-margin])[1:-1]
            assert want in text


def test_texts_parse_alone_as_in_company():
    own = ["", "a", "aa", "aaaaab", "abcabcabc", "the end", "ab" * 50, "é😀" * 9]
    together = f.fingerprints(own)
    assert np.array_equal(together, np.concatenate([f.fingerprints([t]) for t in own]))
    assert not together[0].any() and together[1:].any(1).all()


def test_likeness_follows_the_shared_share():
    draw = random.Random(2)
    text = lambda n: "".join(draw.choice("abcdefghijklmnop ") for _ in range(n))
    base, other = text(8000), text(8000)
    near = [float(f.likeness(f.fingerprints([base]), f.fingerprints([base[: 8000 - k] + other[:k]]))[0]) for k in (0, 800, 2000, 4000, 8000)]
    assert near[0] == 1.0 and near == sorted(near, reverse=True) and near[-1] < 0.1
    assert abs(near[2] - 0.6) < 0.15
