"""Runs against a search of all periods at all places."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from moorage.llm import periodic, registered
from moorage.llm.common import mix, prepare


def every_run(words):
    """(start, length, period) of all runs, period by period."""
    n, found = len(words), []
    codes = np.unique(np.array(words), return_inverse=True)[1] if words else np.zeros(0, int)
    for q in range(1, n // 3 + 1):
        equal = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = b - a + q
            if length >= max(24, 3 * q) and not any(s <= a and s + m >= a + length and q % p == 0 for s, m, p in found):
                found.append((a, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(draw):
    letters = draw.choice([1, 2, 3, 50])
    words = [draw.randrange(letters) for _ in range(draw.randint(0, 40))]
    for _ in range(draw.randint(0, 3)):
        period = [draw.randrange(draw.choice([2, 3, 60])) for _ in range(draw.randint(1, 12))]
        words += (period * draw.randint(1, 30))[: draw.randint(1, 90)]
        words += [draw.randrange(letters) for _ in range(draw.randint(0, 5))]
    return words


@pytest.mark.parametrize("window", [periodic.WINDOW, 0])
@pytest.mark.parametrize("tree", [periodic.TREE, 60])
def test_runs_of_random_texts(window, tree, monkeypatch):
    monkeypatch.setattr(periodic, "TREE", tree)
    draw = random.Random(7)
    for _ in range(200):
        docs = [some_words(draw) for _ in range(draw.randint(1, 4))]
        codes = mix(np.array([w for own in docs for w in own], np.uint64) + np.uint64(1))
        owners, found = periodic.find_runs(codes, np.array(list(map(len, docs)), np.int64), window)
        for d, own in enumerate(docs):
            assert [tuple(r) for r in found[owners == d].tolist()] == every_run(own)


@pytest.mark.parametrize("seed", range(30))
def test_common_extensions(seed):
    draw = random.Random(seed)
    s = np.array([draw.randrange(3) for _ in range(60)] + [9])
    tree = periodic.SuffixTree(s)
    i, j = np.array([(a, b) for a in range(61) for b in range(61) if a != b]).T
    text = s.tolist()
    want = [next(k for k in range(62) if text[a + k : a + k + 1] != text[b + k : b + k + 1]) for a, b in zip(i.tolist(), j.tolist())]
    assert tree.extensions(i, j).tolist() == want
    assert sorted(range(61), key=lambda a: text[a:]) == np.argsort(tree.rank).tolist()


def test_all_runs_of_two_periods():
    """Without the lower bounds: all maximal repetitions of short strings."""
    draw = random.Random(3)
    for _ in range(300):
        s = [draw.randrange(2) for _ in range(draw.randint(1, 30))] + [5]
        want = set()
        for q in range(1, len(s)):
            for a in range(len(s)):
                b = a
                while b + q < len(s) and s[b] == s[b + q]:
                    b += 1
                if b - a >= q and (a == 0 or s[a - 1] != s[a - 1 + q]):
                    if not any(q % p == 0 and x <= a and x + m >= b + q for x, m, p in want):
                        want.add((a, b - a + q, q))
        assert [tuple(r) for r in periodic.runs_of(np.array(s)).tolist()] == sorted(want)


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    want = {}
    for row in spark.read.parquet(f"{path}/documents.parquet").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = every_run(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        want[row.doc_id] = (
            len(runs),
            *best,
            1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
        )
    found = registered.QUERIES["op13_periodic_runs"](spark, path)
    kinds = {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint"}
    assert dict(found.dtypes) == {**kinds, "runs_sha256": "string", "collapsed_sha256": "string"}
    rows = found.collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)
    assert sum(r.n_runs for r in rows) > 10


def test_edge_cases(spark):
    prepare(spark)
    spin = "tick tock " * 40
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, spin), (4, spin), (None, "a " * 30 + "b"), (5, "x " * 23), (8, "é ü " * 12), (7, "w" * 100_000)]
    # Ids whose number ends the edit at once: crc32 of the decimal id divisible by 10.
    edited = [i for i in range(100, 400) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    rows += [(edited[0], None), (edited[1], "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", periodic.F.lit(1)).withColumn("_h", periodic.F.lit(1))
    found = {}
    for r in periodic.periodic_runs(periodic.with_repeated_tail(docs)).collect():
        found.setdefault(r.doc_id, []).append(([tuple(x) for x in r.runs], r.collapsed))
    assert found[1] == found[2] == found[3] == [([], "")]
    assert found[4] == [([(0, 80, 2)], "tick tock")] * 2
    assert found[None] == [([(0, 30, 1)], "a b")]
    assert found[5] == [([], " ".join(["x"] * 23))]
    assert found[8] == [([(0, 24, 2)], "é ü")] and found[7] == [([], "w" * 100_000)]
    assert found[edited[0]] == [([], "")] and found[edited[1]] == [([], "one")]
    assert periodic.run_digest(periodic.periodic_runs(docs.limit(0))).count() == 0


def test_a_long_periodic_text():
    period = np.random.default_rng(1).integers(0, 1 << 60, 3000).astype(np.uint64)
    codes = np.concatenate([np.tile(period, 20), period[:77], np.arange(500, dtype=np.uint64)])
    owners, found = periodic.find_runs(codes, np.array([len(codes)]))
    assert found.tolist() == [[0, 60_077, 3000]]
