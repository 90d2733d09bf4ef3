"""The n-gram join against a brute-force join."""

import random
import re

import pytest
from pyspark.sql import functions as F

from moorage.llm import jaccard
from moorage.llm.common import prepare
from moorage.llm.components import components

SCHEMA = "doc_id long, text string, extra map<string,int>, row long"


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        sets.append(grams)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(own) if own else None))
    return sorted(out, key=repr)


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, None, 7) for i, t in rows], SCHEMA)
    found = jaccard.similar_documents(docs).select("doc_id", "n_shingles", "component_id")
    return sorted(map(tuple, found.collect()), key=repr)


def near_copies(seed, families=12, members=30, words=60):
    """Families of edited copies, with edits on either side of the threshold, and shared passages."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6)))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(families):
        base = [word() for _ in range(draw.randint(3, words))]
        if draw.random() < 0.5:
            base = passage + base[: draw.randint(1, 20)]
        for _ in range(draw.randint(1, members)):
            own = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
                own[draw.randrange(len(own))] = word()
            rows.append((len(rows), " ".join(own)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_families(spark, seed):
    prepare(spark)
    rows = near_copies(seed)
    assert run(spark, rows) == brute(rows)


def test_frequent_tokens_only(spark, monkeypatch):
    """With every shared token frequent, pairs of tokens alone must find all links."""
    prepare(spark)
    rows = near_copies(9, families=6, members=20)
    maps = jaccard.shared_maps

    def frequent(texts):
        shared, _ = maps(texts)
        return shared, shared

    monkeypatch.setattr(jaccard, "shared_maps", frequent)
    assert run(spark, rows) == brute(rows)


def test_full_maps(spark, monkeypatch):
    """Maps with all bits set make the join slower but lose nothing."""
    prepare(spark)
    rows = near_copies(5, families=6, members=12)
    full = b"\xff" * (1 << (jaccard.MAP_BITS - 3))
    monkeypatch.setattr(jaccard, "shared_maps", lambda texts: (full, full))
    assert run(spark, rows) == brute(rows)
    monkeypatch.setattr(jaccard, "shared_maps", lambda texts: (full, bytes(len(full))))
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    prepare(spark)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two three four"), (7, "One two  three\nfour"),
        (8, "one two three five"), (None, "one"), (9, "a b c d e f"), (9, "a b c d e f"), (10, "x " * 20_000), (10, "x " * 30_000),
        (11, " ".join(f"w{i}" for i in range(24))), (12, " ".join(f"w{i}" for i in range(20))),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_distinct_documents_keep_columns(spark):
    prepare(spark)
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (2, "A b c d e f"), (5, None), (6, None), (None, "q r s")]
    docs = spark.createDataFrame([(i, t, {"k": 1}, 7) for i, t in rows], SCHEMA)
    kept = jaccard.distinct_documents(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, "q r s"), (2, "A b c d e f"), (5, ""), (6, "")]


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    found = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert found == {**{i: 0 for i in range(41)}, **{j: 100 for j in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table(spark):
    prepare(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = jaccard.similar_documents(docs).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)
    assert found.where(F.col("component_id") < F.col("doc_id")).count() > 0
