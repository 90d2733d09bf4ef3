"""Leaks against a search that compares every window of every item's size."""

import pickle
import random
import time

import pytest

from moorage.llm import decontaminate as d
from moorage.llm.common import prepare, raw_texts, run_starts, shingles

import numpy as np
import pyarrow as pa


def passages(seed=0, items=30, docs=60):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7)))
    bench = [[word() for _ in range(draw.randint(6, 60))] for _ in range(items)]
    bench[1] = bench[0][:30] + bench[1][:8]
    texts = []
    for _ in range(docs):
        own = [word() for _ in range(draw.randint(0, 200))]
        for _ in range(draw.randint(0, 2)):
            item = list(draw.choice(bench))
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                item[draw.randrange(len(item))] = word()
            at = draw.randint(0, len(own))
            own[at:at] = [w.upper() + draw.choice([",", ".", ""]) for w in item]
        texts.append(" ".join(own))
    return bench, texts


def brute(items, texts):
    """(text, item) pairs with a window of the item's size that is similar enough."""
    raw = [t.encode() for t in texts]
    codes, counts = d.plain_codes(raw)
    starts, out = run_starts(counts), set()
    for t in range(len(texts)):
        own = codes[starts[t] : starts[t + 1]]
        for item, size in enumerate(items.sizes.tolist()):
            for a in range(-size + 1, len(own)):
                window = own[max(0, a) : max(0, a + size)]
                if len(window) and d.similarity(items.bag(shingles(window, np.array([len(window)]))[0]), items.bags[item]) >= items.similarity:
                    out.add((t, item))
                    break
    return out


@pytest.mark.parametrize("seed", range(2))
def test_all_similar_windows_are_found(seed):
    bench, texts = passages(seed)
    items = d.Items(list(range(len(bench))), [" ".join(b).encode() for b in bench])
    found = {(t, i) for t, i, *_ in items.leaks([t.encode() for t in texts])}
    want = brute(items, texts)
    assert want and found == want


def test_multi_index_finds_all_within_the_radius():
    draw = np.random.default_rng(1)
    bench, _ = passages(3, items=200)
    items = d.Items(list(range(200)), [" ".join(b[:6]).encode() for b in bench])
    base = items.prints[draw.integers(0, 200, 300)]
    flips = np.array([sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 16), replace=False)) for _ in range(300)], np.uint64)
    for own, found in zip(base ^ flips, items.near(6, base ^ flips)):
        want = [i for i in range(200) if items.sizes[i] == 6 and int(own ^ items.prints[i]).bit_count() <= d.RADIUS]
        assert found == want


def test_query_and_edge_cases(spark):
    prepare(spark)
    bench = spark.createDataFrame([(1, "Alpha beta, gamma delta epsilon zeta eta."), (2, None), (3, "..."), (4, "two words")], "item_id long, text string")
    rows = [
        (1, "x y alpha BETA gamma delta epsilon zeta eta z"), (2, None), (3, ""), (4, "two words"), (5, "two words more"), (None, "alpha beta gamma delta epsilon zeta eta"),
        (6, "alpha beta gamma delta other zeta eta"), (1, "x y alpha BETA gamma delta epsilon zeta eta z"), (7, "w " * 50_000 + "alpha beta gamma delta epsilon zeta eta"),
    ]
    docs = spark.createDataFrame([(i, t, {"a": 1}, 2) for i, t in rows], "doc_id long, text string, item_id map<string,int>, similarity int")
    found = sorted(((r.doc_id, r.item_id, r.start_word, r.n_words) for r in d.find_leaks(docs, bench).collect()), key=repr)
    assert found == sorted([(1, 1, 2, 7), (1, 1, 2, 7), (4, 4, 0, 2), (5, 4, 0, 2), (None, 1, 0, 7), (7, 1, 50_000, 7)], key=repr)
    kept = d.without_leaks(docs, bench)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [2, 3, 6]
    assert d.find_leaks(docs.limit(0), bench).count() == 0
    assert d.find_leaks(docs, bench.limit(0)).count() == 0
    assert d.without_leaks(docs, bench.limit(0)).count() == len(rows)
    blocks = sorted((r.doc_id or 0, r.item_id) for r in d.find_leaks(docs, bench).collect())
    items = list(d.item_blocks(bench, most=16))
    assert sum(len(i.ids) for i in items) == 2 and len(items) > 1 and len(blocks) == 6


def test_planted_table(spark):
    prepare(spark)
    base = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in d.find_leaks(docs, bench).collect()}
    plain = lambda t: [d._MARKS.sub("", w.lower()) for w in (t or "").split() if d._MARKS.sub("", w.lower())]
    items = {r.item_id: " " + " ".join(plain(r.text)) + " " for r in bench.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in " " + " ".join(plain(r.text)) + " "}
    assert want and want <= found
    assert raw_texts(pa.array(["é", None])) == ["é".encode(), b""]


def changed_words(spark, sf="sf0.001"):
    """Items of the given table with one word changed whose plain similarity is 0.8 or more: (item, text)."""
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"/root/testdata/{sf}/benchmark.parquet").collect()]
    own = d.Items([i for i, _ in bench], [t.encode() for _, t in bench])
    out = []
    for k, (item, text) in enumerate(zip(own.ids, own.words)):
        raw = [w for w in bench[k][1].split() if d._MARKS.sub("", w)]
        for at in range(0, len(raw), 3):
            new = " ".join([*raw[:at], f"changed{at}", *raw[at + 1 :]])
            codes, _ = d.plain_codes([new.encode()])
            a, b = (set(shingles(w, np.array([len(w)]))[0].tolist()) for w in (codes, text))
            if len(a & b) >= 0.8 * len(a | b):
                out.append((k, new))
    return bench, out


@pytest.mark.parametrize("times", [1, 2, 5])
def test_repeated_items_lose_no_near_copies(spark, times):
    prepare(spark)
    bench, texts = changed_words(spark)
    items = d.Items(list(range(times * len(bench))), [t.encode() for _, t in bench] * times)
    found = {(t, i % len(bench)) for t, i, *_ in items.leaks([t.encode() for _, t in texts])}
    assert texts and {(n, k) for n, (k, _) in enumerate(texts)} <= found


def test_template_and_blocks_do_not_change_similarity(spark):
    prepare(spark)
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    template = words("t", 30)
    bench = spark.createDataFrame([(i, f"{template} {words(f'i{i}x', 12)}") for i in range(20)] + [(20, f"{template} {words('i0x', 12)}")], "item_id long, text string")
    texts = [(0, f"{template} {words('i0x', 12)}".replace("t15 ", "other ")), (1, f"{template} {words('i3x', 11)} end"), (2, words("z", 60))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = sorted(tuple(r) for r in d.find_leaks(docs, bench).collect())
    assert found == sorted(tuple(r) for r in d.find_leaks(docs, bench, most=2000).collect())
    assert {(0, 0), (0, 20), (1, 3)} <= {r[:2] for r in found} and all(r[0] != 2 for r in found)
    weights = {c: w for i in d.item_blocks(bench) for b in i.bags for c, w in b.weight.items()}
    assert weights == {c: w for i in d.item_blocks(bench, most=2000) for b in i.bags for c, w in b.weight.items()}
    assert min(weights.values()) == 1 / 20


def test_cut_and_end_edited_passages_are_found():
    draw = random.Random(5)
    words = [[f"w{draw.randrange(10_000)}" for _ in range(draw.randint(20, 60))] for _ in range(150)]
    items = d.Items(list(range(150)), [" ".join(w).encode() for w in words])
    texts = []
    for k, own in enumerate(words):
        for cut in range(1, len(own) // 6):
            for new in (own[cut:], own[:-cut], [*own[:-cut], *(f"new{i}" for i in range(cut))]):
                codes, count = d.plain_codes([" ".join(new).encode()])
                if d.similarity(items.bag(shingles(codes, count)[0]), items.bags[k]) >= 0.8:
                    texts.append((k, " ".join(new)))
    found = {(t, i): distance for t, i, _, _, distance, _ in items.leaks([t.encode() for _, t in texts])}
    assert all((n, k) in found for n, (k, _) in enumerate(texts))
    assert any(found[n, k] > 12 for n, (k, _) in enumerate(texts))


def test_short_items_are_found_inside_longer_texts():
    items = d.Items([0, 1, 2], [b"one", b"Two words", b"these four words here"])
    found = items.leaks([b"a b c, two WORDS d e two words", b"x these four words here y", b"and one more of these four words", b"no such passage in here at all"])
    assert [f[:4] for f in found] == [(0, 1, 3, 2), (0, 1, 7, 2), (1, 2, 1, 4), (2, 0, 1, 1)]
    assert [f[:4] for f in items.leaks([b"two words", b"two words more", b"one"])] == [(0, 1, 0, 2), (1, 1, 0, 2), (2, 0, 0, 1)]


def edited(bench, draw):
    """Items with a changed word, cut at an end, or with new last words, inside other text: (item, text)."""
    out = []
    for k, text in enumerate(bench):
        own = text.split()
        forms = [[*own[:at], "changed", *own[at + 1 :]] for at in range(0, len(own), 3)]
        for cut in range(1, len(own) // 5 + 1):
            forms += [own[cut:], own[:-cut], [*own[:-cut], *(f"new{i}" for i in range(cut))]]
        out += [(k, " ".join(["before", *form, "and after it"])) for form in forms]
    return out


def test_the_index_finds_what_the_exact_way_finds():
    """Rows come through the blocks of the fingerprints alone: without them there are none."""
    draw = random.Random(11)
    bench = [" ".join(f"w{draw.randrange(3000)}" for _ in range(draw.randint(15, 60))) for _ in range(60)]
    raw = [t.encode() for t in bench]
    texts = [t.encode() for _, t in edited(bench, draw)]
    ids = list(range(len(bench)))
    pairs = lambda **options: {leak[:2] for leak in d.Items(ids, raw, **options).leaks(texts)}
    exact = pairs(exact=True)
    assert len(exact) > 500 and pairs(index=False) == set()
    assert len(pairs() & exact) >= 0.99 * len(exact) and pairs() <= exact
    assert pairs(exact=True, index=False) == exact


def test_ids_of_other_types(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta")], "doc_id smallint, text string")
    for kind in ("smallint", "string", "decimal(5,0)"):
        bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (None, "alpha beta gamma delta epsilon zeta")], "item_id int, text string")
        found = d.find_leaks(docs, bench.withColumn("item_id", d.F.col("item_id").cast(kind)))
        assert found.schema["item_id"].dataType.simpleString() == kind
        assert sorted(str(r.item_id) for r in found.collect()) == ["1", "None"]


def test_items_with_a_common_template_and_a_large_benchmark():
    started = time.process_time()
    template = " ".join(f"t{k}" for k in range(11))
    raw = [f"{template} {' '.join(f'i{i}x{k}' for k in range(30))}".encode() for i in range(20_000)]
    items = d.Items(list(range(len(raw))), raw)
    size = len(pickle.dumps(items))
    found = items.leaks([raw[7], b"x " * 50 + template.encode(), raw[19_999] + b" end"])
    assert [(t, i) for t, i, *_ in found] == [(0, 7), (2, 19_999)]
    assert time.process_time() - started < 60 and size < 15 * sum(map(len, raw))
