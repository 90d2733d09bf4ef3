"""Near words against all pairs, forms and roots against plain loops, the query against SQL."""

import random
import re
import zlib
from collections import Counter

import pytest

from moorage.llm import registered, spelling
from moorage.llm.common import prepare


def one_edit(a, b):
    """Whether exactly one inserted, deleted or replaced code point parts two words, by the whole matrix."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j - 1] + (x != y), above[j] + 1, row[j - 1] + 1))
    return row[-1] == 1


def groups(counts):
    near = {w: [o for o in counts if abs(len(o) - len(w)) < 2 and one_edit(w, o)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return rows


def some_words(draw, letters, many, longest):
    words = set()
    while len(words) < many:
        words.add("".join(draw.choices(letters, k=draw.randint(1, longest))))
    return sorted(words)


@pytest.mark.parametrize("letters", ["ab", "abcd", "aé漢😀", "abcdefghij"])
def test_sorted_list_search(letters):
    draw = random.Random(letters)
    for _ in range(20):
        words = some_words(draw, letters, 12, 7)
        for query in [*words, "", "abc"]:
            assert spelling.one_edit_away(query, words) == [i for i, w in enumerate(words) if one_edit(query, w)]


def test_leaps_skip_ranges():
    """Words whose prefix is two edits away are passed over without looking at them."""

    class Watched(list):
        looked = 0

        def __getitem__(self, i):
            Watched.looked += 1
            return super().__getitem__(i)

    words = Watched(["abcdef", *(f"zz{i:05d}" for i in range(10_000))])
    assert spelling.one_edit_away("abcdeg", words) == [0]
    assert Watched.looked < 100


@pytest.mark.parametrize("group", [4096, 2])
def test_groups_of_random_words(spark, group):
    prepare(spark)
    draw = random.Random(group)
    counts = {w: draw.choice([1, 2, 5, 10, 11, 60, 60, 400]) for w in some_words(draw, "abç", 300, 8) + some_words(draw, "abcdefgh", 200, 5)}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = spelling.spelling_groups(rows, group=group).collect()
    assert len(found) == len(counts) and {tuple(r) for r in found} == groups(counts)


def test_a_hot_group_is_divided(spark):
    prepare(spark)
    draw = random.Random(8)
    counts = {"prefix" + w: draw.randint(1, 99) for w in some_words(draw, "abcd", 400, 6)}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in spelling.spelling_groups(rows, group=30).collect()} == groups(counts)


def test_edge_cases_of_words(spark):
    prepare(spark)
    rows = [("word", 3), ("word", 4), (None, 9), ("", 50), ("w", 10), ("wore", 40), ("word", 0)]
    frame = spark.createDataFrame(rows, "word string, n long").withColumn("best", spelling.F.lit(1)).withColumn("_word", spelling.F.lit("x"))
    assert {tuple(r) for r in spelling.spelling_groups(frame).collect()} == groups({"word": 7, "": 50, "w": 10, "wore": 40})
    assert spelling.spelling_groups(frame.limit(0)).count() == 0
    empty = spelling.words_with_slips(spark.createDataFrame([], "doc_id long, text string"))
    assert spelling.spelling_groups(empty).count() == 0


def slipped(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda c: c.group().lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_words_of_texts(spark):
    rows = [(i, "Straße ÉCOLE École écoles Überall x÷y_abcdefg7hijklmn " * 2 + "letters" * (i % 3)) for i in range(600)]
    rows += [(None, "letters letters letters letters letters"), (1, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", spelling.F.lit(1)).withColumn("run", spelling.F.lit(""))
    assert {r.word: r.n for r in spelling.words_with_slips(docs).collect()} == slipped(rows)


def test_words_of_the_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    found = registered.QUERIES["op11_spelling"](spark, path).collect()
    assert {r.word: r.n for r in found} == slipped(rows)
