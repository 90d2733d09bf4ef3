"""Spelling variants: each word is tied to the far commoner word one edit away.

Near words are found by dynamic programming over sorted lists. For a query, the three cells of the edit matrix around the
diagonal are kept for every prefix of the word last scanned; the next word starts from the row at their common prefix. Once
a prefix exceeds one edit, the scan leaps over the range of words that share it, to the next one that has a letter with
which the row above could go on.

Lists are short and meet their queries in one group: with one edit between two words, the half of the query without it
is untouched, so query and word agree in it and lie in the group of that half, length and side. A group of more than
``GROUP`` words is divided again: its window, the part not yet agreed on, is halved, until a window of one code point is
left, which few words can share. No pair is met twice, as only the window that holds the first difference counts it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import tasks, tidy
from moorage.session import settled

# Words of a group that are scanned as one list.
GROUP = 4096
# A form has at least this many times the occurrences of its variant.
RATIO = 5
_LAST = chr(0x10FFFF)


def one_edit_away(query: str, words: list[str]) -> list[int]:
    """Places of the words of a sorted list that one inserted, deleted or replaced code point makes of ``query``."""
    m, n = len(query), len(words)
    found: list[int] = []
    # Cells of the query's first d - 1, d and d + 1 letters against the first d letters of the word; 2 stands for more.
    rows = [(2, 0, 1 if m else 2)]
    last, i = "", 0
    while i < n:
        word = words[i]
        d, kept = 0, min(len(rows) - 1, len(word))
        while d < kept and word[d] == last[d]:
            d += 1
        del rows[d + 1 :]
        while d < len(word):
            a, b, c = rows[d]
            x = word[d]
            left = min(a + (x != query[d - 1]) if 0 < d <= m else 2, b + 1, 2)
            middle = min(b + (x != query[d]), c + 1, left + 1, 2) if d < m else 2
            right = min(c + (x != query[d + 1]), middle + 1, 2) if d + 1 < m else 2
            if left > 1 and middle > 1 and right > 1:
                break
            rows.append((left, middle, right))
            d += 1
        last = word
        if d == len(word):
            if -1 <= m - d <= 1 and rows[d][m - d + 1] == 1:
                found.append(i)
            i += 1
            continue
        # The edit is spent: only letters that continue a cell of 1 lead on.
        onward = [query[d + k] for k, cell in zip((-1, 0, 1), rows[d]) if cell <= 1 and 0 <= d + k < m and query[d + k] > word[d]]
        i = bisect_left(words, word[:d] + (min(onward) if onward else _LAST), i + 1)
    return found


def _entries(words: DataFrame) -> DataFrame:
    """Each word (word, n) in the lists of queries of its length, one less and one more, with the whole query as window."""
    length = F.length("word")
    return words.select("word", "n", F.explode(F.array(length - 1, length, length + 1)).alias("m")).select(
        "word", "n", "m", F.lit(0).alias("lo"), F.col("m").alias("hi")
    ).where("m >= 0")


def _halved(entries: DataFrame) -> DataFrame:
    """Each entry once for either half of its window."""
    half = (F.floor((F.col("lo") + F.col("hi")) / 2)).cast("int")
    windows = F.array(F.struct(F.col("lo"), half.alias("hi")), F.struct(half.alias("lo"), F.col("hi")))
    rows = entries.select("word", "n", "m", F.explode(F.array_distinct(windows)).alias("w")).select("word", "n", "m", "w.lo", "w.hi")
    # Only the empty query has an empty window.
    return rows.where("lo < hi or m = 0")


_KEY = ["m", "lo", "hi", "prefix", "suffix"]


def _keyed(entries: DataFrame) -> DataFrame:
    """Words cut into what lies before, in and behind the window; the outer parts name the group."""
    behind = F.col("m") - F.col("hi")
    cut = F.length("word") - behind
    return entries.select(
        *_KEY[:3],
        F.substring("word", F.lit(1), F.col("lo")).alias("prefix"),
        F.substring("word", cut + 1, behind).alias("suffix"),
        F.substring("word", F.col("lo") + 1, cut - F.col("lo")).alias("middle"),
        "n",
    )


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n_near, best) for the words of (word, n), distinct and not null, that have near words in one window.

    ``best`` is (minus_n, word) of the commonest near word there. A word has a row for each window that holds some, so
    counts are to be added up and the least ``best`` taken. An empty table gives no rows.
    """
    found, level = None, _halved(_entries(words))
    while True:
        keyed = settled(_keyed(level), "spelling-lists")
        hot = settled(
            keyed.groupBy(*_KEY).count().where((F.col("count") > group) & (F.col("hi") - F.col("lo") > 1)).select(*_KEY), "spelling-hot"
        )
        more = not hot.isEmpty()
        cold = keyed.join(hot, _KEY, "left_anti") if more else keyed
        pairs = _scanned(cold)
        found = pairs if found is None else found.unionByName(pairs)
        if not more:
            return found
        word = F.concat("prefix", "middle", "suffix").alias("word")
        level = _halved(keyed.join(hot, _KEY, "left_semi").select(word, "n", "m", "lo", "hi"))


def _scanned(keyed: DataFrame) -> DataFrame:
    dealt = keyed.repartition(tasks(keyed), *_KEY).sortWithinPartitions(*_KEY, "middle")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, middles, counts = None, [], []
        for batch in batches:
            out: list[tuple] = []
            names = zip(*(batch.column(c).to_pylist() for c in _KEY))
            for own, middle, n in zip(names, batch.column("middle").to_pylist(), batch.column("n").to_pylist()):
                if own != key:
                    out += _group(key, middles, counts)
                    key, middles, counts = own, [], []
                middles.append(middle)
                counts.append(n)
            yield _table(out)
        yield _table(_group(key, middles, counts))

    return dealt.mapInArrow(run, "word string, n_near long, best struct<minus_n:long,word:string>")


def _group(key: tuple | None, middles: list[str], counts: list[int]) -> Iterator[tuple]:
    """(word, near words, occurrences and middle of the best) of the queries of a group."""
    if len(middles) < 2:
        return
    m, lo, hi, prefix, suffix = key
    for query in middles:
        if len(query) != hi - lo:
            continue
        # The window of the first difference counts the pair; the last one also that at the end.
        near = [i for i in one_edit_away(query, middles) if hi == m or _common(query + suffix, middles[i] + suffix) < hi - lo]
        if near:
            best = min(near, key=lambda i: (-counts[i], middles[i] + suffix))
            yield prefix + query + suffix, len(near), -counts[best], prefix + middles[best] + suffix


def _common(a: str, b: str) -> int:
    k = 0
    while k < len(a) and k < len(b) and a[k] == b[k]:
        k += 1
    return k


def _table(rows: list[tuple] | Iterator[tuple]) -> pa.RecordBatch:
    word, many, minus, best = map(list, zip(*rows)) if (rows := list(rows)) else ([], [], [], [])
    best = pa.StructArray.from_arrays([pa.array(minus, pa.int64()), pa.array(best, pa.string())], names=["minus_n", "word"])
    return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(many, pa.int64()), best], names=["word", "n_near", "best"])


def spelling_groups(words: DataFrame, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of (word, n).

    The form is the near word of most occurrences (ties: smallest in code-point order), if it has ``ratio`` times those of
    the word; else null, as ``form_n``. The root is where forms lead in the end, the word itself without one. Rows whose
    word is null go, repeated words are added up, an empty table gives no rows, and other columns do not matter.
    """
    words = settled(words.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    near = near_words(words, group)
    zero = F.lit(None).cast("struct<minus_n:bigint,word:string>")
    both = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), zero.alias("best")).unionByName(
        near.select("word", F.lit(None).cast("long").alias("n"), "n_near", "best")
    )
    told = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    tied = -F.col("best.minus_n") >= ratio * F.col("n")
    forms = settled(
        told.select("word", F.when(tied, F.col("best.word")).alias("form"), "n", "n_near", F.when(tied, -F.col("best.minus_n")).alias("form_n")),
        "spelling-forms",
    )
    roots = _roots(forms).withColumnRenamed("word", "_word")
    return forms.join(roots, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. Steps double, and every step multiplies occurrences, so rounds are few."""
    step = settled(forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = settled(
            step.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-steps",
        )
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        step = step.select("word", "root")


_UPPER = "".join(map(chr, range(65, 91)))
WORD = r"[a-zÀ-ÿ]"


def words_with_slips(docs: DataFrame, least: int = 6, often: int = 5, one_in: int = 199) -> DataFrame:
    """(word, n): words of at least ``least`` code points that occur ``often`` in all texts of (doc_id, text).

    A word is a whole run of letters, of which only A-Z are lower-cased. Where ``one_in`` divides h, the crc32 of
    ``doc_id:word``, it loses its code point h mod length. Null texts have no words; a null id is written as nothing.
    """
    # A run that is too short before the slip is too short after it.
    runs = F.regexp_extract_all(F.translate("text", _UPPER, _UPPER.lower()), F.lit(f"{WORD}{{{least},}}"), F.lit(0))
    own = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    own = own.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped: Column = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = own.select(F.when(F.col("h") % one_in == 0, slipped).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= often)


# crc32 is spelt out: a table of 256 values made by its rule, folded over the bytes of the text.
SQL = """
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), runs AS (
    SELECT DISTINCT doc_id, run, count(*) OVER (PARTITION BY doc_id, run) AS many
    FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
          FROM documents)
    WHERE length(run) >= 6
), coded AS (
    SELECT run, many, hex(encode(doc_id || ':' || run)) AS x FROM runs
), hashed AS (
    SELECT run, many, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
        lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS h
    FROM coded, crc_table
), words AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, many FROM hashed
), v AS (
    SELECT word, CAST(sum(many) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(many) >= 5
), cut AS (
    SELECT word, n, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
), shorter AS (
    SELECT DISTINCT a.word AS long_word, a.n AS long_n, b.word AS short_word, b.n AS short_n FROM cut a JOIN v b ON b.word = a.l || a.r
), near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
    UNION ALL SELECT long_word, long_n, short_word, short_n FROM shorter
    UNION ALL SELECT short_word, short_n, long_word, long_n FROM shorter
), best AS (
    SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n FROM near
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
), forms AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form,
        CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n
    FROM v LEFT JOIN best USING (word)
), chain AS (
    SELECT word, word AS place FROM forms
    UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.place WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, chain.place AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain USING (word) JOIN forms last ON last.word = chain.place AND last.form IS NULL
"""
