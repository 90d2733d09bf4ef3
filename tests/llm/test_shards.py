"""Sharding: whole records, gapless slots, the law of the shards, and even shuffles."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from moorage.llm import shards as s
from moorage.llm.common import prepare


def run(spark, rows, **options):
    prepare(spark)
    docs = spark.createDataFrame([(i, t, {"a": 1}, 9) for i, t in rows], "doc_id long, text string, shard map<string,int>, draw int")
    return s.shuffled_shards(docs, **options).collect()


def check(found, rows, shards):
    assert Counter((r.record.doc_id, r.record.text) for r in found) == Counter(rows)
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
        assert 0 <= r.shard < shards and r.grown_shard in (r.shard, shards)
        assert r.size == len((r.record.text or "").encode()) + 8
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


@pytest.mark.parametrize("bucket_bytes", [1 << 24, 500])
def test_records_and_slots(spark, bucket_bytes):
    rows = [(i, f"text {i} " * (i % 9)) for i in range(600)] + [(None, None), (None, "x"), (7, ""), (7, ""), (8, "é" * 20_000)]
    found = run(spark, rows, shards=5, bucket_bytes=bucket_bytes)
    check(found, rows, 5)
    grown = [r for r in found if r.grown_shard == 5]
    assert 60 < len(grown) < 150
    again = run(spark, rows, shards=5, bucket_bytes=bucket_bytes)
    assert {(r.record.doc_id, r.record.text): r.shard for r in found} == {(r.record.doc_id, r.record.text): r.shard for r in again}


def test_repeated_rows_are_scattered_over_buckets(spark):
    found = run(spark, [(3, "same text")] * 400, shards=4, bucket_bytes=400)
    check(found, [(3, "same text")] * 400, 4)
    assert len({r.shard for r in found}) == 1


def test_slots_do_not_follow_ids(spark):
    found = run(spark, [(i, "t") for i in range(4000)], shards=2, bucket_bytes=4000)
    own = [r.record.doc_id for r in sorted((r for r in found if r.shard == 0), key=lambda r: r.slot)]
    n = len(own)
    rising = sum(a < b for a, b in zip(own, own[1:]))
    assert 0.42 * n < rising < 0.58 * n


def test_few_rows(spark):
    assert run(spark, []) == []
    check(run(spark, [(1, None)], shards=1), [(1, None)], 1)


def test_written_shards(spark, folder):
    prepare(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    placed = s.shuffled_shards(docs)
    s.write_shards(placed, folder + "/out")
    back = spark.read.parquet(folder + "/out")
    assert back.count() == docs.count()
    assert back.select(*docs.columns).exceptAll(docs).count() == 0
    want = {(r.doc_id, r.shard) for r in placed.select("record.doc_id", "shard").collect()}
    assert {(r.doc_id, r["_shard"]) for r in back.select("doc_id", "_shard").collect()} == want
    crc = placed.select(F.crc32(F.col("record.text").cast("binary")).alias("c")).agg(F.sum("c")).first()[0]
    assert crc == docs.agg(F.sum(F.crc32(F.col("text").cast("binary")))).first()[0]
