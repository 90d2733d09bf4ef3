"""The classifier: held-out accuracy, the sum-of-squares identity, and odd inputs."""

import zlib

import numpy as np
import pytest

from moorage.llm import quality as q
from moorage.llm.common import prepare, run_starts


@pytest.fixture(scope="module")
def machine(spark):
    prepare(spark)
    base = "/root/testdata/sf0.01"
    return q.fit(spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet"))


def test_linear_time_identity(machine):
    raw = [b"some words, and more words here", b"", "é ñ".encode(), b"x " * 50]
    slots, values, starts = machine.rows(*q.describe(raw))
    got = machine.score(slots, values, starts)[0]
    for k, (a, b) in enumerate(zip(starts, starts[1:])):
        v, x = machine.vector[slots[a:b]].astype(float), values[a:b].astype(float)
        pairs = sum(v[i] @ v[j] * x[i] * x[j] for i in range(len(x)) for j in range(i))
        assert abs(machine.bias + machine.weight[slots[a:b]] @ x + pairs - got[k]) < 1e-3


def test_held_out_accuracy(spark, machine):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    rows = q.scored(docs, labels).join(labels, "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert len(out) > 50 and np.mean([r.predicted == r.quality for r in out]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_labels_change_nothing(spark):
    prepare(spark)
    base = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    flipped = labels.withColumn("quality", (q.F.when(q.learning(q.F.col("doc_id")), q.F.col("quality")).otherwise(1 - q.F.col("quality"))))
    scores = [{r.doc_id: r.score for r in q.scored(docs, own).collect()} for own in (labels, flipped)]
    assert scores[0] == scores[1]
    shuffled = q.scored(docs.repartition(7), labels.repartition(3)).collect()
    assert {r.doc_id: r.score for r in shuffled} == pytest.approx(scores[0], abs=1e-6)


def test_edge_cases(spark):
    prepare(spark)
    rows = [(1, None), (2, ""), (None, "text"), (3, "long words " * 30_000), (4, "a"), (4, "a"), (5, "é\n\n|!")]
    docs = spark.createDataFrame([(i, t, 0.5, {"x": 1}) for i, t in rows], "doc_id long, text string, score double, stats map<string,int>")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 1), (4, 0), (99, 1), (None, 1), (5, None)], "doc_id long, quality int")
    found = q.scored(docs, labels).collect()
    assert len(found) == len(rows) and len({r.score for r in found if r.doc_id == 4}) == 1
    assert {r.score for r in q.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert q.scored(docs.limit(0), labels).count() == 0
    kept = q.accepted(docs, labels, keep=0.0)
    assert kept.schema == docs.schema and kept.count() == len(rows)


def test_statistics_are_finite_and_per_text():
    raw = [b"", b"One two. Two!\nONE", b"\xff\xfe", b"a" * 1000]
    together = q.describe(raw)[0]
    assert np.isfinite(together).all() and together.shape == (4, q.STATISTICS)
    for row, text in zip(together, raw):
        assert np.allclose(row, q.describe([text])[0][0])
    starts = run_starts(q.describe(raw)[3])
    assert starts[1] == 0
