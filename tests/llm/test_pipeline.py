"""The pipeline against a version that decides document by document, and its registration."""

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from moorage.llm import decontaminate, packing, quality
from moorage.llm.common import prepare
from tests.llm.test_jaccard import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    prepare(spark)
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    machine = quality.fit(docs, labels)
    good = {i: t for i, t in rows.items() if machine.probability([t.encode()])[0] >= quality.KEEP}
    named = brute(sorted(good.items()))
    single = {i: good[i] for i, _, name in named if i == name}
    items = next(decontaminate.item_blocks(spark.read.parquet(f"{SF}/benchmark.parquet")))
    clean = {i: t for i, t in single.items() if not items.leaks([t.encode()])}
    assert len(rows) > len(good) > len(single) > len(clean)

    own = docs
    for (_, stage), want in zip(pipeline.STAGES[:3], (good, single, clean)):
        own = stage(spark, own, SF)
        assert own.schema == docs.schema
        own = spark.createDataFrame(own.collect(), docs.schema)
        assert {r.doc_id: r.text for r in own.collect()} == want
    found = pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in found} == set(clean)
    fill = {}
    for r in found:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= packing.LENGTH


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and [n for n, _ in pipeline.STAGES] == ["quality", "near duplicates", "decontamination", "packing"]
