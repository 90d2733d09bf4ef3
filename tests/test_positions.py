"""Places in an order, and listings of every file."""

import os
import random

import pytest
from pyspark.sql import functions as F

from moorage.operators.positions import with_position
from moorage.sinks import relayout
from moorage.sources import files


@pytest.mark.parametrize("tasks", [1, 3, 16])
def test_positions_are_those_of_a_sort(spark, tasks):
    draw = random.Random(tasks)
    rows = [(draw.choice([None, 1, 2, 3]), str(draw.randrange(50))) for _ in range(300)]
    frame = spark.createDataFrame(rows, "a int, b string")
    found = with_position(frame, F.desc_nulls_last("a"), "b", tasks=tasks).collect()
    assert sorted(r.position for r in found) == list(range(300))
    ordered = [(r.a, r.b) for r in sorted(found, key=lambda r: r.position)]
    assert ordered == sorted(rows, key=lambda r: (-(r[0] or 0), r[1]))


def test_positions_of_one_hot_value_and_of_nothing(spark):
    same = spark.range(2000).select(F.lit("x").alias("k"))
    assert with_position(same, "k").agg(F.countDistinct("position"), F.max("position")).first() == (2000, 1999)
    assert with_position(same.limit(0), "k").count() == 0


def test_every_file_lists_empty_and_deep_ones(spark, folder):
    deep = f"{folder}/a/b=1/c d/e%20f"
    os.makedirs(deep)
    os.makedirs(f"{folder}/_hidden/x")
    os.makedirs(f"{folder}/none")
    for path, data in ((f"{deep}/x.parquet", "1234"), (f"{folder}/top.parquet", ""), (f"{folder}/a/y.csv", "1"), (f"{folder}/_hidden/x/z.parquet", "1"), (f"{folder}/a/.h.parquet", "1")):
        with open(path, "w") as out:
            out.write(data)
    found = {r.path.split(folder)[1]: r.length for r in files.every_file(spark, folder).collect()}
    assert found == {"/a/b=1/c d/e%20f/x.parquet": 4, "/top.parquet": 0, "/a/y.csv": 1}
    assert {r.path.split(folder)[1] for r in files.every_file(spark, folder, "*.parquet").collect()} == {"/a/b=1/c d/e%20f/x.parquet", "/top.parquet"}
    assert files.every_file(spark, f"{folder}/absent").count() == 0


def test_relayout_reports_empty_files(spark, folder):
    os.makedirs(f"{folder}/in/2024")
    open(f"{folder}/in/2024/empty.parquet", "w").close()
    done = relayout.relayout(relayout.mapping(spark, f"{folder}/in", f"{folder}/out", hive=True), f"{folder}/log").collect()
    assert [(r.status, r.target.endswith("/out/year=2024/empty.parquet")) for r in done] == [("copied", True)]


def test_create_empty(spark, folder):
    files.create_empty(spark.createDataFrame([(f"{folder}/p/q.txt",)], "path string"))
    assert os.path.getsize(f"{folder}/p/q.txt") == 0
