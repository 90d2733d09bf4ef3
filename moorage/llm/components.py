"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.session import settled


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); a component is named by its smallest id.

    Each round connects every id to the least id it sees, larger neighbours first, then smaller ones, so paths shrink
    by halves; rounds end when the links stay the same. Rounds are written, so none depends on lost executors.
    """
    current = settled(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    last = _digest(current)
    while last[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = settled(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
        current = settled(small.distinct(), "small-star")
        now = _digest(current)
        if now == last:
            break
        last = now
    names = current.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    return names.unionByName(names.select(F.col("component").alias("id"), "component").distinct())


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 31)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)
