"""Shards by a two-pass external shuffle, in DataFrame operations only.

Pass one scatters whole records by seeded hashes into buckets of a shard, each small enough for a task's memory.
Pass two shuffles every bucket with Fisher-Yates (Spark's seeded ``shuffle``), and the buckets of a shard follow one
another. The shard itself is a matter of ``doc_id`` and the number of shards alone (rendezvous hashing), so one more
shard takes records only into itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorage.session import settled

SHARDS = 24
SEED = 20
BUCKET_BYTES = 16 << 20


def text_size(text: str = "text"):
    """UTF-8 bytes of the text (null: none) plus 8 for the id."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(8).cast("long")


def rendezvous(key, shards: int):
    """The shard whose hash with the key is largest; shards 0 to n - 1 keep their rank when n grows."""
    bids = [F.struct(F.xxhash64(F.lit(SEED), key, F.lit(i)).alias("bid"), F.lit(i).alias("shard")) for i in range(shards)]
    return F.greatest(*bids).getField("shard") if shards > 1 else F.lit(0)


def shuffled_shards(
    docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Every record with its size, shard, slot there (gapless from 0, in shuffled order) and ``grown_shard``.

    The columns of ``docs`` come back inside ``record``, so no name can clash. Null keys hash like a value of their
    own. Repeated rows stay repeated; they share a shard, as the law demands, but are scattered over its buckets. A
    null text counts 8 bytes. An empty table gives no rows.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    sized = docs.select(record.alias("record"), text_size(text).alias("size"), rendezvous(F.col(key), shards).alias("shard"))

    # How many buckets each shard needs: one row a shard.
    bytes_of = dict(sized.groupBy("shard").agg(F.sum("size").alias("bytes")).collect())
    buckets = [max(1, -(-(bytes_of.get(s) or 0) // bucket_bytes)) for s in range(shards)]
    bases = [sum(buckets[:s]) for s in range(shards)]
    many, base = F.array(*map(F.lit, buckets))[F.col("shard")], F.array(*map(F.lit, bases))[F.col("shard")]

    # Pass one. A record's place in the input enters its draw, so that equal rows part.
    draw = F.xxhash64(F.lit(SEED + 1), F.col(f"record.`{key}`"), F.monotonically_increasing_id())
    drawn = sized.withColumn("draw", draw)
    scattered = drawn.withColumn("bucket", (base + F.pmod("draw", many)).cast("int")).repartitionById(sum(buckets), F.col("bucket"))

    # Pass two. Arrival order depends on the cluster, so a bucket is put in the order of its draws first.
    items = F.array_sort(
        F.collect_list(F.struct("draw", "size", "record")),
        lambda a, b: F.when(a["draw"] < b["draw"], -1).when(a["draw"] > b["draw"], 1).otherwise(0),
    )
    pool = scattered.groupBy("bucket").agg(F.first("shard").alias("shard"), items.alias("items"))
    pool = pool.select("bucket", "shard", F.posexplode(F.shuffle("items", seed=SEED)).alias("place", "item"))
    placed = settled(pool.select("bucket", "shard", "place", "item.size", "item.record"), "shards")

    # The buckets of a shard stand one after another.
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    starts = starts.select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    # Written, so that its size is known and the records need no third shuffle where it is small.
    return placed.join(settled(starts, "bucket-starts"), "bucket").select(
        "record",
        "size",
        "shard",
        (F.col("start") + F.col("place")).alias("slot"),
        rendezvous(F.col(f"record.`{key}`"), shards + 1).alias("grown_shard"),
    )


def write_shards(shuffled: DataFrame, path: str) -> None:
    """A folder for each shard, its records in the order of their slots within each file."""
    rows = shuffled.select("record.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    rows.hint("rebalance", "_shard").sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)
