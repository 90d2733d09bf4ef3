"""An order as data: every row's place in a total order, without bringing the rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moorage.session import settled

# Rows of one partition that a row id tells apart: its lower bits are the place in the partition.
_PLACE_BITS = 33


def with_position(df: DataFrame, *order: Column | str, name: str = "position", tasks: int | None = None) -> DataFrame:
    """Adds each row's place, from 0, in the order of ``order``; rows that are equal in it follow each other in any order.

    Rows are dealt by ranges and sorted in their task, which numbers them. The ranges are counted, and what lies before each
    of them is added: only one number for each range meets in a task. The numbered rows are written once, so a repeated
    task cannot number them anew.
    """
    many = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(many, *order).sortWithinPartitions(*order)
    numbered = dealt.withColumn("_row", F.monotonically_increasing_id())
    placed = settled(
        numbered.withColumns({"_range": F.shiftrightunsigned("_row", _PLACE_BITS), "_row": F.col("_row").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))}),
        "positions",
    )
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = settled(sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")), "range-sizes")
    return placed.join(before, "_range").withColumn(name, F.col("_before") + F.col("_row")).drop("_range", "_row", "_before")
