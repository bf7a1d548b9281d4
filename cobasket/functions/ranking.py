"""Positions in a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cobasket.session import checkpointed

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its lower 33 bits


def with_rank(df: DataFrame, *order: str | Column, name: str = "rank") -> DataFrame:
    """Number all rows 1, 2, ... in ``order``, without bringing them into one task.

    The global sort range-partitions the rows, so a row's rank is its place in its partition plus the sizes of the
    partitions before it. The places are checkpointed before the sizes are counted: both then come from one sort,
    also when an executor is lost in between. The only unpartitioned window runs over one row per partition, which
    also bounds the broadcast side.
    """
    placed = checkpointed(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    placed = (placed.withColumn("_part", F.shiftright("_place", _ROW_BITS))
              .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count("*").alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + F.col("_row") + 1)
            .drop("_place", "_part", "_row", "_n", "_before"))


def top_ranked(df: DataFrame, k: int, *order: str | Column, name: str = "rank") -> DataFrame:
    """The first ``k`` rows in ``order``, numbered. The window sees ``k`` rows at most."""
    return df.orderBy(*order).limit(k).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def first_per_group(df: DataFrame, keys: list[str], k: int, *order: str | Column) -> DataFrame:
    """At most ``k`` rows of each group, in ``order``.

    Spark turns this into a group limit before the shuffle: however large a group, a task passes on ``k`` rows of it.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= k).drop("_n")
