"""Positions in a total order, and values at a given position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import cut_lineage

# A top-k plan brings k rows of each partition together. Above so many rows in all, the k-th value comes from a ranking.
TOP_K_ROWS = 1_000_000

# monotonically_increasing_id holds the row's place inside its partition in the low bits.
_PLACE_BITS = 33


def total_before(df: DataFrame, weight: str, *order: Column, name: str = "rank") -> DataFrame:
    """Add the sum of `weight` over all rows that come earlier in the order.

    `order` must be unique per row, so that no value fills a partition alone.
    Rows are range-partitioned and sorted, summed inside their own partition,
    and shifted by the totals of the partitions before; only those totals, one
    per partition, meet in one task.
    """
    place = F.monotonically_increasing_id()
    placed = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place)
    ).withColumn("_part", F.shiftright("_place", _PLACE_BITS))
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(*earlier)
    sizes = placed.groupBy("_part").agg(F.sum(weight).alias("_size"))
    across = Window.orderBy("_part").rowsBetween(*earlier)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(across), F.lit(0)).alias("_start"))
    return (
        placed.withColumn("_before", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(name, F.col("_start") + F.col("_before"))
        .drop("_place", "_part", "_before", "_start")
    )


def kth_largest(df: DataFrame, value: str, k: int, name: str = "threshold") -> DataFrame:
    """One row: the k-th largest value, or the smallest when there are fewer."""
    if k * df.rdd.getNumPartitions() <= TOP_K_ROWS:
        return df.select(value).orderBy(F.desc(value)).limit(k).agg(F.min(value).alias(name))
    counts = df.groupBy(value).agg(F.count("*").alias("n"))
    ranked = total_before(counts, "n", F.desc(value))
    return ranked.where(F.col("rank") < k).agg(F.min(value).alias(name))


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows of a total order."""
    return df.orderBy(*order).limit(n)
