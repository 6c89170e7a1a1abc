"""The row before and after each row in one total order, without a task that holds them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.store import written


def ordered_neighbours(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """(k, before, after) for every distinct row; k is the struct of the columns of `order`, then the rest.

    Rows are dealt by range of `order`. What a range needs of the ranges beside
    it is one row each. The first row has no `before`, the last no `after`.
    """
    rest = [c for c in rows.columns if c not in order]
    dealt = rows.distinct().repartitionByRange(*order)
    dealt = written(dealt.select(F.struct(*order, *rest).alias("k"), F.spark_partition_id().alias("part")), name)
    ends = dealt.groupBy("part").agg(F.min("k").alias("low"), F.max("k").alias("high"))
    ranges = Window.orderBy("part")  # one row for each range
    ends = ends.select(F.col("part").alias("of"), F.lag("high").over(ranges).alias("left"), F.lead("low").over(ranges).alias("right"))
    inside = Window.partitionBy("part").orderBy("k")
    dealt = dealt.select("part", "k", F.lag("k").over(inside).alias("p"), F.lead("k").over(inside).alias("q"))
    dealt = dealt.join(ends, F.col("part") == F.col("of"))
    return dealt.select("k", F.coalesce("p", "left").alias("before"), F.coalesce("q", "right").alias("after"))
