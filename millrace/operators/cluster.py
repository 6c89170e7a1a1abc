"""Centers, distances and anomalies."""

from __future__ import annotations

from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from millrace.functions import as_doubles, squared_distance
from millrace.operators.rank import kth_largest
from millrace.session import BROADCAST_BYTES, cut_lineage

CENTER_SCHEMA = StructType(
    [StructField("cluster", IntegerType()), StructField("center", ArrayType(DoubleType()))]
)


def center_table(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """The fitted centers as rows (cluster, center)."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, CENTER_SCHEMA)


def group_centers(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, summed inside the partitions before the shuffle."""
    mean = Summarizer.mean(array_to_vector(as_doubles(vector)))
    means = df.groupBy(F.col(group).cast("int").alias("cluster")).agg(mean.alias("m"))
    return means.select("cluster", vector_to_array("m").alias("center"))


def _nearest(centers: list[tuple[int, list[float]]]):
    """A column function: the better of the best center so far and these."""
    ids = np.array([int(i) for i, _ in centers], dtype="int32")
    points = np.array([c for _, c in centers], dtype="float64")
    norms = np.square(points).sum(axis=1)

    @F.pandas_udf("cluster int, dist double")
    def closer(vector: pd.Series, cluster: pd.Series, dist: pd.Series) -> pd.DataFrame:
        best, found = dist.to_numpy("float64").copy(), cluster.to_numpy("int32").copy()
        use = np.array([v is not None and not np.isnan(np.asarray(v, "float64")).any() for v in vector], dtype=bool)
        at = np.flatnonzero(use)
        for lo in range(0, len(at), 4096):
            part = at[lo : lo + 4096]
            rows = np.stack([np.asarray(v, "float64") for v in vector.iloc[part]])
            # |x|^2 - 2 x.c + |c|^2 only picks; near ties and the distance itself are taken exactly
            rough = norms - 2 * (rows @ points.T)
            low = rough.min(axis=1)
            slack = 1e-9 * (np.square(rows).sum(axis=1) + norms.max())
            near = rough <= (low + slack)[:, None]
            r, c = np.nonzero(near)
            exact = np.square(rows[r] - points[c]).sum(axis=1)
            order = np.lexsort((ids[c], exact, r))
            first = order[np.concatenate([[True], r[order][1:] != r[order][:-1]])]
            d, pick = exact[first], ids[c[first]]
            nearer = d < best[part]
            best[part[nearer]], found[part[nearer]] = d[nearer], pick[nearer]
        return pd.DataFrame({"cluster": found, "dist": best})

    return closer


def nearest_center(df: DataFrame, vector: str, centers: DataFrame) -> DataFrame:
    """Add the closest center's id and squared distance; ties go to the lower id.

    A null vector, or one with a null or NaN in it, gets a null id and distance.
    No join and no shuffle: the centers visit the rows, in blocks of a bounded
    size. A center set above that bound takes one pass per block, with the best
    so far written to shared storage in between.
    """
    rows = iter(centers.orderBy("cluster").toLocalIterator())
    first = next(rows, None)
    if first is None:
        raise ValueError("no centers to be near to")
    block_rows = max(1, BROADCAST_BYTES // (8 * len(first.center)))
    rows = chain([first], rows)
    out = df.withColumn("_best", F.struct(F.lit(-1).alias("cluster"), F.lit(float("inf")).alias("dist")))
    block = list(islice(rows, block_rows))
    while block:
        closer = _nearest(block)
        out = out.withColumn("_best", closer(as_doubles(vector), F.col("_best.cluster"), F.col("_best.dist")))
        block = list(islice(rows, block_rows))
        if block:
            out = cut_lineage(out)
    known = F.col("_best.cluster") >= 0
    return out.select(
        *df.columns, F.when(known, F.col("_best.cluster")).alias("cluster"), F.when(known, F.col("_best.dist")).alias("dist")
    )


def join_centers(df: DataFrame, centers: DataFrame, cluster: str = "cluster", name: str = "center") -> DataFrame:
    """Give each row the center of its own cluster, null where there is none.

    Centers within the size limit are broadcast. A larger set takes a shuffle
    join, where adaptive execution splits the partition of a cluster that holds
    a large part of the rows.
    """
    centers = cut_lineage(centers)  # their plan runs once, for the size and the join
    named = centers.select(F.col("cluster").alias("_of_cluster"), F.col("center").alias(name))
    size = centers.agg(F.sum(8 * F.size("center") + 16)).first()[0] or 0
    named = F.broadcast(named) if size <= BROADCAST_BYTES else named.hint("merge")
    return df.join(named, F.col(cluster) == F.col("_of_cluster"), "left").drop("_of_cluster")


def distance_to_center(
    df: DataFrame, centers: DataFrame, vector: str, cluster: str = "cluster", name: str = "dist", center: str | None = None
) -> DataFrame:
    """Add the squared distance of each row to the center of its own cluster, null where that has none.

    `center` names a column for that center itself.
    """
    joined = join_centers(df, centers, cluster, "_own_center")
    own = [F.col("_own_center").alias(center)] if center else []
    return joined.select(*df.columns, *own, squared_distance(F.col(vector), F.col("_own_center")).alias(name))


def mean_cost(df: DataFrame, dist: str = "dist") -> DataFrame:
    """Mean squared distance to the own center."""
    return df.agg(F.avg(dist).alias("cost"))


def at_least_kth(df: DataFrame, value: str, k: int) -> DataFrame:
    """Rows whose value reaches the k-th largest, ties included.

    The threshold is a one-row subquery. Ranking all rows instead would sort
    the whole table.
    """
    return df.where(F.col(value) >= kth_largest(df, value, k).scalar())
