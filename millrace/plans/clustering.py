"""k-means: scores over k, clusters against labels, anomalies."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial
from itertools import accumulate
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from millrace.operators import lloyd
from millrace.operators.cluster import CENTER_SCHEMA, at_least_kth, center_table, distance_to_center, mean_cost
from millrace.operators.counts import cluster_label_counts, largest_cluster_labels, weighted_entropy
from millrace.plans.models import SEED
from millrace.session import cut_lineage, held

# Settings the results have to match.
TIGHT = {"maxIter": 40, "tol": 1e-5}
SWEEP_COARSE = range(20, 101, 20)
SWEEP_FINE = range(60, 271, 30)
ANOMALY_K = 150
ANOMALY_TOP = 100


@dataclass(frozen=True)
class Clusters:
    """Fitted feature stages and k-means model."""

    features: PipelineModel
    model: KMeansModel
    vector: str

    def assign(self, df: DataFrame) -> DataFrame:
        """The input columns and the cluster."""
        return self._predict(df).select(*df.columns, "cluster")

    def label_counts(self, df: DataFrame, label: str) -> DataFrame:
        return cluster_label_counts(self.assign(df), "cluster", label)

    def largest_labels(self, df: DataFrame, label: str, top: int = 25) -> DataFrame:
        """The first rows of the counts, by cluster and then the largest count."""
        return largest_cluster_labels(self.assign(df), "cluster", label, top)

    def centers(self, spark) -> DataFrame:
        return center_table(spark, self.model)

    def distances(self, df: DataFrame, center: str | None = None) -> DataFrame:
        """The input columns, the cluster, its center if a name is given for it, and the squared distance to it."""
        rows = self._predict(df).select(*df.columns, "cluster", vector_to_array(self.vector).alias("_v"))
        far = distance_to_center(rows, self.centers(df.sparkSession), "_v", center=center)
        return far.drop("_v")

    def cost(self, df: DataFrame) -> DataFrame:
        return mean_cost(self.distances(df))

    def entropy(self, df: DataFrame, label: str) -> DataFrame:
        return weighted_entropy(self.assign(df), "cluster", label)

    def anomalies(self, df: DataFrame, top: int = ANOMALY_TOP) -> DataFrame:
        """Rows at least as far from their center as the top-th farthest row.

        The distances are written once, for the threshold and the rows above it.
        """
        return at_least_kth(cut_lineage(self.distances(df)), "dist", top)

    def _predict(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.features.transform(df))


def k_means(k: int, vector: str, **params) -> KMeans:
    """k-means|| start with two steps, Euclidean distance, seeded.

    The block solver stacks rows into matrices, about 1.7 times as fast here as
    row by row. A block is small, as its rows times k distances are one array
    that should stay in a core's cache.
    """
    settings = {"initMode": "k-means||", "initSteps": 2, "solver": "block", "maxBlockSizeInMB": 0.004, "seed": SEED, **params}
    return KMeans(k=k, featuresCol=vector, predictionCol="cluster", **settings)


def cluster(df: DataFrame, features: PipelineModel, k: int = 2, vector: str = "features", **params) -> Clusters:
    """Fit k-means on the given feature stages' output."""
    with held(features.transform(df).select(vector)) as rows:
        return Clusters(features, k_means(k, vector, **params).fit(rows), vector)


def assigned_by_all(rows: DataFrame, models: Sequence[KMeansModel]) -> DataFrame:
    """Every row once for each model: the columns, the model's place as `_model` and the row's cluster there.

    All models see a row in one scan.
    """
    out, names = rows, [f"_cluster_{i}" for i in range(len(models))]
    for name, model in zip(names, models, strict=True):
        out = model.copy({model.predictionCol: name}).transform(out)
    return out.select(*rows.columns, F.posexplode(F.array(*names)).alias("_model", "cluster"))


def _costs(assigned: DataFrame, models: Sequence[KMeansModel], vector: str) -> DataFrame:
    """(_model, score): the mean squared distance to the own center of each model."""
    starts = [0, *accumulate(m.getK() for m in models)]
    centers = [(starts[i] + c, [float(x) for x in center]) for i, m in enumerate(models) for c, center in enumerate(m.clusterCenters())]
    table = assigned.sparkSession.createDataFrame(centers, CENTER_SCHEMA)
    own = F.col("cluster") + F.array(*map(F.lit, starts))[F.col("_model")]
    rows = assigned.select("_model", own.alias("cluster"), vector_to_array(vector).alias("_v"))
    return distance_to_center(rows, table, "_v").groupBy("_model").agg(F.avg("dist").alias("score"))


def _is_plain(estimator: KMeans) -> bool:
    """Whether `lloyd` makes the same centers: a k-means|| start and Euclidean distance, every row of weight one."""
    return estimator.getInitMode() == "k-means||" and estimator.getDistanceMeasure() == "euclidean" and not estimator.isSet("weightCol")


def _sweep(
    df: DataFrame,
    features: PipelineModel,
    vector: str,
    keep: Sequence[str],
    ks: Sequence[int],
    score: Callable[[DataFrame, Sequence[np.ndarray]], Sequence[float]],
    score_models: Callable[[DataFrame, Sequence[KMeansModel]], DataFrame],
    parallelism: int,
    params: dict,
) -> DataFrame:
    """(k, score). The vectors are computed once, and every step is one scan of them for all k.

    Settings that `lloyd` does not know are fitted one by one, some at a time, over cached vectors.
    """
    plain = k_means(max(ks), vector, **params)
    if _is_plain(plain):
        with held(lloyd.matrices(features.transform(df).select(vector, *keep), vector, *keep)) as blocks:
            sizes = lloyd.rows_of(blocks)
            with held(lloyd.gathered(blocks, sizes)) as near:
                centers = lloyd.start_centers(blocks, near, sizes, ks, plain.getSeed(), plain.getInitSteps())
                blocks.unpersist()  # one copy of the rows is enough from here
                centers = lloyd.moved_centers(near, centers, plain.getMaxIter(), plain.getTol())
                found = dict(enumerate(score(near, centers)))
    else:
        with held(features.transform(df).select(vector, *keep)) as rows, ThreadPool(parallelism) as pool:
            rows.count()
            jobs = [inheritable_thread_target(partial(k_means(k, vector, **params).fit, rows)) for k in ks]
            models = pool.map(lambda job: job(), jobs, chunksize=1)
            found = {r["_model"]: r["score"] for r in score_models(assigned_by_all(rows, models), models).collect()}
    scored = [(k, float(found[i])) for i, k in enumerate(ks)]
    return df.sparkSession.createDataFrame(scored, "k int, score double")


def cost_sweep(
    df: DataFrame,
    features: PipelineModel,
    ks: Sequence[int] = SWEEP_COARSE,
    vector: str = "features",
    parallelism: int = 2,
    **params,
) -> DataFrame:
    """Mean squared distance to the own center for each k."""

    def score_models(rows: DataFrame, models: Sequence[KMeansModel]) -> DataFrame:
        return _costs(rows, models, vector)

    return _sweep(df, features, vector, [], ks, lloyd.mean_costs, score_models, parallelism, params)


def entropy_sweep(
    df: DataFrame,
    features: PipelineModel,
    label: str,
    ks: Sequence[int] = SWEEP_FINE,
    vector: str = "scaledFeatures",
    parallelism: int = 2,
    **params,
) -> DataFrame:
    """Size-weighted label entropy inside the clusters for each k."""

    def score(blocks: DataFrame, centers: Sequence[np.ndarray]) -> Sequence[float]:
        rows = weighted_entropy(lloyd.label_counts(blocks, centers), "cluster", "label", "_model", n="n")
        found = {r["_model"]: r["entropy"] for r in rows.collect()}
        return [found[i] for i in range(len(centers))]

    def score_models(rows: DataFrame, models: Sequence[KMeansModel]) -> DataFrame:
        return weighted_entropy(rows, "cluster", label, "_model").withColumnRenamed("entropy", "score")

    return _sweep(df, features, vector, [label], ks, score, score_models, parallelism, params)
