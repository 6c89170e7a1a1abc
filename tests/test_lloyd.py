"""k-means of several k at once against Spark's own, one by one."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from millrace.operators import lloyd
from millrace.plans import clustering
from millrace.plans.clustering import TIGHT, cost_sweep, entropy_sweep, k_means
from millrace.plans.features import numeric_features


@pytest.fixture(scope="module")
def rows(spark):
    noise = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10**9)) / 10**8).alias(c) for i, c in enumerate("abc")]
    df = spark.range(6000).select(*noise, F.when(F.col("id") % 7 > 0, F.col("id") % 3).cast("string").alias("label"))
    return df.repartition(3, "a").sortWithinPartitions("a", "b", "c")


@pytest.mark.parametrize("steps", [2, 5])
def test_centers_are_those_of_spark(rows, steps):
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(rows).select("v").persist()
    ks, settings = [2, 9, 40], {"initSteps": steps, "maxIter": 7, "tol": 1e-5}
    blocks = lloyd.matrices(vectors, "v").persist()
    sizes = lloyd.rows_of(blocks)
    near = lloyd.gathered(blocks, sizes).persist()
    assert near.agg(F.sum("n")).first()[0] == 6000
    got = lloyd.moved_centers(near, lloyd.start_centers(blocks, near, sizes, ks, 17, steps), 7, 1e-5)
    for k, centers in zip(ks, got, strict=True):
        wanted = k_means(k, "v", **settings).fit(vectors).clusterCenters()
        assert np.allclose(centers, wanted, rtol=1e-9)


def test_a_sweep_runs_as_many_jobs_for_five_k_as_for_one(spark, rows):
    def jobs(ks):
        spark.sparkContext.setJobGroup("sweep", "of k")
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("sweep"))
        cost_sweep(rows.select("a", "b"), numeric_features(rows.select("a", "b"), ""), ks, maxIter=3, tol=0.0)
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup("sweep")) - before
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found

    assert jobs([3, 4, 5, 6, 7]) <= jobs([3]) + 4


def test_other_settings_are_fitted_by_spark_with_the_same_scores(rows, monkeypatch):
    numbers = rows.select("a", "b", "c", "label")
    features = numeric_features(numbers, "label")
    scores = []
    for plain in (True, False):
        if not plain:
            monkeypatch.setattr(clustering, "_is_plain", lambda estimator: False)
        found = [*cost_sweep(numbers.drop("label"), features, [5, 3], **TIGHT).collect(), *entropy_sweep(numbers, features, "label", [5, 3], "features", **TIGHT).collect()]
        assert [r.k for r in found] == [5, 3, 5, 3]
        scores.append([r.score for r in found])
    assert scores[0] == pytest.approx(scores[1], rel=1e-9)


def test_draws_are_those_of_spark(spark):
    package = spark.sparkContext._jvm.org.apache.spark.util.random
    random = package.XORShiftRandom(5)
    wanted = [random.nextDouble() for _ in range(40)]
    state = getattr(getattr(package, "XORShiftRandom$"), "MODULE$").hashSeed(5)
    assert lloyd.draws(state, 40, lanes=1).tolist() == wanted and lloyd.draws(state, 40, lanes=7).tolist() == wanted
    java, own = spark.sparkContext._jvm.java.util.Random(0), lloyd._Random(0)
    for n in (1, 7, 8, 1000):
        assert own.double() == java.nextDouble() and own.below(n) == java.nextInt(n)


def test_centers_left_out_are_not_the_nearest():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4, 5000)).round(1)
    x = np.ascontiguousarray(x[:, lloyd._near_together(x)])
    for k in (1, 2, 30, 300):
        centers = rng.normal(size=(k, 4))
        far = np.square(x.T[:, None, :] - centers[None]).sum(2)
        assert (far.min(1) - far[np.arange(5000), lloyd._nearest(x, centers)[0]] > -1e-9).all()


def test_equal_rows_and_fewer_kinds_than_centers(spark):
    rows = spark.createDataFrame([(float(i % 2),) for i in range(50)], "a double")
    assert [r.score for r in cost_sweep(rows, numeric_features(rows, ""), [2, 3], initSteps=5).collect()] == [0.0, 0.0]
    with pytest.raises(ValueError, match="no rows"):
        cost_sweep(rows.limit(0), numeric_features(rows, ""), [2])
