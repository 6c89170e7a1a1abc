"""Sampled forests, their trees fitted in parts that run at the same time.

A tree of a forest draws its rows and columns for itself, so forests of some of
the trees under other seeds are together the forest of all. A fit keeps
statistics of every node of a step in each of its tasks and sends all of them
through the shuffle: on rows that fill few tasks, several fits of few tasks cost
less than one fit of many.
"""

from __future__ import annotations

import math
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame

from millrace.plans.derived import _java_array

# Fits at the same time over rows of one full task; over more rows, which have more tasks, fewer.
FITS = 12
FULL_TASK = 1 << 20

# Rows up to which the forest is one fit.
FEW_ROWS = 1 << 15

# Between the seeds of two parts; Spark adds a partition's number to a seed.
_STRIDE = 1_000_003


def is_sampled(estimator: Estimator) -> bool:
    return isinstance(estimator, (RandomForestClassifier, RandomForestRegressor)) and estimator.getBootstrap()


def parts_of(estimator: Estimator, rows: int) -> list[int]:
    """Trees of each part of a forest over so many rows; the cores play no part."""
    trees = estimator.getNumTrees()
    parts = 1 if rows <= FEW_ROWS else min(trees, max(1, FITS // math.ceil(rows / FULL_TASK)))
    return [trees // parts + (k < trees % parts) for k in range(parts)]


def fit_forest(estimator: Estimator, rows: DataFrame) -> Model:
    """The sampled forest over rows that are held: they are gone over by every part."""
    sizes = parts_of(estimator, rows.count())
    if len(sizes) == 1:
        return estimator.fit(rows)
    seed = estimator.getSeed()
    parts = [estimator.copy({estimator.numTrees: n, estimator.seed: seed + _STRIDE * k}) for k, n in enumerate(sizes)]
    with ThreadPool(len(parts)) as pool:
        # properties of its own for each job: two jobs that share them fail at times
        jobs = [inheritable_thread_target(partial(part.fit, rows)) for part in parts]
        fitted = pool.map(lambda job: job(), jobs, chunksize=1)
    model = estimator._copyValues(_joined(fitted))
    model._transfer_params_to_java()  # the number of trees is read there
    return model


def _joined(models: list[Model]) -> Model:
    """One forest of the trees of several."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    trees = [tree for model in models for tree in model._java_obj.trees()]
    first, ml = models[0]._java_obj, sc._jvm.org.apache.spark.ml
    if isinstance(models[0], RandomForestClassificationModel):
        kind, forest, more = ml.classification.DecisionTreeClassificationModel, ml.classification.RandomForestClassificationModel, [first.numClasses()]
        wrap = RandomForestClassificationModel
    else:
        kind, forest, more, wrap = ml.regression.DecisionTreeRegressionModel, ml.regression.RandomForestRegressionModel, [], RandomForestRegressionModel
    return wrap(forest(first.uid(), _java_array(sc, kind, trees), first.numFeatures(), *more))
