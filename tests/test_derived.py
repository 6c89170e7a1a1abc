"""Grid points taken from another point's fit equal fits of their own."""

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler

from millrace.plans import boosting, regression, trees
from millrace.plans.derived import point_model, shared_fits
from millrace.plans.tuning import bucketed, fit_points, k_folds, param_grid, score_all, tune


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(600):
        x = [rng.random() for _ in range(3)]
        data.append((i, *x, float(x[0] + rng.gauss(0, 0.25) > 0.5) if i % 7 else float(i % 3 == 0)))
    df = spark.createDataFrame(data, "id long, a double, b double, c double, y double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(bucketed(df, ["id"], 3)).repartition(2, "id").persist()


def _all_points(rows, estimator, grid):
    models = {}
    for shared in shared_fits(estimator, grid):
        models.update(fit_points(estimator, grid, rows, shared))
    return [models[i] for i in range(len(grid))]


def _probabilities(model, rows):
    return [(r.id, list(r.probability), r.prediction) for r in model.transform(rows).orderBy("id").select("id", "probability", "prediction").collect()]


def test_grids_need_few_fits(spark):
    boost, tree, line = GBTClassifier(), DecisionTreeClassifier(), LogisticRegression()
    assert len(shared_fits(boost, param_grid(boost, **boosting.FOLD_GRID))) == 4
    assert len(shared_fits(tree, param_grid(tree, **trees.TREE_GRID))) == 4
    assert len(shared_fits(line, param_grid(line, **regression.LOGISTIC_GRID))) == 8


def test_a_shorter_boosted_model_is_the_head_of_a_longer_one(rows):
    boost = GBTClassifier(labelCol="y", maxDepth=4, seed=3)
    grid = param_grid(boost, maxIter=[1, 3, 6], maxBins=[8, 16])
    for model, point in zip(_all_points(rows, boost, grid), grid, strict=True):
        assert _probabilities(model, rows) == _probabilities(boost.fit(rows, point), rows)


def test_a_tree_of_a_smaller_grid_point_is_the_deep_tree_cut(rows):
    tree = DecisionTreeClassifier(labelCol="y", seed=3)
    grid = param_grid(tree, impurity=["gini", "entropy"], maxDepth=[0, 1, 3, 20], minInfoGain=[0.0, 0.01, 0.05, 0.5])
    sizes = set()
    for model, point in zip(_all_points(rows, tree, grid), grid, strict=True):
        own = tree.fit(rows, point)
        assert (model.numNodes, model.depth) == (own.numNodes, own.depth)
        assert model.toDebugString.split("\n", 1)[1] == own.toDebugString.split("\n", 1)[1]
        assert _probabilities(model, rows) == _probabilities(own, rows)
        sizes.add(model.numNodes)
    assert len(sizes) > 4


def test_a_logistic_model_is_shared_only_where_it_converged(rows):
    line = LogisticRegression(labelCol="y")
    grid = param_grid(line, maxIter=[2, 50], regParam=[0.01, 5.0], elasticNetParam=[0.5])
    for model, point in zip(_all_points(rows, line, grid), grid, strict=True):
        own = line.fit(rows, point)
        assert model.coefficients == own.coefficients and model.intercept == own.intercept
    whole = line.fit(rows, grid[-1])
    assert point_model(line, whole, grid[-1], grid[-1]) is whole


@pytest.mark.parametrize("metric", ["f1", "accuracy"])
def test_one_scan_scores_as_an_evaluator_does(rows, metric):
    tree = DecisionTreeClassifier(labelCol="y", seed=3)
    models = _all_points(rows, tree, param_grid(tree, maxDepth=[0, 2, 9]))
    judge = MulticlassClassificationEvaluator(labelCol="y", metricName=metric)
    assert score_all(models, rows, "y", metric) == pytest.approx([judge.evaluate(m.transform(rows)) for m in models])
    assert "probability" in models[2].transform(rows).columns  # the models themselves stay whole


def test_tuning_scores_are_those_of_separate_fits(rows):
    boost = GBTClassifier(labelCol="y", maxDepth=3, seed=3)
    grid = param_grid(boost, maxIter=[1, 4], maxBins=[8, 16])
    tuned = tune(rows, boost, grid, k_folds(3), "y")
    judge = MulticlassClassificationEvaluator(labelCol="y", metricName="f1")
    want = []
    for point in grid:
        parts = [(rows.where(a), rows.where(b)) for a, b in k_folds(3)]
        want.append(sum(judge.evaluate(boost.fit(a, point).transform(b)) for a, b in parts) / 3)
    assert tuned.scores == pytest.approx(want)
    assert tuned.best == want.index(max(want))
