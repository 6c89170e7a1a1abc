"""Fits over equal rows as one are the fits over all rows."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from millrace.operators.encode import assembler, vector_indexer
from millrace.plans import compact as compact_rows
from millrace.plans.compact import WEIGHT, compact, weighted
from millrace.plans.tuning import holdout, param_grid, score_all, tune

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def signs(spark):
    """Few different rows, many times; c has seven values, y is a number, label one of three classes."""
    rng = random.Random(7)
    rows = []
    for i in range(20_000):
        a, b, c = rng.randrange(2), rng.randrange(2), rng.randrange(7)
        label = rng.choice([0, 1, 2] + [c % 3] * (1 + a) + [a + b] * 2)
        rows.append((i, float(label), a, b, c, 10.0 * a + 5 * b * c + rng.random()))
    return spark.createDataFrame(rows, "id long, label double, a int, b int, c int, y double").repartition(3).cache()


def _fitted(estimator, rows, recode=False):
    stage = assembler(NAMES, "plain" if recode else "features")
    vectors = stage.transform(rows)
    if recode:
        vectors = vector_indexer("plain", "features", 10).fit(vectors).transform(vectors)
    return weighted(estimator, rows).fit(vectors)


@pytest.mark.parametrize("recode", [False, True])
@pytest.mark.parametrize("kind", [DecisionTreeClassifier, RandomForestClassifier])
def test_a_tree_over_few_weighted_rows_is_the_tree_over_all(signs, kind, recode):
    more = {"bootstrap": False, "featureSubsetStrategy": "all", "numTrees": 3} if kind is RandomForestClassifier else {}
    tree = kind(labelCol="label", featuresCol="features", maxDepth=10, maxBins=300, seed=1, **more)
    rows = signs.select("label", *NAMES)
    few = compact(rows, tree, "label")
    # every kind of row in as many pieces as bins: Spark takes no more bins than rows
    assert few.count() == sum(min(r["n"], 300) for r in rows.groupBy(*rows.columns).agg(F.count("*").alias("n")).collect())
    assert few.agg(F.sum(WEIGHT)).first()[0] == 20_000
    text = [_fitted(tree, x, recode).toDebugString.partition("\n")[2] for x in (rows, few)]
    assert text[0] == text[1] and "Predict" in text[0]


def test_boosting_over_few_weighted_rows(signs):
    boost = GBTClassifier(labelCol="label", featuresCol="features", maxIter=4, maxDepth=6, seed=1)
    rows = signs.select((F.col("label") > 0).cast("double").alias("label"), *NAMES)
    few = compact(rows, boost, "label")
    assert few.count() < 2_000
    distinct = assembler(NAMES).transform(rows.select(*NAMES).distinct())
    one, other = ({tuple(r[:3]): r.probability for r in _fitted(boost, x).transform(distinct).select(*NAMES, "probability").collect()} for x in (rows, few))
    assert len(one) == 28
    for key, p in one.items():
        assert other[key].toArray() == pytest.approx(p.toArray(), abs=1e-9)


@pytest.mark.parametrize("kind", [DecisionTreeRegressor, GBTRegressor])
def test_numbers_of_a_group_keep_mean_and_spread(signs, kind):
    more = {"maxIter": 4} if kind is GBTRegressor else {}
    tree = kind(labelCol="y", featuresCol="features", maxDepth=6, seed=1, **more)
    rows = signs.select("y", *NAMES)
    few = compact(rows, tree, "y")
    assert few.count() == 28 * 2 * 32
    distinct = assembler(NAMES).transform(rows.select(*NAMES).distinct())
    one, other = (_fitted(tree, x) for x in (rows, few))
    found = [{tuple(r[:3]): r.prediction for r in m.transform(distinct).select(*NAMES, "prediction").collect()} for m in (one, other)]
    assert found[0] == pytest.approx(found[1])
    if kind is DecisionTreeRegressor:
        assert one._java_obj.rootNode().impurity() == pytest.approx(other._java_obj.rootNode().impurity())


def test_rows_stay_as_they_are_where_the_fit_would_change(signs):
    rows = signs.select("label", *NAMES)
    forest = RandomForestClassifier(labelCol="label", featuresCol="features")
    assert compact(rows, forest, "label") is rows
    assert compact(rows, DecisionTreeClassifier(labelCol="label", minInstancesPerNode=2), "label") is rows
    many = signs.select("label", "id")
    assert compact(many, DecisionTreeClassifier(labelCol="label"), "label") is many


def test_a_null_label_is_still_refused(signs):
    rows = signs.select(F.when(F.col("id") != 5, F.col("y")).alias("y"), *NAMES)
    tree = DecisionTreeRegressor(labelCol="y", featuresCol="features")
    with pytest.raises(Exception, match="(?i)null"):
        _fitted(tree, compact(rows, tree, "y"))


def test_tuning_counts_rows_by_their_weight(signs):
    tree = DecisionTreeClassifier(labelCol="label", featuresCol="features", seed=1)
    grid = param_grid(tree, maxDepth=[1, 6])
    rows = signs.select("label", (F.col("id") % 10).cast("int").alias("_bucket"), *NAMES)
    few = compact(rows, tree, "label", grid)
    stage = assembler(NAMES)
    one, other = (tune(stage.transform(x), tree, grid, holdout(9), "label", "f1") for x in (rows, few))
    assert one.scores == pytest.approx(other.scores, abs=1e-12) and one.best == other.best
    assert score_all([one.model], stage.transform(few), "label", "accuracy") == pytest.approx(
        score_all([one.model], stage.transform(rows), "label", "accuracy")
    )
    assert not isinstance(other.model, PipelineModel)


def test_a_tuned_logistic_model_is_fitted_on_few_weighted_rows(spark):
    rows = spark.range(9000).select(
        (F.col("id") % 2).cast("double").alias("a"), (F.col("id") % 5 > 1).cast("double").alias("b"), (F.col("id") % 3).cast("int").alias("_bucket"),
        (F.xxhash64("id") % 10 < F.when(F.col("id") % 2 == 0, 3).otherwise(-2)).cast("double").alias("label"),
    )
    for each, near in ((9000, 1e-9), (64, 1e-3)):
        plain = LogisticRegression(labelCol="label", regParam=0.05, elasticNetParam=0.3, maxIter=20)
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(compact_rows, "PIECES", each)
            few = compact_rows.compact(rows, plain, "label", logistic=True)
        kinds = rows.distinct().count()
        assert few.count() <= kinds * each and few.agg(F.sum(compact_rows.WEIGHT)).first()[0] == 9000
        stage = assembler(["a", "b"])
        whole = plain.fit(stage.transform(rows))
        found = compact_rows.weighted(plain, few).fit(stage.transform(few))
        assert found.coefficients.toArray() == pytest.approx(whole.coefficients.toArray(), rel=near)
        assert found.intercept == pytest.approx(whole.intercept, rel=near)
    assert compact_rows.compact(rows, plain, "label") is rows


def test_fits_at_the_same_time_have_properties_of_their_own(spark, monkeypatch):
    """Jobs that share them set and clear each other's execution number."""
    from millrace.plans import tuning

    wrapped = []
    plain = tuning.inheritable_thread_target
    monkeypatch.setattr(tuning, "inheritable_thread_target", lambda job: wrapped.append(job) or plain(job))
    rows = spark.createDataFrame([(float(i % 2), float(i % 2), i % 3) for i in range(60)], "a double, label double, _bucket int")
    grid = tuning.param_grid(LogisticRegression(labelCol="label"), regParam=[0.1, 0.2])
    tuning.tune(assembler(["a"]).transform(rows), LogisticRegression(labelCol="label"), grid, tuning.k_folds(3), "label")
    assert len(wrapped) == 2 * 3


@pytest.mark.parametrize("values", [False, True])
def test_nodes_of_a_tree_over_weighted_rows_count_all_rows(spark, signs, values):
    from millrace.operators.inspect import tree_nodes

    label = "y" if values else "label"
    tree = (DecisionTreeRegressor if values else DecisionTreeClassifier)(labelCol=label, maxDepth=1)
    few = compact(signs.select(label, *NAMES), tree, label)
    assert few.count() < 20_000
    found = {r.node: r for r in tree_nodes(spark, _fitted(tree, few), NAMES).collect()}
    assert found[0].n == 20_000 and found[1].n + found[2].n == 20_000 and min(found[1].n, found[2].n) > 0
