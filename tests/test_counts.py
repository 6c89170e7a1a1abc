import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from millrace.operators import counts, evaluate


def test_frequency_table_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(k,) for k in "bbaac"], "k string")
    assert [tuple(r) for r in counts.frequency_table(df, "k", 2).collect()] == [("a", 2), ("b", 2)]


def test_priors_sum_to_one(mixed_net):
    rows = counts.class_priors(mixed_net, "label").collect()
    assert math.isclose(sum(r.prior for r in rows), 1.0)


def test_chance_accuracy_with_a_class_missing_from_test(spark):
    train = spark.createDataFrame([(c,) for c in "aabc"], "label string")
    test = spark.createDataFrame([(c,) for c in "acc"], "label string")
    # by hand: a 0.5 * 1/3, c 0.25 * 2/3; b meets nothing
    got = counts.chance_accuracy_of(train, test, "label").first().accuracy
    assert got == pytest.approx(0.5 / 3 + 0.25 * 2 / 3)


def test_confusion_matrices_count_every_row(spark):
    rows = [(1, 1)] * 5 + [(1, 2)] * 2 + [(2, 2)] * 4 + [(3, 4)]
    df = spark.createDataFrame(rows, "y int, p int")
    given = counts.confusion_matrix(df, "y", "p", [1, 2, 3, 4]).collect()
    assert [tuple(r) for r in given] == [(1, 5, 2, 0, 0), (2, 0, 4, 0, 0), (3, 0, 0, 0, 1)]
    found = counts.confusion_matrix_all_labels(df, "y", "p").collect()
    # a class that is only predicted still has a row
    assert [tuple(r) for r in found] == [(1, 5, 2, 0, 0), (2, 0, 4, 0, 0), (3, 0, 0, 0, 1), (4, 0, 0, 0, 0)]


def test_entropy_by_hand(spark):
    df = spark.createDataFrame([("g", "a")] * 3 + [("g", "b")] + [("h", "a")] * 4, "grp string, label string")
    got = {r.group: r.entropy for r in counts.label_entropy(df, "grp", "label").collect()}
    g = -(0.75 * math.log(0.75) + 0.25 * math.log(0.25))
    assert got["g"] == pytest.approx(g)
    assert got["h"] == pytest.approx(0.0, abs=1e-12)
    assert counts.weighted_entropy(df, "grp", "label").first().entropy == pytest.approx(g / 2)


def _predictions(spark):
    df = spark.range(500).select(
        (F.col("id") % 5).cast("double").alias("y"),
        F.when(F.col("id") % 3 == 0, (F.col("id") + 1) % 4).otherwise(F.col("id") % 5).cast("double").alias("prediction"),
    )
    return df


def test_class_metrics_equal_the_evaluator(spark):
    df = _predictions(spark)
    got = {r.metric: r.value for r in evaluate.class_metrics(df, "y").collect()}
    for metric in evaluate.CLASS_METRICS:
        judge = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction", metricName=metric)
        assert got[metric] == pytest.approx(judge.evaluate(df), abs=1e-9)


def test_value_metrics_equal_the_evaluator(spark):
    df = _predictions(spark)
    got = {r.metric: r.value for r in evaluate.value_metrics(df, "y").collect()}
    for metric in evaluate.VALUE_METRICS:
        judge = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName=metric)
        assert got[metric] == pytest.approx(judge.evaluate(df), abs=1e-9)
    assert got["mse"] == pytest.approx(got["rmse"] ** 2)


def test_missing_predictions_have_a_column(spark):
    rows = [("a", "a"), ("a", None), ("b", "a"), ("b", None), ("b", None)]
    df = spark.createDataFrame(rows, "label string, prediction string")
    got = [tuple(r) for r in counts.confusion_matrix_all_labels(df, "label", "prediction").collect()]
    assert got == [("a", 1, 0, 1), ("b", 1, 0, 2)]
    full = counts.confusion_matrix_all_labels(df.na.drop(), "label", "prediction")
    assert full.columns == ["label", "pred_a", "pred_b"]
