import pytest
from pyspark.sql import functions as F

from millrace.functions import Keys
from millrace.operators import inspect
from millrace.operators.split import hash_split, random_split
from millrace.plans import boosting, regression, trees
from millrace.plans.features import fit_mixed_features
from millrace.plans.workflows import classify_targets, predict_values
from millrace.sources import rows_like

NAMES = ["Pregnancies", "Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI",
         "DiabetesPedigreeFunction", "Age"]


@pytest.fixture(scope="module")
def parts(binary_numeric):
    train, test = hash_split(binary_numeric, ["id"], 8)
    return train.persist(), test.persist()


def _metrics(df):
    return {r.metric: r.value for r in df.collect()}


def test_tree_finds_the_threshold(parts, spark):
    fitted = trees.decision_tree(*parts, "Outcome", NAMES)
    assert _metrics(fitted.class_metrics())["accuracy"] == 1.0
    assert fitted.importances().first().feature == "Glucose"
    text = inspect.tree_text(spark, fitted.model).collect()
    assert "feature 1 <=" in text[0].text and "uid" not in text[0].text
    sides = {r.part: r.accuracy for r in fitted.train_test_accuracy().collect()}
    assert sides == {"train": 1.0, "test": 1.0}


def test_tree_grid_prefers_the_best_score(parts):
    grid = {"impurity": ["gini", "entropy"], "maxDepth": [0, 3], "minInfoGain": [0.0]}
    fitted, tuned = trees.tuned_decision_tree(*parts, "Outcome", Keys(("id",)), NAMES, grid)
    assert len(tuned.scores) == 4 and tuned.scores[tuned.best] == max(tuned.scores) == 1.0
    assert _metrics(fitted.class_metrics())["accuracy"] == 1.0
    report = inspect.grid_report(parts[0].sparkSession, tuned.scores, tuned.grid).collect()
    assert [r.metric for r in report] == sorted(tuned.scores, reverse=True)


def test_categorical_tree_reads_one_hot_groups(spark):
    rows = [(i, float(i % 7), *[int(i % 4 == j) if i else 0 for j in range(4)], float((i % 4) // 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x double, w0 int, w1 int, w2 int, w3 int, y double")
    train, test = hash_split(df, ["id"], 8)
    fitted, _ = trees.tuned_categorical_tree(
        train, test, "y", ["id"], {"w": ["w0", "w1", "w2", "w3"]},
        grid={"maxDepth": [2], "impurity": ["gini"]},
    )
    assert _metrics(fitted.class_metrics())["accuracy"] > 0.97
    assert fitted.importances().first().feature == "w"


def test_forest_importances_sum_to_one(parts):
    fitted = trees.random_forest_classifier(*parts, "Outcome", NAMES, numTrees=10, maxDepth=5)
    rows = fitted.importances().collect()
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert rows[0].feature == "Glucose" and [r["rank"] for r in rows] == list(range(1, 9))
    assert {r.param: r.value for r in fitted.params().collect()}["impurity"] == "entropy"


def test_boosting_learns_the_threshold(parts):
    fitted = boosting.gbt_classifier(*parts, "Outcome", NAMES, maxDepth=3, maxIter=3)
    assert _metrics(fitted.class_metrics())["f1"] > 0.95
    for tune in (boosting.tuned_gbt_holdout, boosting.tuned_gbt_folds):
        fitted, tuned = tune(*parts, "Outcome", ["id"], NAMES, grid={"maxIter": [1, 2], "maxDepth": [2]})
        assert tuned.scores[tuned.best] == max(tuned.scores)
        assert _metrics(fitted.class_metrics())["f1"] > 0.9


def test_mixed_regression_models(mixed_house):
    train, test = hash_split(mixed_house, ["Id"], 8)
    forest = trees.random_forest_regressor(train, test, "SalePrice", ["Id"], numTrees=20, maxDepth=8)
    assert _metrics(forest.value_metrics())["r2"] > 0.9
    assert {r.feature for r in forest.importances().limit(2).collect()} == {"Zone_index", "Quality"}
    boost = boosting.gbt_regressor(train, test, "SalePrice", ["Id"], maxDepth=4, maxIter=5)
    assert _metrics(boost.value_metrics())["r2"] > 0.9


def test_mixed_features_keep_unseen_categories(spark, mixed_house):
    stages = fit_mixed_features(mixed_house, "SalePrice", ["Id"])
    odd = mixed_house.limit(1).withColumn("Zone", F.lit("moon")).withColumn("Garage", F.lit(99))
    row = stages.transform(odd).first()
    # numbers first (Quality, Area, Year, Garage), then the strings
    assert row.features[4] == 3.0 and row.indexedFeatures[3] == 4.0
    assert row.features.size == 7


def test_linear_regression_recovers_the_line(linear_target):
    train, test = hash_split(linear_target, ["id"])
    fitted = regression.linear_regression(train, test, "y", ["id"], regParam=0.0)
    got = {r.feature: r.coefficient for r in fitted.coefficients().collect()}
    assert got["a"] == pytest.approx(3, abs=0.02) and got["b"] == pytest.approx(-2, abs=0.02)
    assert got["intercept"] == pytest.approx(5, abs=0.05)
    assert _metrics(fitted.value_metrics())["r2"] > 0.99


def test_unpenalised_logistic_balances_its_residuals(parts):
    train, test = parts
    noisy = train.withColumn("y", F.when(F.col("id") % 5 == 0, 1 - F.col("Outcome")).otherwise(F.col("Outcome")))
    fitted = regression.logistic_regression(noisy, noisy, "y", ["Glucose", "Age"], regParam=0.0, maxIter=200, tol=1e-10)
    from pyspark.ml.functions import vector_to_array

    off = fitted.predictions.agg(F.sum(vector_to_array("probability")[1] - F.col("y"))).first()[0]
    assert off == pytest.approx(0.0, abs=1e-3)


def test_saved_model_scores_the_same(parts, spark, tmp_path):
    train, test = parts
    path = str(tmp_path / "model")
    fitted = regression.logistic_regression_saved(train, test, "Outcome", path, NAMES)
    before = {r.id: r.prediction for r in fitted.predictions.collect()}
    after = {r.id: r.prediction for r in regression.score_saved(path, test).collect()}
    assert before == after
    # a new row with the types of the training table
    one = rows_like(spark, [(3, 150, 65, 27, 0, 32.0, 0.4, 50)], train, NAMES)
    assert regression.score_saved(path, one).first().prediction == 1.0


def test_logistic_grids_report_every_point(parts):
    grid = {"maxIter": [10], "regParam": [0.01, 0.1], "elasticNetParam": [0.05], "fitIntercept": [True, False]}
    for tune in (regression.tuned_logistic_holdout, regression.tuned_logistic_folds):
        fitted, tuned = tune(*parts, "Outcome", ["id"], NAMES, grid=grid)
        assert len(tuned.grid) == 4 and tuned.scores[tuned.best] == max(tuned.scores)
        assert _metrics(fitted.class_metrics())["accuracy"] > 0.85


def test_default_grids_have_the_stated_sizes():
    def size(grid):
        n = 1
        for values in grid.values():
            n *= len(values)
        return n

    assert size(trees.TREE_GRID) == 16 and size(regression.LOGISTIC_GRID) == 16
    assert size(boosting.HOLDOUT_GRID) == 8 and size(boosting.FOLD_GRID) == 12


def test_one_vs_rest_has_a_model_per_class(multi_class):
    fitted = classify_targets(multi_class, maxIter=10)
    assert len(fitted.model.stages[-1].models) == 4
    assert _metrics(fitted.class_metrics())["accuracy"] > 0.95
    assert fitted.features == [f"f{j}" for j in range(6)]


def test_multinomial_coefficients_have_a_set_per_class(multi_class, spark):
    df = multi_class.withColumn("y", F.substring("target", 7, 1).cast("double") - 1).drop("target", "id")
    fitted = regression.logistic_regression(df, df, "y")
    assert fitted.coefficients().count() == 4 * 7


def test_predict_values_workflow(mixed_house):
    fitted = predict_values(mixed_house, numTrees=5, maxDepth=6)
    assert _metrics(fitted.value_metrics())["r2"] > 0.8


def test_predict_values_with_boosted_trees(mixed_house):
    fitted = predict_values(mixed_house, boosted=True, maxIter=3, maxDepth=6)
    assert type(inspect.last_stage(fitted.model)).__name__ == "GBTRegressionModel"
    assert _metrics(fitted.value_metrics())["r2"] > 0.8


def test_splits(spark):
    df = spark.range(5000)
    for keys in (["id"], Keys(("id",), portable=True)):
        train, test = hash_split(df, keys)
        assert train.count() + test.count() == 5000
        assert train.intersect(test).count() == 0
        assert 4300 < train.count() < 4700
        # another layout of the same rows gives the same parts
        again, _ = hash_split(df.repartition(3), keys)
        assert again.exceptAll(train).count() == 0
    a, b = random_split(df)
    assert a.count() + b.count() == 5000


def _walk(nodes, row, names):
    """The prediction of a tree given as rows, by walking it."""
    at = nodes[0]
    while at.left is not None:
        x = row[at.feature]
        goes_left = x <= at.threshold if at.threshold is not None else x in at.categories
        at = nodes[at.left if goes_left else at.right]
    return at.prediction


def test_a_tree_as_rows_predicts_as_the_model(parts):
    fitted = trees.decision_tree(*parts, "Outcome", NAMES)
    nodes = {r.node: r for r in fitted.nodes().collect()}
    assert sorted(nodes) == list(range(len(nodes))) and nodes[0].n == parts[0].count()
    for r in nodes.values():
        if r.left is None:
            assert (r.feature, r.threshold, r.categories, r.right, r.gain) == (None,) * 5
        else:
            assert r.feature in NAMES and r.n == nodes[r.left].n + nodes[r.right].n and r.gain > 0
    rows = fitted.predictions.collect()
    assert all(_walk(nodes, r, NAMES) == r.prediction for r in rows)


def test_nodes_of_forests_and_of_categories(parts, mixed_house):
    forest = trees.random_forest_classifier(*parts, "Outcome", NAMES, numTrees=3, maxDepth=3)
    assert {r.tree for r in forest.nodes().select("tree").distinct().collect()} == {0, 1, 2}
    train, test = hash_split(mixed_house, ["Id"], 8)
    values = trees.random_forest_regressor(train, test, "SalePrice", drop=["Id"], numTrees=1, maxDepth=4)
    splits = values.nodes().where("left IS NOT NULL")
    assert splits.where("(threshold IS NULL) = (categories IS NULL)").isEmpty() and not splits.isEmpty()


def test_scored_rows_without_probabilities(linear_target):
    fitted = regression.linear_regression(linear_target, linear_target, "y", drop=["id"])
    assert fitted.scored().columns == ["y", "prediction"]
