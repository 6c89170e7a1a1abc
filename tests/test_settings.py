"""Catalog queries run with the settings that the plans hold."""

import glob

import pytest

from millrace.catalog import QUERIES, clusters
from millrace.plans import boosting, regression, trees

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="test tables are not here")


class Called(Exception):
    pass


@pytest.mark.parametrize(
    "name, module, plan, given",
    [
        ("decision_tree_tuned", trees, "tuned_decision_tree", 4),
        ("decision_tree_categorical", trees, "tuned_categorical_tree", 5),
        ("random_forest_classifier", trees, "random_forest_classifier", 3),
        ("random_forest_regressor", trees, "random_forest_regressor", 3),
        ("feature_importances", trees, "random_forest_regressor", 3),
        ("gbt_tuned_tvs", boosting, "tuned_gbt_holdout", 4),
        ("gbt_tuned_cv", boosting, "tuned_gbt_folds", 4),
        ("logistic_tuned_tvs", regression, "tuned_logistic_holdout", 4),
        ("logistic_tuned_cv", regression, "tuned_logistic_folds", 4),
        ("one_vs_rest", regression, "one_vs_rest", 4),
        ("kmeans_cost_default", clusters, "cost_sweep", 2),
        ("kmeans_cost_tight", clusters, "cost_sweep", 2),
        ("kmeans_cost_scaled", clusters, "cost_sweep", 2),
        ("kmeans_cost_onehot", clusters, "cost_sweep", 2),
        ("kmeans_k_sweep", clusters, "cost_sweep", 2),
        ("kmeans_entropy_sweep", clusters, "entropy_sweep", 3),
        ("anomalies", clusters, "detect_anomalies", 3),
    ],
)
def test_settings_are_those_of_the_plans(spark, monkeypatch, name, module, plan, given):
    def stop(*args, **params):
        raise Called(args, params)

    monkeypatch.setattr(module, plan, stop)
    with pytest.raises(Called) as called:
        QUERIES[name](spark, SF)
    args, params = called.value.args
    assert len(args) == given and not {"grid", "numTrees", "maxDepth", "maxBins", "k", "ks"} & set(params)
    # the tight limits of the k-means runs are the plans' own
    assert params.get("maxIter") in (None, clusters.TIGHT["maxIter"])
