"""Gradient-boosted trees."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame

from millrace.functions import Keys
from millrace.plans.models import SEED, Fitted, fit, fit_mixed
from millrace.plans.tuning import Tuned, holdout, k_folds, param_grid, tune_classifier

# Settings the results have to match. Boosting in current Spark
# knows the variance impurity only, so the grid has no impurity axis.
BOOST = {"maxDepth": 20, "maxBins": 20, "maxIter": 10}
VALUE_BOOST = {"maxDepth": 20, "maxBins": 328, "maxIter": 10}
HOLDOUT_GRID = {"maxIter": [10, 20], "maxBins": [10, 20], "maxDepth": [10, 20]}
FOLD_GRID = {"maxIter": [5, 10, 20], "maxBins": [5, 10], "maxDepth": [10, 20]}
FOLDS = 3

_DEEP = {"cacheNodeIds": True}


def gbt_classifier(
    train: DataFrame, test: DataFrame, label: str, features: Sequence[str] | None = None, **params
) -> Fitted:
    """Two classes, 0 and 1; for more see one_vs_rest."""
    settings = {**BOOST, **_DEEP, **params}
    boost = GBTClassifier(labelCol=label, featuresCol="features", seed=SEED, **settings)
    return fit(boost, train, test, label, features)


def gbt_regressor(train: DataFrame, test: DataFrame, label: str, drop: Sequence[str] = (), **params) -> Fitted:
    """Boosted regression on the indexed features of a mixed table."""
    settings = {**VALUE_BOOST, **_DEEP, **params}
    boost = GBTRegressor(labelCol=label, featuresCol="indexedFeatures", seed=SEED, **settings)
    return fit_mixed(boost, train, test, label, drop)


def tuned_gbt_holdout(
    train: DataFrame,
    test: DataFrame,
    label: str,
    keys: Keys | Sequence[str],
    features: Sequence[str] | None = None,
    grid: Mapping[str, Sequence] = HOLDOUT_GRID,
    parallelism: int = 4,
) -> tuple[Fitted, Tuned]:
    """Best of a grid by f1 on a held-out fifth of the training part."""
    base = GBTClassifier(labelCol=label, featuresCol="features", seed=SEED, **_DEEP)
    return tune_classifier(
        base, param_grid(base, **grid), train, test, label, keys, features, 10, holdout(8), "f1", parallelism
    )


def tuned_gbt_folds(
    train: DataFrame,
    test: DataFrame,
    label: str,
    keys: Keys | Sequence[str],
    features: Sequence[str] | None = None,
    grid: Mapping[str, Sequence] = FOLD_GRID,
    folds: int = FOLDS,
    parallelism: int = 4,
) -> tuple[Fitted, Tuned]:
    """Best of a grid by mean f1 over the folds."""
    base = GBTClassifier(labelCol=label, featuresCol="features", seed=SEED, **_DEEP)
    return tune_classifier(
        base, param_grid(base, **grid), train, test, label, keys, features, folds, k_folds(folds), "f1",
        parallelism,
    )
