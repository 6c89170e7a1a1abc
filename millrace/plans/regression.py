"""Logistic, linear and one-vs-rest regression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import LogisticRegression, OneVsRest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame

from millrace.functions import Keys
from millrace.plans.models import Fitted, fit, fit_mixed
from millrace.plans.tuning import Tuned, holdout, k_folds, param_grid, tune_classifier
from millrace.sources.models import load_model, save_model

# Settings the results have to match.
LOGISTIC = {"maxIter": 10, "regParam": 0.1, "elasticNetParam": 0.5}
LINEAR = {"maxIter": 10, "regParam": 0.1, "elasticNetParam": 0.5}
SAVED_LOGISTIC = {"maxIter": 20, "regParam": 0.01, "elasticNetParam": 0.5}
REST_LOGISTIC = {"maxIter": 20, "regParam": 0.1, "elasticNetParam": 0.5, "fitIntercept": True}
LOGISTIC_GRID = {
    "maxIter": [10, 20],
    "regParam": [0.01, 0.1],
    "elasticNetParam": [0.05, 0.5],
    "fitIntercept": [True, False],
}
FOLDS = 5


def logistic_regression(
    train: DataFrame, test: DataFrame, label: str, features: Sequence[str] | None = None, **params
) -> Fitted:
    regression = LogisticRegression(labelCol=label, featuresCol="features", **{**LOGISTIC, **params})
    return fit(regression, train, test, label, features)


def logistic_regression_saved(
    train: DataFrame, test: DataFrame, label: str, path: str, features: Sequence[str] | None = None, **params
) -> Fitted:
    """Fit, then keep the whole pipeline under `path`."""
    fitted = logistic_regression(train, test, label, features, **{**SAVED_LOGISTIC, **params})
    save_model(fitted.model, path)
    return fitted


def score_saved(path: str, rows: DataFrame) -> DataFrame:
    """Predictions of a kept pipeline for new rows."""
    return load_model(path).transform(rows)


def linear_regression(
    train: DataFrame, test: DataFrame, label: str, drop: Sequence[str] = (), **params
) -> Fitted:
    """Linear regression on the indexed features of a mixed table."""
    regression = LinearRegression(labelCol=label, featuresCol="indexedFeatures", **{**LINEAR, **params})
    return fit_mixed(regression, train, test, label, drop)


def one_vs_rest(
    train: DataFrame,
    test: DataFrame,
    label: str,
    features: Sequence[str] | None = None,
    parallelism: int = 4,
    **params,
) -> Fitted:
    """One logistic model per class, several fitted at a time."""
    one = LogisticRegression(labelCol=label, featuresCol="features", **{**REST_LOGISTIC, **params})
    rest = OneVsRest(classifier=one, labelCol=label, featuresCol="features", parallelism=parallelism)
    return fit(rest, train, test, label, features)


def tuned_logistic_holdout(
    train: DataFrame,
    test: DataFrame,
    label: str,
    keys: Keys | Sequence[str],
    features: Sequence[str] | None = None,
    grid: Mapping[str, Sequence] = LOGISTIC_GRID,
    parallelism: int = 4,
) -> tuple[Fitted, Tuned]:
    """Best of a grid by f1 on a held-out fifth of the training part."""
    base = LogisticRegression(labelCol=label, featuresCol="features")
    return tune_classifier(
        base, param_grid(base, **grid), train, test, label, keys, features, 10, holdout(8), "f1", parallelism
    )


def tuned_logistic_folds(
    train: DataFrame,
    test: DataFrame,
    label: str,
    keys: Keys | Sequence[str],
    features: Sequence[str] | None = None,
    grid: Mapping[str, Sequence] = LOGISTIC_GRID,
    folds: int = FOLDS,
    parallelism: int = 4,
) -> tuple[Fitted, Tuned]:
    """Best of a grid by mean f1 over the folds."""
    base = LogisticRegression(labelCol=label, featuresCol="features")
    return tune_classifier(
        base, param_grid(base, **grid), train, test, label, keys, features, folds, k_folds(folds), "f1",
        parallelism,
    )
