"""Fit on one part, predict the other, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, functions as F

from millrace.operators import evaluate, inspect
from millrace.operators.counts import confusion_matrix_all_labels
from millrace.operators.encode import assembler, feature_columns
from millrace.plans.compact import WEIGHT, compact, weighted
from millrace.plans.features import fit_mixed_features, mixed_feature_names
from millrace.plans.forests import fit_forest, is_sampled
from millrace.session import held, shared_dir

SEED = 17


@dataclass(frozen=True)
class Fitted:
    """A fitted pipeline, its predictions on the test part and the reports on both."""

    model: PipelineModel
    train: DataFrame
    test: DataFrame
    label: str
    features: list[str]

    @property
    def predictions(self) -> DataFrame:
        return self.model.transform(self.test)

    def class_metrics(self) -> DataFrame:
        return evaluate.class_metrics(self.predictions, self.label)

    def scored(self) -> DataFrame:
        """Label, prediction and, from a model that has them, class probabilities of the test part."""
        found = self.predictions
        return found.select(self.label, *[c for c in ("prediction", "probability") if c in found.columns])

    def confusion(self) -> DataFrame:
        """The confusion matrix of the test part, over all classes seen."""
        return confusion_matrix_all_labels(self.predictions, self.label, "prediction")

    def value_metrics(self) -> DataFrame:
        return evaluate.value_metrics(self.predictions, self.label)

    def train_test_accuracy(self) -> DataFrame:
        return evaluate.train_test_accuracy(self.model, self.train, self.test, self.label)

    def importances(self) -> DataFrame:
        return inspect.feature_importances(self.test.sparkSession, self.model, self.features)

    def coefficients(self) -> DataFrame:
        return inspect.coefficients(self.test.sparkSession, self.model, self.features)

    def nodes(self) -> DataFrame:
        """The nodes of the fitted tree or trees."""
        return inspect.tree_nodes(self.test.sparkSession, self.model, self.features)

    def params(self) -> DataFrame:
        return inspect.model_params(self.test.sparkSession, self.model)


def labelled(df: DataFrame, label: str) -> DataFrame:
    """The label as the double Spark's estimators want."""
    return df.withColumn(label, F.col(label).cast("double"))


def fit(
    estimator: Estimator,
    train: DataFrame,
    test: DataFrame,
    label: str,
    features: Sequence[str] | None = None,
    vector: str = "features",
) -> Fitted:
    """Assemble the columns, fit on the training part.

    The estimator gets the vector and the label only, so a columnar scan reads
    no other columns. These two are held for the fit: an estimator goes over
    its input several times before it has its own binned or blocked copy. Few
    different rows are fitted as weighted ones where that is the same.
    """
    shared_dir(train.sparkSession)  # deep trees and boosting cut their lineage there
    names = list(features or feature_columns(train, label))
    stage = assembler(names, vector)
    few = compact(labelled(train, label).select(label, *names), estimator, label)
    rows = stage.transform(few).select(label, vector, *[c for c in few.columns if c == WEIGHT])
    with held(rows) as cached:
        fitted = fit_forest(estimator, cached) if is_sampled(estimator) else weighted(estimator, rows).fit(cached)
        model = PipelineModel([stage, fitted])
    return Fitted(model, labelled(train, label), labelled(test, label), label, names)


def fit_mixed(
    estimator: Estimator, train: DataFrame, test: DataFrame, label: str, drop: Sequence[str] = ()
) -> Fitted:
    """Fit on the indexed features of a mixed table.

    The training columns are held over the passes that fit the feature stages
    and the one that fits the model.
    """
    names = feature_columns(train, label, drop)
    with held(labelled(train, label).select(label, *names)) as rows:
        stages = fit_mixed_features(rows, label)
        few = compact(rows, estimator, label)
        vectors = stages.transform(few).select(label, "indexedFeatures", *[c for c in few.columns if c == WEIGHT])
        if is_sampled(estimator):
            with held(vectors) as cached:
                fitted = fit_forest(estimator, cached)
        else:
            fitted = weighted(estimator, vectors).fit(vectors)
        model = PipelineModel([stages, fitted])
    slots = mixed_feature_names(train, label, drop)
    return Fitted(model, labelled(train, label), labelled(test, label), label, slots)
