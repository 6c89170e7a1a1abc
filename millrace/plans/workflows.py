"""The three table-to-report runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from millrace.operators.encode import feature_columns
from millrace.operators.split import hash_split
from millrace.plans.boosting import gbt_regressor
from millrace.plans.clustering import ANOMALY_K, ANOMALY_TOP, TIGHT, Clusters, cluster
from millrace.plans.features import fit_connection_features
from millrace.plans.models import Fitted
from millrace.plans.regression import one_vs_rest
from millrace.plans.trees import random_forest_regressor
from millrace.session import held
from millrace.sources.loaders import index_target

# String columns of the connection records.
CONNECTION_TEXTS = ["protocol_type", "service", "flag"]


def classify_targets(df: DataFrame, target: str = "target", key: str = "id", **params) -> Fitted:
    """Index the target, split 9 to 1, one logistic model per class."""
    indexed = index_target(df, target)
    train, test = hash_split(indexed, [key])
    return one_vs_rest(train.drop(key), test.drop(key), f"{target}_index", **params)


def detect_anomalies(
    df: DataFrame,
    label: str = "label",
    texts: Sequence[str] = CONNECTION_TEXTS,
    drop: Sequence[str] = (),
    k: int = ANOMALY_K,
    top: int = ANOMALY_TOP,
    **params,
) -> tuple[Clusters, DataFrame]:
    """Cluster mixed records; the rows farthest from their centers are the anomalies."""
    inputs = [label, *feature_columns(df, label, drop)]
    with held(df.select(*inputs)) as rows:
        features = fit_connection_features(rows, label, texts)
        found = cluster(rows, features, k, "scaledFeatures", **{**TIGHT, **params})
    return found, found.anomalies(df, top)


def predict_values(df: DataFrame, label: str = "SalePrice", key: str = "Id", boosted: bool = False, **params) -> Fitted:
    """Split 9 to 1, index the training part's categories, regression forest or boosted trees."""
    train, test = hash_split(df, [key])
    model = gbt_regressor if boosted else random_forest_regressor
    return model(train, test, label, drop=[key], **params)
