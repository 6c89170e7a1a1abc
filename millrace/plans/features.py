"""Fitted feature stages for the kinds of table the models take."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from millrace.operators.encode import (
    assembler,
    feature_columns,
    fit_indexer,
    fit_one_hot,
    scaler,
    string_columns,
    vector_indexer,
)


def mixed_feature_names(df: DataFrame, label: str, drop: Sequence[str] = ()) -> list[str]:
    """The slots of a mixed table's vector: plain columns, then indexed strings."""
    texts = string_columns(df)
    names = feature_columns(df, label, drop)
    return [c for c in names if c not in texts] + [f"{c}_index" for c in names if c in texts]


def fit_mixed_features(
    df: DataFrame,
    label: str,
    drop: Sequence[str] = (),
    max_categories: int = 20,
    invalid: str = "keep",
) -> PipelineModel:
    """Index the strings, assemble, recode slots with few values.

    Fit it on the training rows; "keep" gives categories unseen there a code of
    their own at scoring, "skip" drops such rows.
    """
    texts = [c for c in string_columns(df) if c != label and c not in drop]
    stages = [fit_indexer(df, texts, "_index", invalid)] if texts else []
    stages.append(assembler(mixed_feature_names(df, label, drop), "features"))
    assembled = PipelineModel(stages)
    recode = vector_indexer("features", "indexedFeatures", max_categories, invalid)
    return PipelineModel([assembled, recode.fit(assembled.transform(df).select("features"))])


def numeric_features(df: DataFrame, label: str, drop: Sequence[str] = (), output: str = "features") -> PipelineModel:
    return PipelineModel([assembler(feature_columns(df, label, drop), output)])


def fit_scaled_features(
    df: DataFrame, label: str, drop: Sequence[str] = (), output: str = "scaledFeatures"
) -> PipelineModel:
    """Numbers, assembled and scaled."""
    numbers = numeric_features(df, label, drop)
    return PipelineModel([numbers, scaler("features", output).fit(numbers.transform(df))])


def fit_connection_features(
    df: DataFrame, label: str, texts: Sequence[str], drop: Sequence[str] = (), output: str = "scaledFeatures"
) -> PipelineModel:
    """Numbers and one-hot strings, assembled and scaled, in schema order."""
    one_hot = fit_one_hot(df, texts)
    numbers = feature_columns(df, label, [*drop, *texts])
    assembled = PipelineModel([one_hot, assembler([*numbers, *[f"{c}_vec" for c in texts]], "features")])
    return PipelineModel([assembled, scaler("features", output).fit(assembled.transform(df))])
