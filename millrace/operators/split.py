"""Train/test parts and cross-validation folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.functions import Keys, hash_bucket


def with_part(df: DataFrame, keys: Keys | Sequence[str], train_tenths: int = 9, name: str = "part") -> DataFrame:
    """Mark each row "train" or "test" by the hash of its key columns."""
    train = hash_bucket(keys, 10) < train_tenths
    return df.withColumn(name, F.when(train, "train").otherwise("test"))


def hash_split(df: DataFrame, keys: Keys | Sequence[str], train_tenths: int = 9) -> tuple[DataFrame, DataFrame]:
    """Two parts that are the same rows on every run and in every engine.

    Give a unique id as the key: copies of one key stay on one side.
    """
    bucket = hash_bucket(keys, 10)
    return df.where(bucket < train_tenths), df.where(bucket >= train_tenths)


def random_split(df: DataFrame, weights: Sequence[float] = (0.9, 0.1), seed: int = 17) -> list[DataFrame]:
    """Seeded random parts; repeatable only while the input partitions stay the same."""
    return df.randomSplit(list(weights), seed)


def with_fold(df: DataFrame, keys: Keys | Sequence[str], folds: int, name: str = "fold") -> DataFrame:
    return df.withColumn(name, hash_bucket(keys, folds))
