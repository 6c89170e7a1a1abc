"""Column expressions over feature vectors and arrays of doubles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F


def as_doubles(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("array<double>")


def squared_distance(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance of two arrays of equal length."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)


def one_hot_position(columns: Sequence[str]) -> Column:
    """Position of the first 1 among 0/1 columns as a double, -1 if there is none."""
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return (F.array_position(values, F.lit(1.0)) - 1).cast("double")


def vector_slots(vector: str, size: int, prefix: str) -> list[Column]:
    """The slots of an ML vector as plain double columns prefix0..prefixN."""
    values = vector_to_array(F.col(vector))
    return [values[i].alias(f"{prefix}{i}") for i in range(size)]
