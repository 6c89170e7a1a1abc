"""Categories to numbers: frequency index, one-hot, assembly, scaling, recoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, NumericType, StringType

from millrace.functions import one_hot_position
from millrace.operators.rank import total_before
from millrace.session import BROADCAST_BYTES, held

# Categories, of all columns of a fit together, that may travel through the driver into a model.
MAX_MODEL_LABELS = 100_000

# Most frequent categories that are looked up by broadcast when a column has more than that.
HEAD_ROWS = 100_000


class TooManyCategories(ValueError):
    """A column has more categories than a model on the driver should hold."""


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def integer_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, IntegerType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def drop_nonnumeric(df: DataFrame) -> DataFrame:
    return df.select(numeric_columns(df))


def feature_columns(df: DataFrame, label: str, drop: Sequence[str] = ()) -> list[str]:
    """Every column but the label and the dropped ones, in schema order."""
    return [c for c in df.columns if c != label and c not in drop]


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for all the columns from one pass; nulls are not counted."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], list(columns), "column", "value")
        .where("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def _sizes(counts: DataFrame) -> dict[str, tuple[int, int]]:
    """Categories and their total bytes, per column."""
    held_by = counts.groupBy("column").agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("value")).alias("bytes")
    )
    return {row["column"]: (row["rows"], row["bytes"]) for row in held_by.collect()}


def _few(sizes: Mapping[str, tuple[int, int]], columns: Sequence[str], max_labels: int) -> list[str]:
    """Columns whose categories, all taken together, may travel through the driver; smaller ones first."""
    few, labels, size = [], 0, 0
    for c in sorted(columns, key=lambda c: sizes.get(c, (0, 0))):
        n, held_bytes = sizes.get(c, (0, 0))
        labels, size = labels + n, size + held_bytes
        if labels > max_labels or size > BROADCAST_BYTES:
            break
        few.append(c)
    return [c for c in columns if c in few]


def _indexer(counts: DataFrame, columns: Sequence[str], suffix: str, invalid: str) -> PipelineModel:
    """Indexer models for columns whose categories are known to be few.

    One model per column: from_arrays_of_labels pads shorter lists with null
    labels when the columns differ in their number of categories.
    """
    few = counts.where(F.col("column").isin(list(columns)))
    labels: dict[str, list[str]] = {c: [] for c in columns}
    for row in few.orderBy("column", F.desc("n"), "value").collect():
        labels[row["column"]].append(row["value"])
    return PipelineModel(
        [StringIndexerModel.from_labels(labels[c], c, c + suffix, invalid) for c in columns]
    )


def fit_indexer(
    df: DataFrame,
    columns: Sequence[str],
    suffix: str = "_index",
    invalid: str = "error",
    max_labels: int = MAX_MODEL_LABELS,
) -> PipelineModel:
    """Index categories by descending frequency, ties in text order.

    Same codes as Spark's own StringIndexer, but the number of categories is
    checked before any of them reaches the driver.
    """
    with held(category_counts(df, columns)) as counts:
        sizes = _sizes(counts)
        few = _few(sizes, columns, max_labels)
        wide = {c: sizes[c] for c in columns if c not in few}
        if wide:
            raise TooManyCategories(f"too many categories for a model: {wide}; index_table has no such limit")
        return _indexer(counts, columns, suffix, invalid)


def index_table(
    df: DataFrame,
    columns: Sequence[str],
    suffix: str = "_index",
    invalid: str = "skip",
    max_labels: int = MAX_MODEL_LABELS,
) -> DataFrame:
    """Add the frequency index of each column, whatever the number of categories.

    Columns with few categories share one indexer model. A wider column is
    ranked and looked up on the executors, see `_index_wide`.
    """
    with held(category_counts(df, columns)) as counts:
        sizes = _sizes(counts)
        few = _few(sizes, columns, max_labels)
        wide = [c for c in columns if c not in few]
        out = _indexer(counts, few, suffix, invalid).transform(df) if few else df
        for c in wide:
            out = _index_wide(out, c, _ranked(counts, c), sizes[c][0], c + suffix, invalid)
    order = df.columns + [c + suffix for c in columns]
    return out.select(*[f"`{c}`" for c in order])


def _ranked(counts: DataFrame, column: str) -> DataFrame:
    one = counts.where(F.col("column") == column).select("value", "n", F.lit(1).alias("one"))
    return total_before(one, "one", F.desc("n"), F.asc("value"), name="rank").select("value", "rank")


def _free(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column has it."""
    while name in df.columns:
        name = "_" + name
    return name


def _index_wide(
    df: DataFrame, column: str, ranked: DataFrame, size: int, out: str, invalid: str
) -> DataFrame:
    """Look up a rank that is too large to broadcast whole, in one pass over the rows.

    The rank is by frequency, so its first rows are exactly the hot keys. They
    are broadcast, as many as surely fit the size limit. The others are joined
    by shuffle. Rows that need no second lookup take part in it under a salt
    that matches nothing, so that hot keys and nulls do not meet in one task.
    """
    longest = ranked.agg(F.max(F.octet_length("value"))).first()[0]
    head = max(1, min(HEAD_ROWS, BROADCAST_BYTES // (longest + 64)))
    key, hot_key, hot, cold_key, cold, salt, zero = (
        _free(df, f"_code_{x}") for x in ("key", "hot_key", "hot", "cold_key", "cold", "salt", "zero")
    )
    hot_rows = ranked.where(F.col("rank") < head).select(F.col("value").alias(hot_key), F.col("rank").alias(hot))
    cold_rows = ranked.where(F.col("rank") >= head).select(
        F.col("value").alias(cold_key), F.col("rank").alias(cold), F.lit(0).alias(zero)
    )
    own = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.select(*own, F.col(f"`{column}`").cast("string").alias(key))
    marked = keyed.join(F.broadcast(hot_rows), F.col(key) == F.col(hot_key), "left")
    done = F.col(hot).isNotNull() | F.col(key).isNull()
    spread = 1 + F.pmod(F.xxhash64(*[c for c in own if not _has_map(df, c)]), F.lit(1024)).cast("int")
    marked = marked.withColumn(salt, F.when(done, spread).otherwise(0)).withColumn(key, F.coalesce(key, F.lit("")))
    met = marked.join(cold_rows, (F.col(key) == F.col(cold_key)) & (F.col(salt) == F.col(zero)), "left")
    code = F.coalesce(hot, cold).cast("double")
    if invalid == "keep":
        code = F.coalesce(code, F.lit(float(size)))
    elif invalid == "error":
        code = F.coalesce(code, F.raise_error(F.lit(f"null category in {column}")).cast("double"))
    found = met.select(*own, code.alias(out))
    return found.where(F.col(f"`{out}`").isNotNull()) if invalid == "skip" else found


def _has_map(df: DataFrame, column: Column) -> bool:
    """Whether the column holds a map, which has no hash."""
    return "map<" in df.select(column).schema.fields[0].dataType.simpleString()


def assembler(columns: Sequence[str], output: str = "features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid)


def scaler(features: str, output: str) -> StandardScaler:
    """Divide by the sample standard deviation, without centering: sparse rows stay sparse."""
    return StandardScaler(inputCol=features, outputCol=output, withStd=True, withMean=False)


def vector_indexer(features: str, output: str, max_categories: int, invalid: str = "keep") -> VectorIndexer:
    """Recode slots with few values to 0..n-1 and mark them as categories."""
    return VectorIndexer(
        inputCol=features, outputCol=output, maxCategories=max_categories, handleInvalid=invalid
    )


def fit_one_hot(
    df: DataFrame,
    columns: Sequence[str],
    invalid: str = "error",
    index_suffix: str = "_indexed",
    vector_suffix: str = "_vec",
    max_labels: int = MAX_MODEL_LABELS,
) -> PipelineModel:
    """Index, then one-hot, for several columns in one pass; the last category is all zeros."""
    indexer = fit_indexer(df, columns, index_suffix, invalid, max_labels)
    encoder = OneHotEncoder(
        inputCols=[c + index_suffix for c in columns],
        outputCols=[c + vector_suffix for c in columns],
        dropLast=True,
    )
    # the category counts ride on the column metadata, so this fit reads no rows
    return PipelineModel([indexer, encoder.fit(indexer.transform(df))])


def unencode_one_hot(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Fold each group of 0/1 columns into one category column, -1 where none is set."""
    used = {c for columns in groups.values() for c in columns}
    kept = [F.col(c) for c in df.columns if c not in used]
    return df.select(*kept, *[one_hot_position(columns).alias(name) for name, columns in groups.items()])
