"""Frequency tables, class priors, confusion matrices and entropies.

Each starts from a count per key, which Spark combines before the shuffle, so
a key that holds a third of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import cut_lineage

# As many pivot columns as Spark itself allows by default.
MAX_PIVOT_CLASSES = 10_000


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def frequency_table(df: DataFrame, key: str, top: int = 10) -> DataFrame:
    """The most frequent values of a column."""
    return count_by(df, key).orderBy(F.desc("n"), key).limit(top)


def cluster_label_counts(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    return count_by(df, cluster, label).orderBy(cluster, label)


def largest_cluster_labels(df: DataFrame, cluster: str = "cluster", label: str = "label", top: int = 25) -> DataFrame:
    """The first rows of the cluster x label counts, by cluster and then the largest count."""
    return count_by(df, cluster, label).orderBy(cluster, F.desc("n"), label).limit(top)


def class_priors(df: DataFrame, label: str) -> DataFrame:
    """Share of each class."""
    counts = count_by(df, label)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(F.col(label).alias("label"), (F.col("n") / total).alias("prior")).orderBy("label")


def chance_accuracy(df: DataFrame, label: str, in_train: Column) -> DataFrame:
    """Accuracy of guessing by the training priors: sum of train prior x test prior.

    The two sides meet by class, so a class missing from one of them adds
    nothing and shifts nothing.
    """
    sides = df.groupBy(label).agg(
        F.count_if(in_train).alias("n_train"), F.count_if(~in_train).alias("n_test")
    )
    agree = F.sum(F.col("n_train").cast("double") * F.col("n_test"))
    pairs = F.sum("n_train").cast("double") * F.sum("n_test")
    return sides.agg(F.try_divide(agree, pairs).alias("accuracy"))


def chance_accuracy_of(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """The same for two separate frames."""
    both = train.select(label, F.lit(True).alias("_train")).unionByName(
        test.select(label, F.lit(False).alias("_train"))
    )
    return chance_accuracy(both, label, F.col("_train"))


def confusion_cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return count_by(df.select(F.col(label).alias("label"), F.col(prediction).alias("prediction")),
                    "label", "prediction")


def _square(cells: DataFrame, classes: Sequence) -> DataFrame:
    wide = cells.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("n")).na.fill(0)
    names = [F.col(f"`{c}`").alias(f"pred_{c}") for c in classes]
    return wide.select("label", *names).orderBy("label")


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """One row per label, one column per class given by the caller; other predictions are not shown."""
    return _square(confusion_cells(df, label, prediction), classes)


def confusion_matrix_all_labels(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """The same with the classes taken from both columns of the data.

    Rows without a prediction are counted in pred_null, which is there if any
    are; rows without a label have a row of their own.
    """
    cells = cut_lineage(confusion_cells(df, label, prediction))  # one pass over the rows
    both = cells.select(F.explode(F.array("label", "prediction")).alias("c"))
    seen = both.where("c IS NOT NULL").distinct().orderBy("c").limit(MAX_PIVOT_CLASSES + 1)
    classes = [row.c for row in seen.collect()]
    if len(classes) > MAX_PIVOT_CLASSES:
        raise ValueError(f"more than {MAX_PIVOT_CLASSES} classes; use confusion_cells instead")
    every = both.where("c IS NOT NULL").select(
        F.col("c").alias("label"), F.col("c").alias("prediction"), F.lit(0).cast("bigint").alias("n")
    )
    square = _square(cells.unionByName(every), classes)
    missing = cells.where("prediction IS NULL").select(F.col("label").alias("_of"), F.col("n").alias("pred_null"))
    if missing.isEmpty():
        return square
    square = square.join(missing, F.col("label").eqNullSafe(F.col("_of")), "left").drop("_of")
    return square.withColumn("pred_null", F.coalesce("pred_null", F.lit(0).cast("bigint"))).orderBy("label")


# With N = sum of n, the entropy -sum(n/N ln(n/N)) equals ln N - sum(n ln n)/N.
# That form needs one combinable aggregate and no second pass for N.


def _n_log_n(n: str) -> Column:
    return F.col(n) * F.ln(F.col(n))


def label_entropy(df: DataFrame, group: str, label: str) -> DataFrame:
    """Entropy (natural log) of the label inside each group."""
    return (
        count_by(df, group, label)
        .groupBy(F.col(group).alias("group"))
        .agg(F.greatest(F.ln(F.sum("n")) - F.sum(_n_log_n("n")) / F.sum("n"), F.lit(0.0)).alias("entropy"))
    )


def weighted_entropy(df: DataFrame, group: str, label: str, *by: str, n: str | None = None) -> DataFrame:
    """Group entropies averaged with the group sizes as weights, in one row or in one for each value of `by`.

    `n` names whole numbers that rows count as.
    """
    counts = df.groupBy(*by, group, label).agg(F.sum(n).alias("n")) if n else count_by(df, *by, group, label)
    groups = (
        counts
        .groupBy(*by, group)
        .agg(F.sum("n").alias("size"), F.sum(_n_log_n("n")).alias("inner"))
    )
    spent = F.sum(_n_log_n("size") - F.col("inner")) / F.sum("size")
    return groups.groupBy(*by).agg(F.greatest(spent, F.lit(0.0)).alias("entropy"))
