"""Classification and regression metrics, each from one pass over the predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.counts import confusion_cells

CLASS_METRICS = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]
VALUE_METRICS = ["mse", "rmse", "r2", "mae"]


def _long(row: DataFrame, names: list[str]) -> DataFrame:
    return row.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])).alias("m")
    ).select("m.metric", "m.value")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def class_metric_rows(df: DataFrame, label: str, prediction: str, *by: str, weight: str | None = None) -> DataFrame:
    """accuracy, weighted precision, weighted recall and f1 in one row, or in one for each value of `by`.

    The rows are counted per (label, prediction) first; all that follows works
    on those few counts. `weight` names whole numbers that rows count as.
    """
    n, hit = F.col("n"), F.col("label") == F.col("prediction")
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("label").alias("c"), n.alias("actual"), none.alias("guessed"), F.when(hit, n).otherwise(0).alias("tp")),
        F.struct(F.col("prediction").alias("c"), none.alias("actual"), n.alias("guessed"), none.alias("tp")),
    )
    if by or weight:
        size = F.sum(weight).cast("bigint") if weight else F.count("*")
        cells = df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(size.alias("n"))
    else:
        cells = confusion_cells(df, label, prediction)
    per_class = (
        cells.select(*by, F.inline(sides))
        .groupBy(*by, "c")
        .agg(*[F.sum(x).alias(x) for x in ("actual", "guessed", "tp")])
        .withColumn("p", _ratio(F.col("tp"), F.col("guessed")))
        .withColumn("r", _ratio(F.col("tp"), F.col("actual")))
        .withColumn("f", _ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    )

    def weighted(x: str) -> Column:
        return F.sum(F.col("actual") * F.col(x)) / F.sum("actual")

    return per_class.groupBy(*by).agg(
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        weighted("p").alias("weightedPrecision"),
        weighted("r").alias("weightedRecall"),
        weighted("f").alias("f1"),
    )


def class_metric_row(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """The four class metrics in one row."""
    return class_metric_rows(df, label, prediction)


def class_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return _long(class_metric_row(df, label, prediction), CLASS_METRICS)


def value_metric_row(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """mse, rmse, r2 and mae in one row."""
    return value_metric_rows(df, label, prediction)


def value_metric_rows(df: DataFrame, label: str, prediction: str, *by: str) -> DataFrame:
    """The four value metrics, in one row for each value of `by`."""
    miss = F.col(label) - F.col(prediction)
    mse = F.avg(miss * miss)
    return df.groupBy(*by).agg(
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        (1 - F.try_divide(mse, F.var_pop(label))).alias("r2"),
        F.avg(F.abs(miss)).alias("mae"),
    )


def value_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return _long(value_metric_row(df, label, prediction), VALUE_METRICS)


def train_test_accuracy(model, train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Accuracy on both sides of a split, to see overfitting."""
    hit = F.avg((F.col(label) == F.col("prediction")).cast("double")).alias("accuracy")

    def side(name: str, df: DataFrame) -> DataFrame:
        return model.transform(df).agg(hit).select(F.lit(name).alias("part"), "accuracy")

    return side("train", train).unionByName(side("test", test))
