"""What a fitted model holds, as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import shared_path


def last_stage(model):
    """The fitted estimator behind a pipeline, nested or not."""
    while isinstance(model, PipelineModel):
        model = model.stages[-1]
    return model


def schema_report(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def feature_importances(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """(feature, importance, rank), best first, ties by descending name."""
    values = last_stage(model).featureImportances.toArray()
    ordered = sorted(zip((float(v) for v in values), features), reverse=True)
    rows = [(name, value, rank) for rank, (value, name) in enumerate(ordered, 1)]
    return spark.createDataFrame(rows, "feature string, importance double, rank int")


def coefficients(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """(class, feature, coefficient); the intercept is a row of its own.

    A binary or linear model has one set, shown as class -1; a multinomial one
    has a set per class.
    """
    fitted = last_stage(model)
    if getattr(fitted, "numClasses", 2) > 2:
        matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
        sets = list(enumerate(zip(matrix, intercepts)))
    else:
        sets = [(-1, (fitted.coefficients.toArray(), fitted.intercept))]
    rows = []
    for c, (weights, intercept) in sets:
        rows += [(c, name, float(w)) for name, w in zip(features, weights)]
        rows.append((c, "intercept", float(intercept)))
    return spark.createDataFrame(rows, "class int, feature string, coefficient double")


def model_params(spark: SparkSession, model) -> DataFrame:
    """(param, value) of the fitted estimator."""
    found = last_stage(model).extractParamMap()
    rows = sorted((p.name, str(v)) for p, v in found.items())
    return spark.createDataFrame(rows, "param string, value string")


def tree_text(spark: SparkSession, model) -> DataFrame:
    """The printed tree by line, without the first one, which holds a random id."""
    lines = last_stage(model).toDebugString.rstrip().split("\n")[1:]
    return spark.createDataFrame(list(enumerate(lines, 1)), "line int, text string")


def tree_nodes(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """The nodes of a fitted tree, forest or boosted model, as rows read from its saved form.

    (tree, node, feature, threshold, categories, left, right, prediction, impurity, gain, n).
    Rows at or below the threshold, or of one of the categories, go left. A leaf has null
    in feature, threshold, categories, left, right and gain; a split has a threshold or
    categories. A single tree is tree 0; n counts rows, as the tree's bag held them, and
    rows with a weight as so many.
    The nodes never pass through the driver.
    """
    path = shared_path(spark, "tree")
    last_stage(model).write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.select(F.lit(0).alias("tree"), "*")
    inner, slot = F.col("leftChild") >= 0, F.col("split.featureIndex")
    ordered = F.col("split.numCategories") < 0
    values = F.col("split.leftCategoriesOrThreshold")
    names = spark.createDataFrame(list(enumerate(features)), "_slot int, feature string")
    n, fitted, stats = F.col("rawCount"), last_stage(model), F.col("impurityStats")
    if fitted.hasParam("weightCol") and fitted.isSet("weightCol"):
        # a node of classes holds the weight of each of them, one of values its whole weight first
        by_class = isinstance(fitted, (DecisionTreeClassificationModel, RandomForestClassificationModel))
        weight = F.aggregate(stats, F.lit(0.0), lambda total, x: total + x) if by_class else F.get(stats, 0)
        n = F.round(weight).cast("bigint")
    return data.join(names, inner & (slot == F.col("_slot")), "left").select(
        "tree",
        F.col("id").alias("node"),
        "feature",
        F.when(inner & ordered, F.get(values, 0)).alias("threshold"),
        F.when(inner & ~ordered, values).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        "prediction",
        "impurity",
        F.when(inner, F.col("gain")).alias("gain"),
        n.alias("n"),
    )


def grid_report(spark: SparkSession, scores: Sequence[float], grid: Sequence[dict]) -> DataFrame:
    """(rank, metric, params) of every grid point, best first."""
    named = [", ".join(f"{p.name}={v}" for p, v in sorted(g.items(), key=lambda i: i[0].name)) for g in grid]
    ordered = sorted(zip(scores, named), key=lambda row: (-row[0], row[1]))
    rows = [(rank, float(score), text) for rank, (score, text) in enumerate(ordered, 1)]
    return spark.createDataFrame(rows, "rank int, metric double, params string")
