"""Grid points that another point's fit already holds.

A boosted model of fewer iterations is the head of a longer one. A tree that is
less deep, or needs more gain for a split, is the deep tree cut: both choose the
same split wherever both split. A logistic model that converged within fewer
iterations than it was allowed is the model of the smaller allowance. So a grid
needs one fit for each combination of the other parameters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier, GBTClassificationModel, GBTClassifier, LogisticRegression


@dataclass(frozen=True)
class Shared:
    """Points of a grid that come from one fit, and the settings of that fit."""

    settings: dict
    points: list[int]


def _java_array(sc, kind, values):
    out = sc._gateway.new_array(kind, len(values))
    for k, value in enumerate(values):
        out[k] = value
    return out


def _staged(model: GBTClassificationModel, values: dict) -> GBTClassificationModel:
    """The model after its first iterations."""
    from pyspark import SparkContext

    sc, java = SparkContext._active_spark_context, model._java_obj
    n = values["maxIter"]
    trees, weights = list(java.trees())[:n], list(java.treeWeights())[:n]
    kind = sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    head = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), _java_array(sc, kind, trees), _java_array(sc, sc._gateway.jvm.double, weights), java.numFeatures(), java.numClasses()
    )
    return GBTClassificationModel(head)


def _cut(model: DecisionTreeClassificationModel, values: dict) -> DecisionTreeClassificationModel:
    """The tree down to a depth, without splits of too little gain and what is below them.

    Leaves of one prediction with a common parent become one, as in a fit.
    """
    from pyspark import SparkContext

    jvm, java = SparkContext._active_spark_context._jvm, model._java_obj
    ml = jvm.org.apache.spark.ml
    depth, least = values.get("maxDepth"), values.get("minInfoGain", 0.0)

    def of(node, level: int):
        """The node, and its prediction if it is a leaf."""
        prediction = node.prediction()
        inside = node.getClass().getSimpleName() == "InternalNode"
        if inside and (depth is None or level < depth) and node.gain() >= least:
            (left, a), (right, b) = of(node.leftChild(), level + 1), of(node.rightChild(), level + 1)
            if a is None or b is None or a != b:
                stats = node.impurityStats()
                return ml.tree.InternalNode(prediction, node.impurity(), node.gain(), left, right, node.split(), stats), None
        return ml.tree.LeafNode(prediction, node.impurity(), node.impurityStats()), prediction

    root, _ = of(java.rootNode(), 0)
    return DecisionTreeClassificationModel(ml.classification.DecisionTreeClassificationModel(java.uid(), root, java.numFeatures(), java.numClasses()))


def _same_if_converged(model: Model, values: dict) -> Model | None:
    return model if model.summary.totalIterations < values["maxIter"] else None


# Per estimator the parameters a fit covers, which of their values it is made with, and how a point is got from it.
_DERIVED: dict[type, tuple[dict[str, Callable], Callable]] = {
    GBTClassifier: ({"maxIter": max}, _staged),
    DecisionTreeClassifier: ({"maxDepth": max, "minInfoGain": min}, _cut),
    LogisticRegression: ({"maxIter": max}, _same_if_converged),
}


def shared_fits(estimator: Estimator, grid: list[dict]) -> list[Shared]:
    """The fits that give all points of the grid."""
    axes, _ = _DERIVED.get(type(estimator), ({}, None))
    groups: dict[tuple, list[int]] = {}
    for i, point in enumerate(grid):
        rest = tuple(sorted((p.name, repr(v)) for p, v in point.items() if p.name not in axes))
        groups.setdefault(rest, []).append(i)
    out = []
    for points in groups.values():
        settings = dict(grid[points[0]])
        for param in settings:
            if param.name in axes:
                settings[param] = axes[param.name](grid[i][param] for i in points)
        out.append(Shared(settings, points))
    return out


def point_model(estimator: Estimator, model: Model, settings: dict, point: dict) -> Model | None:
    """The model of a point from the fit with `settings`; None where it takes a fit of its own."""
    axes, derive = _DERIVED.get(type(estimator), ({}, None))
    values = {p.name: v for p, v in point.items() if p.name in axes}
    if values == {p.name: v for p, v in settings.items() if p.name in axes}:
        return model
    return derive(model, values)
