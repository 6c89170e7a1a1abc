"""Grid search on a held-out part or on folds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import Keys, hash_bucket
from millrace.operators.encode import assembler, feature_columns
from millrace.operators.evaluate import class_metric_rows, value_metric_rows
from millrace.plans.compact import WEIGHT, compact, weighted
from millrace.plans.derived import Shared, point_model, shared_fits
from millrace.plans.models import Fitted, labelled
from millrace.session import held

_BUCKET = "_bucket"

# Keeps the inner parts independent of a train/test split on the same keys.
SALT = "tune"
_LARGER_IS_WORSE = {"mse", "rmse", "mae"}


@dataclass(frozen=True)
class Tuned:
    model: Model
    scores: list[float]
    grid: list[dict]
    best: int


def param_grid(estimator: Estimator, **axes: Sequence) -> list[dict]:
    """Every combination of the values given per parameter name."""
    builder = ParamGridBuilder()
    for name, values in axes.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def bucketed(df: DataFrame, keys: Keys | Sequence[str], buckets: int) -> DataFrame:
    """Carry the hash bucket of the keys, before the keys themselves are projected away."""
    return df.withColumn(_BUCKET, hash_bucket(keys, buckets, SALT))


def holdout(train_share: int) -> list[tuple[Column, Column]]:
    """One pair: buckets below `train_share` train, the rest validate."""
    return [(F.col(_BUCKET) < train_share, F.col(_BUCKET) >= train_share)]


def k_folds(folds: int) -> list[tuple[Column, Column]]:
    """A pair per fold: one bucket validates, the others train."""
    return [(F.col(_BUCKET) != i, F.col(_BUCKET) == i) for i in range(folds)]


def score_all(models: list[Model], rows: DataFrame, label: str, metric: str) -> list[float]:
    """The metric of every model, from one scan of the rows.

    Every model adds its prediction to the row, and one aggregate counts them
    all by model. A model writes nothing else beside it, so Spark computes no
    probabilities. Rows with a weight count as so many.
    """
    weight = [c for c in rows.columns if c == WEIGHT]
    names = []
    for k, model in enumerate(models):
        name = f"_prediction_{k}"
        model = model.copy({model.predictionCol: name, **{getattr(model, p): "" for p in ("rawPredictionCol", "probabilityCol") if model.hasParam(p)}})
        rows = model.transform(rows)
        names.append(name)
    each = F.posexplode(F.array(*[F.col(n) for n in names])).alias("_model", "prediction")
    predicted = rows.select(F.col(label).alias("label"), *weight, each)
    if metric in _LARGER_IS_WORSE | {"r2"}:
        scored = value_metric_rows(predicted, "label", "prediction", "_model")
    else:
        scored = class_metric_rows(predicted, "label", "prediction", "_model", weight=weight[0] if weight else None)
    found = {r["_model"]: r[metric] for r in scored.collect()}
    return [found[k] for k in range(len(models))]


def fit_points(estimator: Estimator, grid: list[dict], train: DataFrame, shared: Shared) -> dict[int, Model]:
    """The models of the points of one shared fit."""
    whole = estimator.fit(train, shared.settings)
    out = {}
    for i in shared.points:
        model = point_model(estimator, whole, shared.settings, grid[i])
        out[i] = model if model is not None else estimator.fit(train, grid[i])
    return out


def tune(
    rows: DataFrame,
    estimator: Estimator,
    grid: list[dict],
    parts: list[tuple[Column, Column]],
    label: str,
    metric: str = "f1",
    parallelism: int = 4,
    prepare: Estimator | None = None,
) -> Tuned:
    """Score every grid point on every part, then refit the best on all rows.

    `rows` comes from `bucketed` and is cached once; the parts are filters on
    it. Spark's own tuners draw the parts with rand() or check a fold column in
    a Python function per row, and cache a copy per fold. Here a part depends
    on the row's hash only, so a recomputed partition cannot move a row from
    training to validation. Points that one fit covers share it, the fits of all parts
    go through one pool, and a part's models are scored in one scan.

    `prepare` is fitted once for each part's training rows and for the winner, not
    for each point; the winner is then a pipeline of both. Rows from `compact` are
    fitted and counted by their weights, for class metrics.
    """
    estimator = weighted(estimator, rows)
    fits = shared_fits(estimator, grid)
    with held(rows) as cached, ThreadPool(max(1, min(parallelism, len(fits) * len(parts)))) as pool:
        sides = []
        for is_train, is_validation in parts:
            train, validation = cached.where(is_train), cached.where(is_validation)
            if prepare is not None:
                ready = prepare.fit(train)
                train, validation = ready.transform(train), ready.transform(validation)
            sides.append((train, validation))

        def one(part, fit):
            return part, fit_points(estimator, grid, sides[part][0], fit)

        # the caller's job group and pool go with each job, in properties of its own: two jobs that share them fail at times
        jobs = [inheritable_thread_target(partial(one, p, f)) for p in range(len(parts)) for f in fits]
        models: list[dict[int, Model]] = [{} for _ in parts]
        for part, found in pool.imap_unordered(lambda job: job(), jobs):
            models[part].update(found)
        totals = [0.0] * len(grid)
        for (_, validation), found in zip(sides, models, strict=True):
            for i, value in enumerate(score_all([found[i] for i in range(len(grid))], validation, label, metric)):
                totals[i] += value
        scores = [t / len(parts) for t in totals]
        pick = min if metric in _LARGER_IS_WORSE else max
        best = scores.index(pick(scores))
        if prepare is None:
            return Tuned(estimator.fit(cached, grid[best]), scores, grid, best)
        ready = prepare.fit(cached)
        return Tuned(PipelineModel([ready, estimator.fit(ready.transform(cached), grid[best])]), scores, grid, best)


def tune_classifier(
    estimator: Estimator,
    grid: list[dict],
    train: DataFrame,
    test: DataFrame,
    label: str,
    keys: Keys | Sequence[str],
    features: Sequence[str] | None,
    buckets: int,
    parts: list[tuple[Column, Column]],
    metric: str,
    parallelism: int,
    prepare: Estimator | None = None,
) -> tuple[Fitted, Tuned]:
    """Assemble once, tune on vector, label and bucket, and put the winner behind the assembler."""
    names = list(features or feature_columns(train, label, list(keys)))
    stage = assembler(names)
    few = compact(bucketed(labelled(train, label), keys, buckets).select(label, _BUCKET, *names), estimator, label, grid, logistic=True)
    rows = stage.transform(few).select(label, _BUCKET, "features", *[c for c in few.columns if c == WEIGHT])
    tuned = tune(rows, estimator, grid, parts, label, metric, parallelism, prepare)
    model = PipelineModel([stage, tuned.model])
    return Fitted(model, labelled(train, label), labelled(test, label), label, names), tuned
