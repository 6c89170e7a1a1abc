"""Equal rows as few weighted ones, for fits that are the same over both.

A tree reads its rows through sums per node and bin. Equal rows add the same to
them as one row with their number as weight. A regression tree needs the number,
sum and sum of squares of the labels: two rows at the mean, one standard
deviation below and above, have those of all rows with equal features, and keep
them when boosting takes one prediction off them all.

A logistic model reads sums over its rows too, but Spark's spread of weighted
rows, by which it scales the columns, is that of equal ones only where weights
are small beside their sum: a kind of row comes in up to PIECES pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

WEIGHT = "_weight"

# Different rows up to which a fit goes over them instead of over all rows.
MAX_KINDS = 4096

# Rows of a kind for a logistic fit. A kind with fewer rows comes in all of them.
PIECES = 1024

_CLASSES = (DecisionTreeClassifier, GBTClassifier, RandomForestClassifier)
_VALUES = (DecisionTreeRegressor, GBTRegressor, RandomForestRegressor)


def rows_add_up(estimator: Estimator) -> bool:
    """Whether the fit is the same when equal rows are one with a weight: trees that draw no rows and need no number of them."""
    if not isinstance(estimator, (*_CLASSES, *_VALUES)) or estimator.isSet("weightCol") or estimator.getMinInstancesPerNode() > 1:
        return False
    if isinstance(estimator, (RandomForestClassifier, RandomForestRegressor)) and estimator.getBootstrap():
        return False
    if isinstance(estimator, (GBTClassifier, GBTRegressor)) and estimator.isSet("validationIndicatorCol"):
        return False
    return not estimator.hasParam("subsamplingRate") or estimator.getSubsamplingRate() == 1.0


def compact(df: DataFrame, estimator: Estimator, label: str, grid: Sequence[dict] = (), logistic: bool = False) -> DataFrame:
    """The rows with a column `WEIGHT`, equal ones together; the rows as they are where that changes the fit or many differ.

    A kind of row comes in as many pieces as it has rows, up to the number of
    bins: Spark allows no more bins than there are rows. `logistic` says whether
    rows of a logistic model are put together as well.
    """
    logistic = logistic and isinstance(estimator, LogisticRegression) and not estimator.isSet("weightCol")
    if not (logistic or rows_add_up(estimator)):
        return df
    values = isinstance(estimator, _VALUES)
    keys = [c for c in df.columns if not (values and c == label)]
    if df.agg(F.approx_count_distinct(F.struct(*keys))).first()[0] > MAX_KINDS:
        return df
    bins = PIECES if logistic else max([estimator.getMaxBins(), *[point[estimator.maxBins] for point in grid if estimator.maxBins in point]])
    n, piece = F.col("_n"), F.col("_piece")
    pieces = F.least(n, F.lit(bins))
    weight = (F.floor(n / pieces) + F.when(piece < n % pieces, 1).otherwise(0)).cast("double")
    found = [F.count("*").alias("_n")]
    if values:
        # a null label stays one, and is refused by the fit
        known = F.count(label) == F.count("*")
        found += [F.when(known, F.avg(label)).alias("_mean"), F.when(known, F.stddev_pop(label)).alias("_spread")]
    kinds = df.groupBy(*keys).agg(*found)
    parts = kinds.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)).alias("_piece"))
    if values:
        parts = parts.select(*keys, weight.alias(WEIGHT), "_mean", "_spread", F.explode(F.array(F.lit(-1.0), F.lit(1.0))).alias("_side"))
        rows = parts.select(*keys, (F.col("_mean") + F.col("_side") * F.col("_spread")).alias(label), (F.col(WEIGHT) / 2).alias(WEIGHT))
    else:
        rows = parts.select(*keys, weight.alias(WEIGHT))
    rows = rows.select(*df.columns, WEIGHT)
    return rows.coalesce(1).sortWithinPartitions(*rows.columns)


def weighted(estimator: Estimator, rows: DataFrame) -> Estimator:
    """The estimator, reading the weights of rows that have them."""
    return estimator.copy({estimator.weightCol: WEIGHT}) if WEIGHT in rows.columns else estimator
