"""Fitted models: reports on a test part, tuning, saved pipelines."""

from __future__ import annotations

import re

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from millrace.catalog.base import (
    BINARY,
    FLAG_CODE,
    LINE,
    LINE_KEYS,
    bucket_sql,
    class_metrics_sql,
    exprs,
    full_layout,
    layout,
    line_rows,
    query,
    rounded,
    select_sql,
    table,
    value_metrics_sql,
)
from millrace.functions import as_doubles
from millrace.operators import inspect
from millrace.operators.counts import count_by
from millrace.operators.encode import assembler
from millrace.operators.split import hash_split
from millrace.plans import boosting, regression, trees
from millrace.plans.compact import WEIGHT, compact
from millrace.plans.tuning import SALT, bucketed, k_folds, param_grid, tune
from millrace.session import laid_out, shared_path

_BUCKET = bucket_sql(LINE_KEYS, 10)
_SIGNS = {k: v for k, v in BINARY.items() if k != "price_high"}
_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _split(spark, sf_dir, spec, layout=layout):
    """The columns given as name: expression over lineitem, split 9 to 1 by line."""
    lines = line_rows(spark, sf_dir, *exprs(_KEYS | spec), layout=layout)
    train, test = hash_split(lines, LINE)
    return train.select(*spec), test.select(*spec)


def _same(*columns):
    return {c: c for c in columns}


def _base_sql(label: str, features: dict[str, str]) -> str:
    return (
        f"base AS (SELECT {label} AS label, {select_sql(features)}, {_BUCKET} AS bucket, "
        f"{bucket_sql(LINE_KEYS, 10, SALT)} AS inner_bucket FROM lineitem)"
    )


def _majority_sql(name: str, features: dict[str, str], where: str) -> str:
    """The most frequent label per combination of 0/1 features, ties to the lower label."""
    f = ", ".join(features)
    return f"""{name} AS (
  SELECT {f}, label AS prediction FROM (
    SELECT {f}, label, row_number() OVER (PARTITION BY {f} ORDER BY count(*) DESC, label) AS rn
    FROM base WHERE {where} GROUP BY {f}, label) WHERE rn = 1)"""


def _cells_sql(label: str, features: dict[str, str]) -> str:
    """Predictions of a tree that splits 0/1 features until nothing is left to split."""
    f = ", ".join(features)
    return (
        f"{_base_sql(label, features)}, {_majority_sql('best', features, 'bucket < 9')}, "
        f"pred AS (SELECT base.label, best.prediction FROM base JOIN best USING ({f}) WHERE bucket >= 9)"
    )


_KEYS = _same(*LINE_KEYS)
_FLAG = {"label": FLAG_CODE}
_FLAG_COLUMNS = _FLAG | BINARY
_PRICE_COLUMNS = {"label": BINARY["price_high"]} | _SIGNS
_BULK = "CAST(l_quantity > 30 AS INT)"
_BULK_COLUMNS = {"label": _BULK} | _SIGNS

# -- trees and forests ---------------------------------------------------------------------------


@query("decision_tree", class_metrics_sql(_cells_sql(FLAG_CODE, BINARY)))
def decision_tree(spark, sf_dir):
    return rounded(trees.decision_tree(*_split(spark, sf_dir, _FLAG_COLUMNS), "label").class_metrics(), "value")


@query(
    "decision_tree_confusion",
    f"""WITH {_cells_sql(FLAG_CODE, BINARY)}
SELECT CAST(label AS DOUBLE) AS label, count(*) FILTER (prediction = 0) AS n_0, count(*) FILTER (prediction = 1) AS n_1,
       count(*) FILTER (prediction = 2) AS n_2 FROM pred GROUP BY 1""",
)
def decision_tree_confusion(spark, sf_dir):
    cells = trees.decision_tree(*_split(spark, sf_dir, _FLAG_COLUMNS), "label").confusion()
    return cells.select("label", *[F.col(f"`pred_{i}.0`").alias(f"n_{i}") for i in range(3)])


def _sides_sql(chosen: str) -> str:
    """Accuracy on both parts of the predictions in a CTE named both_parts."""
    return f"""
SELECT CASE WHEN bucket < 9 THEN 'train' ELSE 'test' END AS part,
       round(avg(CAST(label = {chosen} AS DOUBLE)), 6) AS accuracy FROM both_parts GROUP BY 1"""


_F = ", ".join(BINARY)


@query(
    "train_test_accuracy",
    f"""WITH {_base_sql(FLAG_CODE, BINARY)}, {_majority_sql("best", BINARY, "bucket < 9")},
both_parts AS (SELECT base.label, base.bucket, best.prediction FROM base JOIN best USING ({_F}))
{_sides_sql("prediction")}""",
)
def train_test_accuracy(spark, sf_dir):
    fitted = trees.decision_tree(*_split(spark, sf_dir, _FLAG_COLUMNS), "label")
    return rounded(fitted.train_test_accuracy(), "accuracy")


# A gain of 0.05 is never reached here, so that half of the grid predicts the majority class.
@query(
    "decision_tree_tuned",
    f"""
WITH {_base_sql(FLAG_CODE, BINARY)},
{_majority_sql("inner_cells", BINARY, "bucket < 9 AND inner_bucket < 9")},
inner_all AS (SELECT label AS prediction FROM base WHERE bucket < 9 AND inner_bucket < 9
              GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
scores AS (
  SELECT avg(CAST(base.label = inner_cells.prediction AS DOUBLE)) AS split_score,
         avg(CAST(base.label = inner_all.prediction AS DOUBLE)) AS flat_score
  FROM base JOIN inner_cells USING ({_F}), inner_all WHERE bucket < 9 AND inner_bucket >= 9),
{_majority_sql("cells", BINARY, "bucket < 9")},
whole AS (SELECT label AS prediction FROM base WHERE bucket < 9 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
both_parts AS (
  SELECT base.label, base.bucket,
         CASE WHEN split_score >= flat_score THEN cells.prediction ELSE whole.prediction END AS prediction
  FROM base JOIN cells USING ({_F}), whole, scores)
{_sides_sql("prediction")}""",
)
def decision_tree_tuned(spark, sf_dir):
    train, test = _split(spark, sf_dir, _KEYS | _FLAG_COLUMNS)
    fitted, _ = trees.tuned_decision_tree(train, test, "label", LINE)
    return rounded(fitted.train_test_accuracy(), "accuracy")


def _sides_of(name: str, where: str) -> str:
    """Every row once for each 0/1 feature."""
    parts = [f"SELECT '{c}' AS feature, {c} AS v, label FROM base WHERE {where}" for c in BINARY]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


# All 16 points: the number of bins changes nothing for 0/1 columns, a depth of 1 is the best single
# split by the impurity, and a gain of 0.05 is never reached.
@query(
    "tree_grid_report",
    f"""
WITH {_base_sql(FLAG_CODE, BINARY)},
{_majority_sql("cells", BINARY, "bucket < 9 AND inner_bucket < 9")},
whole AS (SELECT label AS prediction FROM base WHERE bucket < 9 AND inner_bucket < 9
          GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
{_sides_of("t", "bucket < 9 AND inner_bucket < 9")}, {_sides_of("h", "bucket < 9 AND inner_bucket >= 9")},
n AS (SELECT feature, v, label, CAST(count(*) AS DOUBLE) AS n FROM t GROUP BY 1, 2, 3),
s AS (SELECT *, sum(n) OVER (PARTITION BY feature, v) AS side,
             row_number() OVER (PARTITION BY feature, v ORDER BY n DESC, label) AS rn FROM n),
pure AS (SELECT feature, sum(n * n / side) AS gini, sum(n * ln(n / side)) AS entropy FROM s GROUP BY 1),
pick AS (SELECT 'gini' AS impurity, arg_max(feature, gini) AS feature FROM pure
         UNION ALL SELECT 'entropy', arg_max(feature, entropy) FROM pure),
one AS (SELECT impurity, avg(CAST(h.label = s.label AS DOUBLE)) AS split_score
        FROM pick JOIN h USING (feature) JOIN s ON s.feature = h.feature AND s.v = h.v AND s.rn = 1 GROUP BY 1),
deep AS (SELECT avg(CAST(base.label = cells.prediction AS DOUBLE)) AS deep_score,
                avg(CAST(base.label = whole.prediction AS DOUBLE)) AS flat_score
         FROM base JOIN cells USING ({_F}), whole WHERE bucket < 9 AND inner_bucket >= 9),
r AS (
  SELECT 'impurity=' || one.impurity || ', maxBins=' || b.bins || ', maxDepth=' || d.depth || ', minInfoGain=' || g.gain AS params,
         round(CASE WHEN g.gain <> '0.0' THEN flat_score WHEN d.depth = 1 THEN split_score ELSE deep_score END, 6) AS metric
  FROM one, deep, (SELECT unnest([40, 300]) AS bins) b, (SELECT unnest([1, 20]) AS depth) d,
       (SELECT unnest(['0.0', '0.05']) AS gain) g)
SELECT CAST(row_number() OVER (ORDER BY metric DESC, params) AS INT) AS "rank", metric, params FROM r
""",
)
def tree_grid_report(spark, sf_dir):
    """Every point of the tree grid by its score; the first one is the one taken."""
    train, test = _split(spark, sf_dir, _KEYS | _FLAG_COLUMNS)
    _, tuned = trees.tuned_decision_tree(train, test, "label", LINE)
    return rounded(inspect.grid_report(spark, tuned.scores, tuned.grid), "metric")


_GROUPED = {"line": "l_linenumber", "is_open": BINARY["is_open"], "qty_high": BINARY["qty_high"]}


def _chosen_sql(label: str, features: dict[str, str]) -> str:
    """Predictions of the better of two trees, by the inner held-out tenth: one split to the end, or the majority class."""
    f = ", ".join(features)
    return f"""{_base_sql(label, features)},
{_majority_sql("inner_cells", features, "bucket < 9 AND inner_bucket < 9")},
inner_all AS (SELECT label AS prediction FROM base WHERE bucket < 9 AND inner_bucket < 9
              GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
scores AS (
  SELECT avg(CAST(base.label = inner_cells.prediction AS DOUBLE)) AS split_score,
         avg(CAST(base.label = inner_all.prediction AS DOUBLE)) AS flat_score
  FROM base JOIN inner_cells USING ({f}), inner_all WHERE bucket < 9 AND inner_bucket >= 9),
{_majority_sql("cells", features, "bucket < 9")},
whole AS (SELECT label AS prediction FROM base WHERE bucket < 9 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
pred AS (
  SELECT base.label, CASE WHEN split_score >= flat_score THEN cells.prediction ELSE whole.prediction END AS prediction
  FROM base JOIN cells USING ({f}), whole, scores WHERE bucket >= 9)"""


# As in decision_tree_tuned, half of the grid predicts the majority class, and that can win.
@query(
    "decision_tree_categorical",
    class_metrics_sql(_chosen_sql(FLAG_CODE, _GROUPED)),
)
def decision_tree_categorical(spark, sf_dir):
    lines = {f"line_{i}": f"CAST(l_linenumber = {i + 1} AS INT)" for i in range(7)}
    rest = {"is_open": BINARY["is_open"], "qty_high": BINARY["qty_high"]}
    train, test = _split(spark, sf_dir, _KEYS | _FLAG | lines | rest)
    fitted, _ = trees.tuned_categorical_tree(train, test, "label", LINE, {"line": list(lines)})
    return rounded(fitted.class_metrics(), "value")


@query("random_forest_classifier")
def random_forest_classifier(spark, sf_dir):
    train, test = _split(spark, sf_dir, _FLAG | _same(*_NUMBERS), full_layout)
    fitted = trees.random_forest_classifier(train, test, "label")
    return rounded(fitted.class_metrics(), "value")


# Without row and column sampling every tree of a forest is the same full tree.
_PLAIN = {"bootstrap": False, "featureSubsetStrategy": "all"}


@query("random_forest_classifier_unsampled", class_metrics_sql(_cells_sql(FLAG_CODE, BINARY)))
def random_forest_classifier_unsampled(spark, sf_dir):
    train, test = _split(spark, sf_dir, _FLAG_COLUMNS)
    return rounded(trees.random_forest_classifier(train, test, "label", **_PLAIN).class_metrics(), "value")


_MIXED_COLUMNS = _same(
    "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice"
)


@query("random_forest_regressor")
def random_forest_regressor(spark, sf_dir):
    train, test = _split(spark, sf_dir, _MIXED_COLUMNS, full_layout)
    fitted = trees.random_forest_regressor(train, test, "l_extendedprice")
    return rounded(fitted.value_metrics(), "value", places=2)


_GROUPS = _same("l_returnflag", "l_linestatus") | {"qty_high": BINARY["qty_high"]}
_PRICE_K = "l_extendedprice / 1000"


def _means_sql() -> str:
    """Predictions of a regression tree split down to single groups: the group means."""
    f = ", ".join(_GROUPS)
    return (
        f"base AS (SELECT {_PRICE_K} AS label, {select_sql(_GROUPS)}, {_BUCKET} AS bucket FROM lineitem), "
        f"best AS (SELECT {f}, avg(label) AS prediction FROM base WHERE bucket < 9 GROUP BY {f}), "
        f"pred AS (SELECT base.label, best.prediction FROM base JOIN best USING ({f}) WHERE bucket >= 9)"
    )


_GROUP_SELECT = {"price": _PRICE_K} | _GROUPS


@query("random_forest_regressor_unsampled", value_metrics_sql(_means_sql()))
def random_forest_regressor_unsampled(spark, sf_dir):
    train, test = _split(spark, sf_dir, _GROUP_SELECT)
    return rounded(trees.random_forest_regressor(train, test, "price", **_PLAIN).value_metrics(), "value", places=4)


_STEPS = {"qty_high": BINARY["qty_high"], "qty_top": "CAST(l_quantity > 40 AS INT)"}


def _scatter_sql(name: str, keys: str) -> str:
    """Squared deviations left inside the groups of the given keys."""
    group = f"GROUP BY {keys}" if keys else ""
    return f"{name} AS (SELECT sum(s) AS s FROM (SELECT var_pop(q) * count(*) AS s FROM b {group}))"


# Over two features split to the end, the root takes the better one and is
# credited with what it explains; the other gets what is explained on top.
@query(
    "feature_importances",
    f"""
WITH b AS (SELECT l_quantity AS q, {select_sql(_STEPS)} FROM lineitem),
{_scatter_sql("total", "")}, {_scatter_sql("high", "qty_high")}, {_scatter_sql("top", "qty_top")},
{_scatter_sql("least", "qty_high, qty_top")},
i AS (
  SELECT CASE WHEN high.s <= top.s THEN total.s - high.s ELSE top.s - least.s END / (total.s - least.s) AS high_part
  FROM total, high, top, least),
r AS (SELECT 'qty_high' AS feature, high_part AS importance FROM i UNION ALL SELECT 'qty_top', 1 - high_part FROM i)
SELECT feature, round(importance, 6) AS importance,
       CAST(row_number() OVER (ORDER BY importance DESC, feature DESC) AS INT) AS "rank" FROM r
""",
)
def feature_importances(spark, sf_dir):
    lines = line_rows(spark, sf_dir, *exprs({"quantity": "l_quantity"} | _STEPS))
    fitted = trees.random_forest_regressor(lines, lines, "quantity", **_PLAIN)
    return rounded(fitted.importances(), "importance")


@query("tree_text")
def tree_text(spark, sf_dir):
    fitted = trees.decision_tree(*_split(spark, sf_dir, _FLAG | _same(*_NUMBERS)), "label")
    return inspect.tree_text(spark, fitted.model)


# Bulk lines are most of those with a high quantity and none of the others: the sides of the split predict different labels.
@query(
    "tree_nodes",
    f"""
WITH b AS (SELECT {_BULK} AS y, {BINARY["qty_high"]} AS qty_high, {BINARY["tax_high"]} AS tax_high FROM lineitem),
x AS (SELECT 'qty_high' AS feature, qty_high AS v, y FROM b UNION ALL SELECT 'tax_high', tax_high, y FROM b),
s AS (SELECT feature, v, CAST(count(*) AS DOUBLE) AS n, avg(y) AS p FROM x GROUP BY 1, 2),
pick AS (SELECT feature FROM s GROUP BY 1 ORDER BY sum(n * p * (1 - p)), 1 LIMIT 1),
leaf AS (SELECT CAST(v + 1 AS INT) AS node, n, p FROM s JOIN pick USING (feature)),
root AS (SELECT count(*) AS n, avg(y) AS p FROM b),
inside AS (SELECT sum(n * 2 * p * (1 - p)) / sum(n) AS impurity FROM leaf)
SELECT CAST(0 AS INT) AS tree, CAST(0 AS INT) AS node, feature, 0.5::DOUBLE AS threshold, CAST(1 AS INT) AS "left",
       CAST(2 AS INT) AS "right", CASE WHEN p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
       round(2 * p * (1 - p), 6) AS impurity, round(2 * p * (1 - p) - inside.impurity, 6) AS gain, CAST(n AS BIGINT) AS n
FROM root, pick, inside
UNION ALL
SELECT 0, node, NULL, NULL, NULL, NULL, CASE WHEN p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END,
       round(2 * p * (1 - p), 6), NULL, CAST(n AS BIGINT) FROM leaf
""",
)
def tree_nodes(spark, sf_dir):
    spec = {"label": _BULK, "qty_high": BINARY["qty_high"], "tax_high": BINARY["tax_high"]}
    lines = line_rows(spark, sf_dir, *exprs(spec))
    fitted = trees.decision_tree(lines, lines, "label", maxDepth=1)
    return rounded(fitted.nodes().drop("categories"), "impurity", "gain")


@query(
    "decision_stump",
    """
WITH t AS (
  SELECT 'l_discount' AS feature, l_discount AS x, l_returnflag AS c FROM lineitem
  UNION ALL SELECT 'l_tax', l_tax, l_returnflag FROM lineitem),
g AS (SELECT feature, x, c, CAST(count(*) AS DOUBLE) AS n FROM t GROUP BY 1, 2, 3),
v AS (SELECT DISTINCT feature, x FROM g),
s AS (
  SELECT v.feature, v.x, g.c, sum(CASE WHEN g.x <= v.x THEN n ELSE 0 END) AS l,
         sum(CASE WHEN g.x > v.x THEN n ELSE 0 END) AS r
  FROM v JOIN g ON v.feature = g.feature GROUP BY 1, 2, 3),
q AS (SELECT feature, x, sum(l * l) / sum(l) + sum(r * r) / sum(r) AS purity FROM s GROUP BY 1, 2 HAVING sum(r) > 0)
SELECT feature, x AS value FROM q ORDER BY purity DESC LIMIT 1
""",
)
def decision_stump(spark, sf_dir):
    """Column of the root split and the highest value that goes left."""
    features = ["l_discount", "l_tax"]
    train = line_rows(spark, sf_dir, *exprs(_FLAG), *features)
    fitted = trees.decision_tree(train, train, "label", maxDepth=1)
    root = fitted.model.stages[-1].toDebugString
    slot, threshold = re.search(r"feature (\d+) <= ([0-9.eE+-]+)", root).groups()
    name = features[int(slot)]
    return train.where(F.col(name) <= float(threshold)).agg(
        F.lit(name).alias("feature"), F.max(name).alias("value")
    ).select("feature", "value")


# -- boosting ------------------------------------------------------------------------------------


@query("gbt_classifier", class_metrics_sql(_cells_sql(BINARY["price_high"], _SIGNS)))
def gbt_classifier(spark, sf_dir):
    return rounded(boosting.gbt_classifier(*_split(spark, sf_dir, _PRICE_COLUMNS), "label").class_metrics(), "value")


@query("gbt_regressor", value_metrics_sql(_means_sql()))
def gbt_regressor(spark, sf_dir):
    train, test = _split(spark, sf_dir, _GROUP_SELECT)
    return rounded(boosting.gbt_regressor(train, test, "price").value_metrics(), "value", places=4)


@query("gbt_tuned_tvs", class_metrics_sql(_cells_sql(BINARY["price_high"], _SIGNS)))
def gbt_tuned_tvs(spark, sf_dir):
    train, test = _split(spark, sf_dir, _KEYS | _PRICE_COLUMNS)
    fitted, _ = boosting.tuned_gbt_holdout(train, test, "label", LINE)
    return rounded(fitted.class_metrics(), "value")


@query("gbt_tuned_cv", class_metrics_sql(_cells_sql(BINARY["price_high"], _SIGNS)))
def gbt_tuned_cv(spark, sf_dir):
    train, test = _split(spark, sf_dir, _KEYS | _PRICE_COLUMNS)
    fitted, _ = boosting.tuned_gbt_folds(train, test, "label", LINE)
    return rounded(fitted.class_metrics(), "value")


# -- regression ----------------------------------------------------------------------------------

# Bulk lines are four fifths of those with a high quantity and none of the
# others, and nothing else matters. Whatever the penalty, the logistic model
# then predicts the quantity sign itself.
_SIGN_PREDICTION = class_metrics_sql(
    f"pred AS (SELECT {_BULK} AS label, {BINARY['qty_high']} AS prediction "
    f"FROM lineitem WHERE {_BUCKET} >= 9)"
)


@query("logistic_regression", _SIGN_PREDICTION)
def logistic_regression(spark, sf_dir):
    fitted = regression.logistic_regression(*_split(spark, sf_dir, _BULK_COLUMNS), "label")
    return rounded(fitted.class_metrics(), "value")


@query("logistic_save_and_score", _SIGN_PREDICTION)
def logistic_save_and_score(spark, sf_dir):
    train, test = _split(spark, sf_dir, _BULK_COLUMNS)
    fitted = regression.logistic_regression_saved(train, test, "label", shared_path(spark, "logistic"))
    return rounded(fitted.class_metrics(), "value")


@query(
    "score_with_saved_model",
    f"SELECT CAST({BINARY['qty_high']} AS DOUBLE) AS prediction, count(*) AS n FROM lineitem GROUP BY 1",
)
def score_with_saved_model(spark, sf_dir):
    path = shared_path(spark, "logistic")
    regression.logistic_regression_saved(*_split(spark, sf_dir, _BULK_COLUMNS), "label", path)
    rows = table(spark, sf_dir, "lineitem").select(*exprs(_SIGNS))
    return count_by(regression.score_saved(path, rows), "prediction")


@query("logistic_tuned_tvs", _SIGN_PREDICTION)
def logistic_tuned_tvs(spark, sf_dir):
    train, test = _split(spark, sf_dir, _KEYS | _BULK_COLUMNS, layout=None)
    fitted, _ = regression.tuned_logistic_holdout(train, test, "label", LINE)
    return rounded(fitted.class_metrics(), "value")


@query("logistic_tuned_cv", _SIGN_PREDICTION)
def logistic_tuned_cv(spark, sf_dir):
    train, test = _split(spark, sf_dir, _KEYS | _BULK_COLUMNS, layout=None)
    fitted, _ = regression.tuned_logistic_folds(train, test, "label", LINE)
    return rounded(fitted.class_metrics(), "value")


_ODDS = "ln(avg({y}) FILTER (WHERE x = {x}) / (1 - avg({y}) FILTER (WHERE x = {x})))"


@query(
    "lr_coefficients",
    f"""
WITH b AS (SELECT {BINARY["price_high"]} AS y, {BINARY["qty_high"]} AS x FROM lineitem WHERE {_BUCKET} < 9),
o AS (SELECT {_ODDS.format(y="y", x=0)} AS low, {_ODDS.format(y="y", x=1)} AS high FROM b)
SELECT CAST(-1 AS INT) AS "class", 'qty_high' AS feature, round(high - low, 4) AS coefficient FROM o
UNION ALL SELECT CAST(-1 AS INT), 'intercept', round(low, 4) FROM o
""",
)
def lr_coefficients(spark, sf_dir):
    """Without a penalty and with one 0/1 feature the coefficients are differences of log odds."""
    train, test = _split(spark, sf_dir, _PRICE_COLUMNS)
    fitted = regression.logistic_regression(
        train, test, "label", ["qty_high"], regParam=0.0, maxIter=100, tol=1e-10
    )
    return rounded(fitted.coefficients(), "coefficient", places=4)


@query(
    "scored_rows",
    f"""
WITH b AS (SELECT {BINARY["price_high"]} AS y, {BINARY["qty_high"]} AS x, {_BUCKET} AS bucket FROM lineitem),
p AS (SELECT x, avg(y) AS p FROM b WHERE bucket < 9 GROUP BY 1)
SELECT CAST(b.y AS DOUBLE) AS label, CASE WHEN p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
       round(1 - p, 4) AS p_0, round(p, 4) AS p_1
FROM b JOIN p USING (x) WHERE bucket >= 9
""",
)
def scored_rows(spark, sf_dir):
    """Every row of the test part with its prediction and probabilities; unpenalised, they are the group's shares."""
    train, test = _split(spark, sf_dir, _PRICE_COLUMNS)
    fitted = regression.logistic_regression(train, test, "label", ["qty_high"], regParam=0.0, maxIter=100, tol=1e-10)
    p = vector_to_array("probability")
    rows = fitted.scored().select("label", "prediction", p[0].alias("p_0"), p[1].alias("p_1"))
    return rounded(rows, "p_0", "p_1", places=4)


@query("model_params")
def model_params(spark, sf_dir):
    return regression.logistic_regression(*_split(spark, sf_dir, _PRICE_COLUMNS), "label").params()


@query("linear_regression")
def linear_regression(spark, sf_dir):
    fitted = regression.linear_regression(*_split(spark, sf_dir, _MIXED_COLUMNS), "l_extendedprice")
    return rounded(fitted.value_metrics(), "value", places=2)


@query(
    "linear_regression_ols",
    """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
FROM lineitem
""",
)
def linear_regression_ols(spark, sf_dir):
    lines = line_rows(spark, sf_dir, "l_quantity", "l_extendedprice")
    fitted = regression.linear_regression(lines, lines, "l_extendedprice", regParam=0.0)
    long = fitted.coefficients()
    wide = long.groupBy().pivot("feature", ["l_quantity", "intercept"]).agg(F.first("coefficient"))
    return rounded(wide.withColumnRenamed("l_quantity", "slope"), "slope", "intercept", places=4)


@query("one_vs_rest")
def one_vs_rest(spark, sf_dir):
    vector = array_to_vector(as_doubles("embedding")).alias("vector")
    rows = table(spark, sf_dir, "embeddings")
    vectors = laid_out(rows.select("vec_id", "label", vector), layout(rows), "vec_id")
    train, test = hash_split(vectors, ["vec_id"])
    fitted = regression.one_vs_rest(train, test, "label", ["vector"])
    return rounded(fitted.class_metrics(), "value")


_PRICE_CLASS = "CASE WHEN l_extendedprice < 20000 THEN 0 WHEN l_extendedprice < 50000 THEN 1 ELSE 2 END"
_QTY = {"qty_high": BINARY["qty_high"]}


@query("one_vs_rest_unpenalised", class_metrics_sql(_cells_sql(_PRICE_CLASS, _QTY)))
def one_vs_rest_unpenalised(spark, sf_dir):
    """One 0/1 feature: each class model gives the class's share, so the largest share wins."""
    train, test = _split(spark, sf_dir, {"label": _PRICE_CLASS} | _QTY)
    fitted = regression.one_vs_rest(train, test, "label", regParam=0.0, maxIter=100, tol=1e-10)
    return rounded(fitted.class_metrics(), "value")


# -- grid report ---------------------------------------------------------------------------------


@query(
    "grid_report",
    f"""
WITH base AS (SELECT {FLAG_CODE} AS label, {select_sql(BINARY)}, {bucket_sql(LINE_KEYS, 3, SALT)} AS fold FROM lineitem),
k AS (SELECT unnest([0, 1, 2]) AS k),
cells AS (
  SELECT k, {_F}, label AS prediction FROM (
    SELECT k.k, {_F}, label, row_number() OVER (PARTITION BY k.k, {_F} ORDER BY count(*) DESC, label) AS rn
    FROM base, k WHERE fold <> k.k GROUP BY k.k, {_F}, label) WHERE rn = 1),
flat AS (
  SELECT k, label AS prediction FROM (
    SELECT k.k, label, row_number() OVER (PARTITION BY k.k ORDER BY count(*) DESC, label) AS rn
    FROM base, k WHERE fold <> k.k GROUP BY k.k, label) WHERE rn = 1),
folds AS (
  SELECT base.fold, avg(CAST(base.label = cells.prediction AS DOUBLE)) AS deep,
         avg(CAST(base.label = flat.prediction AS DOUBLE)) AS shallow
  FROM base JOIN cells USING ({_F}) JOIN flat ON flat.k = cells.k
  WHERE base.fold = cells.k GROUP BY 1),
s AS (SELECT avg(deep) AS deep, avg(shallow) AS shallow FROM folds),
r AS (
  SELECT 'impurity=' || i.impurity || ', maxDepth=' || d.depth AS params,
         round(CASE WHEN d.depth = 0 THEN s.shallow ELSE s.deep END, 6) AS metric
  FROM s, (SELECT unnest(['gini', 'entropy']) AS impurity) i, (SELECT unnest([0, 5]) AS depth) d)
SELECT CAST(row_number() OVER (ORDER BY metric DESC, params) AS INT) AS "rank", metric, params FROM r
""",
)
def grid_report(spark, sf_dir):
    names = list(BINARY)
    lines = line_rows(spark, sf_dir, *exprs(_KEYS | _FLAG_COLUMNS))
    tree = DecisionTreeClassifier(labelCol="label", featuresCol="features", seed=1)
    grid = param_grid(tree, impurity=["gini", "entropy"], maxDepth=[0, 5])
    plain = bucketed(lines, LINE, 3).select(F.col("label").cast("double").alias("label"), "_bucket", *names)
    few = compact(plain, tree, "label", grid)
    rows = assembler(names).transform(few).select("label", "_bucket", "features", *[c for c in few.columns if c == WEIGHT])
    tuned = tune(rows, tree, grid, k_folds(3), "label", "accuracy")
    return rounded(inspect.grid_report(spark, tuned.scores, tuned.grid), "metric")
