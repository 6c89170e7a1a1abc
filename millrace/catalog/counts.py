"""Frequency tables, priors, confusion matrices, entropies and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import EVENT, bucket_sql, class_metrics_sql, query, rounded, table, value_metrics_sql
from millrace.functions import hash_bucket
from millrace.operators import counts, evaluate


@query(
    "explore_label_counts",
    "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_returnflag LIMIT 10",
)
def explore_label_counts(spark, sf_dir):
    return counts.frequency_table(table(spark, sf_dir, "lineitem"), "l_returnflag")


@query(
    "explore_category_counts",
    "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 10",
)
def explore_category_counts(spark, sf_dir):
    return counts.frequency_table(table(spark, sf_dir, "events"), "user_id")


@query(
    "class_priors",
    """
SELECT l_returnflag AS label, round(count(*) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE), 6) AS prior
FROM lineitem GROUP BY 1
""",
)
def class_priors(spark, sf_dir):
    return rounded(counts.class_priors(table(spark, sf_dir, "lineitem"), "l_returnflag"), "prior")


@query(
    "random_baseline_accuracy",
    f"""
WITH b AS (SELECT event_type, {bucket_sql(["event_id"], 10)} AS bucket FROM events),
tr AS (SELECT event_type, count(*) / CAST((SELECT count(*) FROM b WHERE bucket < 9) AS DOUBLE) AS p
       FROM b WHERE bucket < 9 GROUP BY 1),
te AS (SELECT event_type, count(*) / CAST((SELECT count(*) FROM b WHERE bucket >= 9) AS DOUBLE) AS p
       FROM b WHERE bucket >= 9 GROUP BY 1)
SELECT round(sum(tr.p * te.p), 6) AS accuracy FROM tr JOIN te ON tr.event_type = te.event_type
""",
)
def random_baseline_accuracy(spark, sf_dir):
    in_train = hash_bucket(EVENT, 10) < 9
    return rounded(counts.chance_accuracy(table(spark, sf_dir, "events"), "event_type", in_train), "accuracy")


# A fixed rule stands in for a fitted model: eight units of quantity per class.
_LINE_RULE = "CAST(LEAST(7, CEIL(l_quantity / 7.5)) AS INT)"


def _line_predictions(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_linenumber").alias("label"), F.expr(_LINE_RULE).alias("prediction"))


@query(
    "confusion_matrix",
    "SELECT l_linenumber AS label, "
    + ", ".join(f"count(*) FILTER (WHERE {_LINE_RULE} = {c}) AS pred_{c}" for c in range(1, 8))
    + " FROM lineitem GROUP BY 1",
)
def confusion_matrix(spark, sf_dir):
    return counts.confusion_matrix(_line_predictions(spark, sf_dir), "label", "prediction", range(1, 8))


_FLAG_RULE = "CASE WHEN l_linestatus = 'F' AND l_quantity < 25 THEN 'A' WHEN l_linestatus = 'F' THEN 'R' ELSE 'N' END"


@query(
    "confusion_matrix_all_labels",
    "SELECT l_returnflag AS label, "
    + ", ".join(f"count(*) FILTER (WHERE {_FLAG_RULE} = '{c}') AS pred_{c}" for c in "ANR")
    + " FROM lineitem GROUP BY 1",
)
def confusion_matrix_all_labels(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("prediction", F.expr(_FLAG_RULE))
    return counts.confusion_matrix_all_labels(lines, "l_returnflag", "prediction")


@query(
    "label_entropy",
    """
WITH c AS (SELECT event_type, user_id, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY 1, 2),
p AS (SELECT event_type, n / sum(n) OVER (PARTITION BY event_type) AS p FROM c)
SELECT event_type AS "group", round(sum(-p * ln(p)), 6) AS entropy FROM p GROUP BY 1
""",
)
def label_entropy(spark, sf_dir):
    return rounded(counts.label_entropy(table(spark, sf_dir, "events"), "event_type", "user_id"), "entropy")


@query(
    "multiclass_metrics",
    class_metrics_sql(f"pred AS (SELECT l_linenumber AS label, {_LINE_RULE} AS prediction FROM lineitem)"),
)
def multiclass_metrics(spark, sf_dir):
    return rounded(evaluate.class_metrics(_line_predictions(spark, sf_dir), "label"), "value")


_PRICE_RULE = "1500.0 * l_quantity + 100.0"


@query(
    "regression_metrics",
    value_metrics_sql(f"pred AS (SELECT l_extendedprice AS label, {_PRICE_RULE} AS prediction FROM lineitem)", 2),
)
def regression_metrics(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("prediction", F.expr(_PRICE_RULE).cast("double"))
    return rounded(evaluate.value_metrics(lines, "l_extendedprice"), "value", places=2)
