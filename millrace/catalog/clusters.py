"""Distances, nearest centers, k-means scores and anomalies."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millrace.catalog.base import exprs, query, rounded, select_sql, line_rows, table
from millrace.functions import as_doubles, squared_distance
from millrace.operators.cluster import (
    at_least_kth,
    distance_to_center,
    group_centers,
    join_centers,
    mean_cost,
    nearest_center,
)
from millrace.operators.counts import cluster_label_counts, weighted_entropy
from millrace.operators.encode import assembler, fit_one_hot
from millrace.operators.rank import kth_largest
from millrace.plans.clustering import TIGHT, cluster, cost_sweep, entropy_sweep
from millrace.plans.features import fit_connection_features, fit_scaled_features, numeric_features
from millrace.plans.workflows import detect_anomalies

# The fixed centers are the mean vectors of the labels.
_ASSIGNED = """
x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS pos
      FROM embeddings),
c AS (SELECT label AS cluster, pos, avg(v) AS m FROM x GROUP BY 1, 2),
d AS (SELECT x.vec_id, x.label, c.cluster, sum((x.v - c.m) * (x.v - c.m)) AS dist
      FROM x JOIN c ON x.pos = c.pos GROUP BY 1, 2, 3),
a AS (SELECT vec_id, label, cluster, dist
      FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster) AS rn FROM d) WHERE rn = 1)
"""


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", as_doubles("embedding").alias("v"))


def _centers(spark, sf_dir):
    return group_centers(table(spark, sf_dir, "embeddings"), "label", "embedding")


def _assigned(spark, sf_dir):
    return nearest_center(_vectors(spark, sf_dir), "v", _centers(spark, sf_dir)).drop("v")


@query(
    "squared_distance",
    """
WITH x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS pos
           FROM embeddings),
m AS (SELECT pos, avg(v) AS m FROM x GROUP BY 1)
SELECT vec_id, round(sum((v - m) * (v - m)), 6) AS dist FROM x JOIN m ON x.pos = m.pos GROUP BY 1
""",
)
def squared_distance_to_mean(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    one = group_centers(vectors.withColumn("all", F.lit(0)), "all", "v").select("center").scalar()
    return rounded(vectors.withColumn("mean", one).select("vec_id", squared_distance("v", "mean").alias("dist")), "dist")


@query("nearest_center_assign", f"WITH {_ASSIGNED} SELECT vec_id, cluster, round(dist, 6) AS dist FROM a")
def nearest_center_assign(spark, sf_dir):
    return rounded(_assigned(spark, sf_dir).select("vec_id", "cluster", "dist"), "dist")


@query(
    "distance_to_center",
    f"WITH {_ASSIGNED} SELECT vec_id, cluster, round(dist, 6) AS dist FROM d WHERE cluster = label",
)
def distance_to_own_center(spark, sf_dir):
    vectors = _vectors(spark, sf_dir).withColumnRenamed("label", "cluster")
    return rounded(distance_to_center(vectors, _centers(spark, sf_dir), "v").drop("v"), "dist")


@query("cluster_label_counts", f"WITH {_ASSIGNED} SELECT cluster, label, count(*) AS n FROM a GROUP BY 1, 2")
def cluster_label_counts_fixed(spark, sf_dir):
    return cluster_label_counts(_assigned(spark, sf_dir))


@query(
    "weighted_cluster_entropy",
    f"""
WITH {_ASSIGNED},
n AS (SELECT cluster, label, CAST(count(*) AS DOUBLE) AS n FROM a GROUP BY 1, 2),
p AS (SELECT cluster, n, n / sum(n) OVER (PARTITION BY cluster) AS p FROM n),
e AS (SELECT cluster, sum(n) AS size, sum(-p * ln(p)) AS entropy FROM p GROUP BY 1)
SELECT round(sum(size * entropy) / sum(size), 6) AS entropy FROM e
""",
)
def weighted_cluster_entropy(spark, sf_dir):
    return rounded(weighted_entropy(_assigned(spark, sf_dir), "cluster", "label"), "entropy")


@query("mean_cluster_cost", f"WITH {_ASSIGNED} SELECT round(avg(dist), 6) AS cost FROM a")
def mean_cluster_cost(spark, sf_dir):
    return rounded(mean_cost(_assigned(spark, sf_dir)), "cost")


@query(
    "kth_largest_distance",
    f"WITH {_ASSIGNED} SELECT round(min(dist), 6) AS threshold FROM (SELECT dist FROM a ORDER BY dist DESC LIMIT 100)",
)
def kth_largest_distance(spark, sf_dir):
    return rounded(kth_largest(_assigned(spark, sf_dir), "dist", 100), "threshold")


@query(
    "anomalies_fixed_centers",
    f"""
WITH {_ASSIGNED},
t AS (SELECT min(dist) AS t FROM (SELECT dist FROM a ORDER BY dist DESC LIMIT 100))
SELECT vec_id, cluster, round(dist, 6) AS dist FROM a, t WHERE dist >= t.t
""",
)
def anomalies_fixed_centers(spark, sf_dir):
    found = at_least_kth(_assigned(spark, sf_dir), "dist", 100)
    return rounded(found.select("vec_id", "cluster", "dist"), "dist")


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_TEXTS = ["l_returnflag", "l_linestatus"]


def _as_they_lie(spark, sf_dir, *columns):
    """All lines without a layout, for feature stages: counts, and sums whose order does not show after rounding.

    Every stage's fit reads its rows anew; laid out, each of them would deal and sort the table again.
    """
    return table(spark, sf_dir, "lineitem").select(*columns)


@query("kmeans_default")
def kmeans_default(spark, sf_dir):
    lines = line_rows(spark, sf_dir, *_NUMBERS, "l_returnflag")
    return cluster(lines, numeric_features(lines, "l_returnflag")).label_counts(lines, "l_returnflag")


# One 0/1 feature has two distinct points, so the two clusters are its values.
@query(
    "kmeans_default_groups",
    """
SELECT CAST(l_linestatus = 'O' AS DOUBLE) AS center, l_returnflag AS label, count(*) AS n
FROM lineitem GROUP BY 1, 2
""",
)
def kmeans_default_groups(spark, sf_dir):
    lines = line_rows(spark, sf_dir, (F.col("l_linestatus") == "O").cast("int").alias("is_open"), "l_returnflag")
    found = cluster(lines, numeric_features(lines, "l_returnflag"))
    counts = found.label_counts(lines, "l_returnflag").withColumnRenamed("l_returnflag", "label")
    centered = join_centers(counts, found.centers(spark))
    return rounded(centered.select(F.col("center")[0].alias("center"), "label", "n"), "center")


@query(
    "kmeans_largest_labels",
    """
SELECT CAST(l_linestatus = 'O' AS DOUBLE) AS center, l_returnflag AS label, count(*) AS n
FROM lineitem GROUP BY 1, 2
""",
)
def kmeans_largest_labels(spark, sf_dir):
    lines = line_rows(spark, sf_dir, (F.col("l_linestatus") == "O").cast("int").alias("is_open"), "l_returnflag")
    found = cluster(lines, numeric_features(lines, "l_returnflag"))
    centered = join_centers(found.largest_labels(lines, "l_returnflag"), found.centers(spark))
    return rounded(centered.select(F.col("center")[0].alias("center"), F.col("l_returnflag").alias("label"), "n"), "center")


@query("kmeans_centers")
def kmeans_centers(spark, sf_dir):
    lines = line_rows(spark, sf_dir, *_NUMBERS)
    centers = cluster(lines, numeric_features(lines, ""), k=5).centers(spark)
    return centers.select("cluster", F.posexplode("center").alias("pos", "value"))


@query("kmeans_cost_default")
def kmeans_cost_default(spark, sf_dir):
    lines = line_rows(spark, sf_dir, *_NUMBERS)
    return cost_sweep(lines, numeric_features(lines, ""))


@query("kmeans_cost_tight")
def kmeans_cost_tight(spark, sf_dir):
    lines = line_rows(spark, sf_dir, *_NUMBERS)
    return cost_sweep(lines, numeric_features(lines, ""), **TIGHT)


@query("kmeans_cost_scaled")
def kmeans_cost_scaled(spark, sf_dir):
    features = fit_scaled_features(_as_they_lie(spark, sf_dir, *_NUMBERS), "")
    return cost_sweep(line_rows(spark, sf_dir, *_NUMBERS), features, vector="scaledFeatures", **TIGHT)


@query("kmeans_cost_onehot")
def kmeans_cost_onehot(spark, sf_dir):
    columns = [*_NUMBERS, *_TEXTS]
    features = fit_connection_features(_as_they_lie(spark, sf_dir, *columns), "", _TEXTS)
    return cost_sweep(line_rows(spark, sf_dir, *columns), features, vector="scaledFeatures", **TIGHT)


@query("kmeans_k_sweep")
def kmeans_k_sweep(spark, sf_dir):
    features = fit_scaled_features(_as_they_lie(spark, sf_dir, *_NUMBERS), "")
    return cost_sweep(line_rows(spark, sf_dir, *_NUMBERS), features, vector="scaledFeatures", **TIGHT)


@query("kmeans_entropy_sweep")
def kmeans_entropy_sweep(spark, sf_dir):
    columns = [*_NUMBERS, *_TEXTS, "l_linenumber"]
    features = fit_connection_features(_as_they_lie(spark, sf_dir, *columns), "l_linenumber", _TEXTS)
    return entropy_sweep(line_rows(spark, sf_dir, *columns), features, "l_linenumber", **TIGHT)


# Two strings have a few combinations and as many distinct points. With a
# cluster for each, the cost is zero and the entropy is that of the groups.
@query(
    "kmeans_groups_entropy",
    """
WITH n AS (SELECT l_returnflag, l_linestatus, l_linenumber, CAST(count(*) AS DOUBLE) AS n
           FROM lineitem GROUP BY 1, 2, 3),
p AS (SELECT n, n / sum(n) OVER (PARTITION BY l_returnflag, l_linestatus) AS p FROM n),
k AS (SELECT count(*) AS k FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem))
SELECT k.k AS k, 0.0::DOUBLE AS cost, round(sum(-n * ln(p)) / sum(n), 6) AS entropy FROM p, k GROUP BY 1
""",
)
def kmeans_groups_entropy(spark, sf_dir):
    lines = line_rows(spark, sf_dir, *_TEXTS, "l_linenumber")
    k = lines.select(*_TEXTS).distinct().count()
    features = PipelineModel([fit_one_hot(lines, _TEXTS), assembler([f"{c}_vec" for c in _TEXTS])])
    found = cluster(lines, features, k, initSteps=10)
    entropy, cost = found.entropy(lines, "l_linenumber"), found.cost(lines).select("cost").scalar()
    out = entropy.select(F.lit(k).cast("bigint").alias("k"), cost.alias("cost"), "entropy")
    return rounded(out, "cost", "entropy")


# With one feature far wider than the others the two clusters are its two
# groups, and centers, cost and anomalies follow from the group means.
_WIDE = {"status": "CAST(l_linestatus = 'O' AS INT) * 1000", "price": "l_extendedprice / 1000", "quantity": "l_quantity"}
_WIDE_GROUPS = f"""
w AS (SELECT l_orderkey, {select_sql(_WIDE)} FROM lineitem),
m AS (SELECT status, avg(price) AS price_mean, avg(quantity) AS quantity_mean FROM w GROUP BY 1),
a AS (SELECT w.*, price_mean, quantity_mean,
             (price - price_mean) * (price - price_mean) + (quantity - quantity_mean) * (quantity - quantity_mean) AS dist
      FROM w JOIN m USING (status))
"""


@query(
    "kmeans_two_groups_centers",
    f"""
WITH {_WIDE_GROUPS}
SELECT CAST(status AS DOUBLE) AS status, round(price_mean, 6) AS price, round(quantity_mean, 6) AS quantity FROM m
""",
)
def kmeans_two_groups_centers(spark, sf_dir):
    lines = line_rows(spark, sf_dir, *exprs(_WIDE))
    centers = cluster(lines, numeric_features(lines, ""), k=2).centers(spark)
    slots = [F.col("center")[i].alias(name) for i, name in enumerate(_WIDE)]
    return rounded(centers.select(*slots), *_WIDE)


@query("kmeans_two_groups_cost", f"WITH {_WIDE_GROUPS} SELECT CAST(2 AS INT) AS k, round(avg(dist), 6) AS score FROM a")
def kmeans_two_groups_cost(spark, sf_dir):
    lines = line_rows(spark, sf_dir, *exprs(_WIDE))
    return rounded(cost_sweep(lines, numeric_features(lines, ""), [2], **TIGHT), "score")


@query(
    "rows_with_centers",
    f"""
WITH {_WIDE_GROUPS}
SELECT l_orderkey, status, round(price_mean, 6) AS price_mean, round(quantity_mean, 6) AS quantity_mean,
       round(dist, 6) AS dist FROM a
""",
)
def rows_with_centers(spark, sf_dir):
    lines = line_rows(spark, sf_dir, "l_orderkey", *exprs(_WIDE))
    found = cluster(lines, numeric_features(lines, "", ["l_orderkey"]), k=2, **TIGHT).distances(lines, "center")
    slots = [F.col("center")[i].alias(f"{name}_mean") for i, name in enumerate(_WIDE) if name != "status"]
    return rounded(found.select("l_orderkey", "status", *slots, "dist"), "price_mean", "quantity_mean", "dist")


@query(
    "anomalies_two_groups",
    f"""
WITH {_WIDE_GROUPS},
t AS (SELECT min(dist) AS t FROM (SELECT dist FROM a ORDER BY dist DESC LIMIT 100))
SELECT l_orderkey, status, price, quantity, round(dist, 6) AS dist FROM a, t WHERE dist >= t.t
""",
)
def anomalies_two_groups(spark, sf_dir):
    lines = line_rows(spark, sf_dir, "l_orderkey", *exprs(_WIDE))
    found = cluster(lines, numeric_features(lines, "", ["l_orderkey"]), k=2, **TIGHT)
    return rounded(found.anomalies(lines, 100).drop("cluster"), "dist")


# Scaled columns all have the same spread. Four that say the same outweigh the two others, so that
# the two clusters are the two line statuses, where each scaled number varies around its mean.
_STATUS = {f"status_{i}": "l_linestatus" for i in range(4)}
_STATUS_NUMBERS = {f"status_{i}": "CAST(l_linestatus = 'O' AS INT)" for i in range(4)}
_SMALL = {"quantity": "l_quantity", "discount": "l_discount"}
_STATUS_COST = """
WITH a AS (SELECT stddev_samp(l_quantity) AS q, stddev_samp(l_discount) AS d, CAST(count(*) AS DOUBLE) AS n FROM lineitem),
g AS (SELECT count(*) * var_pop(l_quantity) AS q, count(*) * var_pop(l_discount) AS d FROM lineitem GROUP BY l_linestatus)
SELECT CAST(2 AS INT) AS k, round(sum(g.q / (a.q * a.q) + g.d / (a.d * a.d)) / max(a.n), 6) AS score FROM g, a
"""


@query("kmeans_scaled_two_groups", _STATUS_COST)
def kmeans_scaled_two_groups(spark, sf_dir):
    columns = exprs(_STATUS_NUMBERS | _SMALL)
    features = fit_scaled_features(_as_they_lie(spark, sf_dir, *columns), "")
    found = cost_sweep(line_rows(spark, sf_dir, *columns), features, [2], "scaledFeatures", initSteps=10, **TIGHT)
    return rounded(found, "score")


@query("kmeans_onehot_two_groups", _STATUS_COST)
def kmeans_onehot_two_groups(spark, sf_dir):
    columns = exprs(_STATUS | _SMALL)
    features = fit_connection_features(_as_they_lie(spark, sf_dir, *columns), "", list(_STATUS))
    return rounded(cost_sweep(line_rows(spark, sf_dir, *columns), features, [2], "scaledFeatures", initSteps=10, **TIGHT), "score")


@query(
    "kmeans_entropy_two_groups",
    """
WITH n AS (SELECT l_linestatus, l_linenumber, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY 1, 2),
p AS (SELECT n, n / sum(n) OVER (PARTITION BY l_linestatus) AS p FROM n)
SELECT CAST(2 AS INT) AS k, round(sum(-n * ln(p)) / sum(n), 6) AS score FROM p
""",
)
def kmeans_entropy_two_groups(spark, sf_dir):
    columns = [*exprs(_STATUS | _SMALL), "l_linenumber"]
    features = fit_connection_features(_as_they_lie(spark, sf_dir, *columns), "l_linenumber", list(_STATUS))
    lines = line_rows(spark, sf_dir, *columns)
    return rounded(entropy_sweep(lines, features, "l_linenumber", [2], initSteps=10, **TIGHT), "score")


@query("anomalies")
def anomalies(spark, sf_dir):
    lines = line_rows(spark, sf_dir, "l_orderkey", *_NUMBERS, *_TEXTS, "l_linenumber")
    _, found = detect_anomalies(lines, "l_linenumber", _TEXTS, drop=["l_orderkey"])
    return found
