import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.catalog.base import partitions_for
from millrace.operators import cluster as ops
from millrace.operators.counts import cluster_label_counts, largest_cluster_labels, weighted_entropy
from millrace.plans.clustering import TIGHT, assigned_by_all, cluster, cost_sweep, entropy_sweep, k_means
from millrace.plans.features import fit_connection_features, fit_scaled_features, numeric_features
from millrace.plans.workflows import detect_anomalies


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    centers = [(i * 3, rng.normal(size=4).tolist()) for i in range(9)]
    return (
        spark.createDataFrame(rows, "id long, v array<double>"),
        spark.createDataFrame(centers, "cluster int, center array<double>"),
        rows, centers,
    )


@pytest.mark.parametrize("limit", [None, 70])
def test_nearest_center_by_brute_force(points, monkeypatch, limit):
    df, centers, rows, given = points
    if limit:  # two centers per block
        monkeypatch.setattr(ops, "BROADCAST_BYTES", limit)
    got = {r.id: (r.cluster, r.dist) for r in ops.nearest_center(df, "v", centers).collect()}
    assert len(got) == len(rows)
    for i, v in rows:
        d, c = min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in given)
        assert got[i][0] == c and got[i][1] == pytest.approx(d)


def test_nearest_center_tie_goes_to_the_lower_id(spark):
    df = spark.createDataFrame([(1, [0.0])], "id int, v array<double>")
    centers = spark.createDataFrame([(5, [1.0]), (2, [-1.0])], "cluster int, center array<double>")
    assert ops.nearest_center(df, "v", centers).first().cluster == 2


@pytest.mark.parametrize("limit", [None, 1])
def test_distance_to_own_center_by_either_join(points, monkeypatch, limit):
    df, centers, rows, given = points
    if limit:
        monkeypatch.setattr(ops, "BROADCAST_BYTES", limit)
    own = df.withColumn("cluster", ((F.col("id") % 9) * 3).cast("int"))
    got = {r.id: r.dist for r in ops.distance_to_center(own, centers, "v").collect()}
    by_id = dict(given)
    assert len(got) == len(rows)
    for i, v in rows:
        assert got[i] == pytest.approx(sum((a - b) ** 2 for a, b in zip(v, by_id[i % 9 * 3])))


def test_at_least_kth_keeps_ties(spark):
    df = spark.createDataFrame([(i, float(d)) for i, d in enumerate([5, 4, 4, 4, 1])], "id int, d double")
    assert sorted(r.id for r in ops.at_least_kth(df, "d", 2).collect()) == [0, 1, 2, 3]


def test_group_centers_are_means(points):
    df, _, rows, _ = points
    got = ops.group_centers(df.withColumn("g", F.col("id") % 2), "g", "v").collect()
    for r in got:
        wanted = np.mean([v for i, v in rows if i % 2 == r.cluster], axis=0)
        assert np.allclose(r.center, wanted)


def test_k_means_puts_each_row_at_its_nearest_center(blobs_outliers):
    features = numeric_features(blobs_outliers, "label", ["id"])
    found = cluster(blobs_outliers, features, 3)
    rows = features.transform(blobs_outliers).select("id", vector_to_array("features").alias("v"))
    near = ops.nearest_center(rows, "v", found.centers(blobs_outliers.sparkSession))
    assigned = {r.id: r.cluster for r in found.assign(blobs_outliers).collect()}
    assert {r.id: r.cluster for r in near.collect()} == assigned
    counts = cluster_label_counts(found.assign(blobs_outliers)).collect()
    assert sum(r.n for r in counts) == 305 and len(counts) == 3
    # converged, so the training cost belongs to the final centers
    total = found.distances(blobs_outliers).agg(F.sum("dist")).first()[0]
    assert total == pytest.approx(found.model.summary.trainingCost, rel=1e-9)
    assert found.cost(blobs_outliers).first().cost == pytest.approx(total / 305)


def test_anomalies_are_the_planted_rows(blobs_outliers):
    found = cluster(blobs_outliers, numeric_features(blobs_outliers, "label", ["id"]), 3, **TIGHT)
    rows = found.anomalies(blobs_outliers, 5)
    assert rows.columns == [*blobs_outliers.columns, "cluster", "dist"]
    assert sorted(r.id for r in rows.collect()) == [300, 301, 302, 303, 304]


def test_cost_falls_with_k_and_entropy_reaches_zero(mixed_net):
    numbers = mixed_net.select("a", "b", "label")
    costs = {r.k: r.score for r in cost_sweep(numbers, fit_scaled_features(numbers, "label"), [2, 10, 40], "scaledFeatures", **TIGHT).collect()}
    assert costs[2] > costs[10] > costs[40]
    # the label is the protocol, so clusters over its one-hot columns are pure
    texts = mixed_net.select("protocol_type", "label")
    features = fit_connection_features(texts, "label", ["protocol_type"])
    scores = entropy_sweep(texts, features, "label", [3], initSteps=10).collect()
    assert scores[0].score == pytest.approx(0.0, abs=1e-9)


def test_entropy_of_one_cluster_is_that_of_the_label(mixed_net):
    from millrace.operators.counts import label_entropy

    one = mixed_net.withColumn("cluster", F.lit(0))
    assert weighted_entropy(one, "cluster", "label").first().entropy == pytest.approx(
        label_entropy(one, "cluster", "label").first().entropy
    )


def test_detect_anomalies_on_mixed_records(mixed_net):
    found, rows = detect_anomalies(mixed_net, drop=["id"], k=6, top=10)
    assert rows.columns[: len(mixed_net.columns)] == mixed_net.columns
    assert rows.count() >= 10
    assert found.vector == "scaledFeatures"
    # schema order: numbers, then the one-hot strings; the constant scales to zero
    first = found.features.transform(mixed_net).first()
    assert first.scaledFeatures.size == 3 + 2 + 2 + 1 and first.scaledFeatures[2] == 0.0


def test_k_means_settings():
    stage = k_means(5, "v", **TIGHT)
    assert (stage.getK(), stage.getMaxIter(), stage.getTol(), stage.getInitSteps()) == (5, 40, 1e-5, 2)


def test_odd_vectors_and_missing_centers(spark):
    rows = [(1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "id int, center array<double>")
    centers = spark.createDataFrame([(0, [0.0, 1.0]), (1, [9.0, 8.0])], "cluster int, center array<double>")
    got = {r.id: (r.cluster, r.dist) for r in ops.nearest_center(df, "center", centers).collect()}
    assert got == {1: (0, 1.0), 2: (None, None), 3: (None, None), 4: (1, 1.0)}
    with pytest.raises(ValueError, match="no centers"):
        ops.nearest_center(df, "center", centers.limit(0))
    own = df.withColumn("cluster", F.when(F.col("id") < 4, F.col("id") - 1))
    far = {r.id: r.dist for r in ops.distance_to_center(own, centers, "center").collect()}
    assert far[1] == 1.0 and far[2] is None and far[4] is None and len(far) == 4


def test_largest_labels_of_each_cluster(spark):
    df = spark.createDataFrame([(0, "a")] * 3 + [(0, "b")] * 5 + [(1, "a")] * 2, "cluster int, label string")
    got = [tuple(r) for r in largest_cluster_labels(df, top=2).collect()]
    assert got == [(0, "b", 5), (0, "a", 3)]


def test_all_models_of_a_sweep_are_scored_in_one_scan(mixed_net):
    rows = fit_scaled_features(mixed_net.select("a", "b"), "").transform(mixed_net).select("scaledFeatures", "label").persist()
    rows.count()
    models = [k_means(k, "scaledFeatures").fit(rows) for k in (2, 5, 3)]
    all_of = assigned_by_all(rows, models)
    assert all_of._jdf.queryExecution().executedPlan().toString().count("InMemoryTableScan") == 1
    assert all_of.count() == 3 * rows.count()
    for i, model in enumerate(models):
        alone = model.transform(rows).groupBy("cluster").count().collect()
        assert sorted(map(tuple, alone)) == sorted(map(tuple, all_of.where(F.col("_model") == i).groupBy("cluster").count().collect()))


def test_sweeps_score_as_single_models_do(mixed_net):
    numbers = mixed_net.select("a", "b", "label")
    features = fit_scaled_features(numbers, "label")
    costs = {r.k: r.score for r in cost_sweep(numbers, features, [4, 2], "scaledFeatures").collect()}
    mixed = {r.k: r.score for r in entropy_sweep(numbers, features, "label", [4, 2]).collect()}
    for k in (2, 4):
        one = cluster(numbers, features, k, "scaledFeatures")
        assert costs[k] == pytest.approx(one.cost(numbers).first().cost, abs=1e-9)
        assert mixed[k] == pytest.approx(one.entropy(numbers, "label").first().entropy, abs=1e-9)


def test_a_sweep_of_one_k_twice(mixed_net):
    numbers = mixed_net.select("a", "b")
    rows = cost_sweep(numbers, numeric_features(numbers, ""), [3, 3]).collect()
    assert [r.k for r in rows] == [3, 3] and rows[0].score == pytest.approx(rows[1].score)


def test_rows_carry_their_own_center(blobs_outliers):
    found = cluster(blobs_outliers, numeric_features(blobs_outliers, "label", ["id"]), 3)
    centers = found.model.clusterCenters()
    rows = found.distances(blobs_outliers, "center").collect()
    assert len(rows) == 305
    for r in rows:
        assert r.center == pytest.approx(list(centers[r.cluster]))
        assert r.dist == pytest.approx((r.x - r.center[0]) ** 2 + (r.y - r.center[1]) ** 2)


def test_a_larger_fit_does_not_take_as_many_more_tasks():
    """Each partition is a task or two in every step, and each task reports to the driver."""
    assert partitions_for(1) == 1 and partitions_for(60_000) == 2
    assert partitions_for(36_000_000) == partitions_for(3_600_000) == 48
    assert partitions_for(216_000_000) <= 6 * 48


def test_blocks_of_a_fit_stay_in_the_cache_of_a_core():
    assert k_means(100, "features").getMaxBlockSizeInMB() <= 0.02
