"""Sampled forests fitted in parts."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from millrace.catalog.base import FULL_PARTITION, full_layout, layout
from millrace.plans import forests, trees


@pytest.fixture(scope="module")
def rows(spark):
    x = spark.range(600).select(
        (F.col("id") % 7).cast("double").alias("a"), (F.xxhash64("id") % 50).cast("double").alias("b"), F.lower(F.hex(F.col("id") % 3)).alias("c")
    )
    return x.withColumn("label", (F.col("a") + F.col("b") > 3).cast("double")).repartition(1).sortWithinPartitions("a", "b", "c")


def test_parts_follow_the_rows(spark):
    forest = RandomForestClassifier(numTrees=100)
    assert forests.parts_of(forest, 1_000) == [100]  # few rows: one fit, as before
    many = forests.parts_of(forest, 540_000)
    assert len(many) == forests.FITS and sum(many) == 100 and max(many) - min(many) <= 1
    assert len(forests.parts_of(forest, 5 << 20)) == forests.FITS // 5
    assert forests.parts_of(forest, 36_000_000) == [100]
    assert forests.parts_of(RandomForestClassifier(numTrees=3), 540_000) == [1, 1, 1]
    assert forests.is_sampled(forest) and not forests.is_sampled(RandomForestRegressor(bootstrap=False))


def test_rows_of_a_forest_fill_their_partitions(spark):
    assert full_layout(spark.range(600_000)) == 1 and layout(spark.range(600_000)) == 19
    assert full_layout(spark.range(3 * FULL_PARTITION + 1)) == 4 and full_layout(spark.range(0)) == 1


@pytest.mark.parametrize("values", [False, True])
def test_parts_make_one_forest(spark, rows, values, monkeypatch, tmp_path):
    def fitted():
        if values:
            return trees.random_forest_regressor(rows, rows, "label", numTrees=7, maxDepth=4)
        return trees.random_forest_classifier(rows.drop("c"), rows, "label", numTrees=7, maxDepth=4)

    monkeypatch.setattr(forests, "FEW_ROWS", 0)
    monkeypatch.setattr(forests, "FITS", 3)
    sizes = []
    plain = forests._joined
    monkeypatch.setattr(forests, "_joined", lambda models: sizes.append([m.getNumTrees for m in models]) or plain(models))
    found = fitted()
    model = found.model.stages[-1]
    assert sizes == [[3, 2, 2]]
    assert model.getNumTrees == 7 and len(model.trees) == 7 and model.getMaxDepth() == 4 and model.getLabelCol() == "label"
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) == 7  # no part draws what another one draws
    assert abs(sum(model.featureImportances.toArray()) - 1) < 1e-9
    got = [r.prediction for r in found.predictions.select("prediction").collect()]
    vectors = [r[0] for r in found.model.transform(rows).select(model.getFeaturesCol()).collect()]
    for vector, prediction in list(zip(vectors, got))[::60]:
        if values:
            assert prediction == pytest.approx(sum(t.predict(vector) for t in model.trees) / 7)
        else:
            shares = [t.predictRaw(vector).toArray() for t in model.trees]
            assert prediction == sum(s / s.sum() for s in shares).argmax()
    # the same again, and from its saved form
    assert [r.prediction for r in fitted().predictions.select("prediction").collect()] == got
    found.model.write().overwrite().save(str(tmp_path / "forest"))
    again = PipelineModel.load(str(tmp_path / "forest"))
    assert [r.prediction for r in again.transform(rows).select("prediction").collect()] == got
