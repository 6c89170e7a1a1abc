"""Fitted models do not depend on the number of cores."""

import os
import subprocess
import sys

import pytest

from millrace.catalog import QUERIES, clusters

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
from check import session
from millrace.catalog import QUERIES
spark = session(sys.argv[1])
for name in ("kmeans_cost_default", "random_forest_classifier"):
    print("ROW", name, sorted(map(tuple, QUERIES[name](spark, sys.argv[2]).collect())))
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_same_rows_under_two_core_counts():
    found = []
    for cores in ("2", "4"):
        out = subprocess.run(
            [sys.executable, "-c", SCRIPT, cores, SF], cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT}, capture_output=True, text=True, check=True
        )
        found.append([line for line in out.stdout.splitlines() if line.startswith("ROW")])
    assert len(found[0]) == 2 and found[0] == found[1]


@pytest.mark.parametrize("name", ["kmeans_scaled_two_groups", "kmeans_onehot_two_groups", "kmeans_entropy_two_groups"])
def test_feature_stages_are_fitted_without_a_shuffle_of_the_table(spark, tmp_path, monkeypatch, name):
    rows = [(i, i, i, i % 3, float(i % 7), i % 5 / 100, "OF"[i % 2]) for i in range(60)]
    kinds = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_linestatus string"
    spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    plans = []

    def seen(fit):
        def run(lines, *args):
            plans.append(lines._jdf.queryExecution().optimizedPlan().toString())
            return fit(lines, *args)

        return run

    for fit in ("fit_scaled_features", "fit_connection_features"):
        monkeypatch.setattr(clusters, fit, seen(getattr(clusters, fit)))
    assert QUERIES[name](spark, str(tmp_path)).first()["k"] == 2
    assert len(plans) == 1 and "Repartition" not in plans[0] and "Sort" not in plans[0]
