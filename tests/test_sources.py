from pyspark.sql import functions as F
import pytest

from millrace.operators.inspect import schema_report
from millrace.operators.rank import preview
from millrace.session import cut_lineage, held, laid_out, shared_dir, shared_path
from millrace.sources import (
    CONNECTION_COLUMNS,
    bad_apart,
    cover_columns,
    load_binary_numeric,
    load_categories,
    load_connections,
    load_cover,
    load_mixed,
    load_targets,
    rows_like,
    scan_csv,
    write_csv,
)


def test_csv_without_header_gets_names_by_position(blobs_outliers, spark):
    path = write_csv(blobs_outliers, shared_path(spark, "t"), header=False)
    df = scan_csv(spark, path, header=False, names=["i", "p", "q", "c"])
    assert df.dtypes == [("i", "int"), ("p", "double"), ("q", "double"), ("c", "string")]
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, blobs_outliers.collect()))


def test_csv_with_header(binary_numeric, spark):
    path = write_csv(binary_numeric, shared_path(spark, "t"))
    df = load_binary_numeric(spark, path)
    assert df.columns == binary_numeric.columns and df.count() == 400
    typed = load_binary_numeric(spark, path, binary_numeric.schema)
    assert typed.dtypes == binary_numeric.dtypes
    assert typed.exceptAll(binary_numeric).count() == 0


def test_cover_table_has_55_columns(spark):
    names = cover_columns()
    assert len(names) == 55 and names[10] == "Wilderness_Area_0" and names[53] == "Soil_Type_39"
    rows = [tuple(range(54)) + (i % 7 + 1,) for i in range(20)]
    path = write_csv(spark.createDataFrame(rows, names), shared_path(spark, "t"), header=False)
    df = load_cover(spark, path)
    assert df.columns == names and dict(df.dtypes)["Cover_Type"] == "double"


def test_connections_have_42_columns(spark):
    assert len(CONNECTION_COLUMNS) == 42
    row = tuple("tcp" if c in ("protocol_type", "service", "flag", "label") else i for i, c in enumerate(CONNECTION_COLUMNS))
    path = write_csv(spark.createDataFrame([row], CONNECTION_COLUMNS), shared_path(spark, "t"), header=False)
    df = load_connections(spark, path)
    assert df.columns == CONNECTION_COLUMNS
    assert [c for c, t in df.dtypes if t == "string"] == ["protocol_type", "service", "flag", "label"]


def test_categories_keep_index_columns_only(mixed_net, spark):
    path = write_csv(mixed_net.select("protocol_type", "service"), shared_path(spark, "t"))
    df = load_categories(spark, path)
    assert df.columns == ["protocol_type_index", "service_index"] and df.count() == 400


def test_targets_lose_id_and_raw_target(multi_class, spark):
    df = load_targets(spark, write_csv(multi_class, shared_path(spark, "t")))
    assert df.columns == [f"f{j}" for j in range(6)] + ["target_index"]
    assert {r.target_index for r in df.select("target_index").distinct().collect()} == {0.0, 1.0, 2.0, 3.0}


def test_mixed_table_gets_both_vectors(mixed_house, spark):
    df = load_mixed(spark, write_csv(mixed_house, shared_path(spark, "t")))
    row = df.orderBy("Id").first()
    assert row.features.size == 7
    quality = row.features[0]
    assert row.indexedFeatures[0] == quality - 1  # ten values, recoded from 0
    assert row.indexedFeatures[1] == row.features[1]  # many areas, kept


def test_schema_and_preview(blobs_outliers):
    assert [tuple(r) for r in schema_report(blobs_outliers).collect()][0] == (0, "id", "bigint")
    assert [r.id for r in preview(blobs_outliers, 3, "id").collect()] == [0, 1, 2]


def test_session_helpers(spark):
    assert shared_path(spark, "a").startswith(shared_dir(spark))
    assert shared_path(spark, "a") != shared_path(spark, "a")
    df = spark.range(10).repartition(2)
    assert cut_lineage(df).count() == 10
    with pytest.raises(RuntimeError), held(df) as kept:
        assert kept.is_cached
        raise RuntimeError
    assert not df.is_cached


def test_layout_does_not_follow_the_splits(spark):
    rows = spark.range(500).withColumn("x", F.col("id") % 7)
    layouts = [
        laid_out(df, 6, "id").select("id", F.spark_partition_id().alias("p")).collect()
        for df in (rows.coalesce(1), rows.repartition(9), rows.repartition(4, "x"))
    ]
    assert layouts[0] == layouts[1] == layouts[2] and {r.p for r in layouts[0]} == set(range(6))


@pytest.mark.parametrize("header", [True, False])
def test_bad_records_are_kept_apart(spark, header):
    lines = ["1,a,1.5", "x2,b,2.5", "3,c", "4,d,4.5,more", "5,,", "6,f,zero"]
    path = shared_path(spark, "t")
    spark.createDataFrame([(t,) for t in (["id,name,x"] if header else []) + lines], "value string").coalesce(1).write.text(path)
    df = scan_csv(spark, path, header=header, schema="id int, name string, x double", bad_records="line")
    assert df.columns == ["id", "name", "x", "line"]
    good, bad = bad_apart(df, "line")
    assert sorted(map(tuple, good.collect())) == [(1, "a", 1.5), (5, None, None)]
    assert sorted(r.line for r in bad.select("line").collect()) == sorted([lines[1], lines[2], lines[3], lines[5]])
    # the same lines are bad whichever columns are read
    assert (good.count(), bad.count()) == (2, 4) and good.select("name").count() == 2
    assert {r.name for r in bad.collect()} == {"b", "c", "d", "f"}


def test_bad_records_need_a_schema_and_a_free_name(spark):
    with pytest.raises(ValueError, match="schema"):
        scan_csv(spark, "nowhere", bad_records="line")
    with pytest.raises(ValueError, match="line"):
        scan_csv(spark, "nowhere", schema="line string", bad_records="line")


def test_no_bad_records(spark, blobs_outliers):
    path = write_csv(blobs_outliers, shared_path(spark, "t"), header=False)
    df = scan_csv(spark, path, header=False, schema=blobs_outliers.schema, names=["i", "p", "q", "c"], bad_records="line")
    good, bad = bad_apart(df, "line")
    assert bad.isEmpty() and good.columns == ["i", "p", "q", "c"] and good.count() == 305


def test_rows_for_scoring_have_the_types_of_the_table(spark, blobs_outliers):
    rows = rows_like(spark, [(1, 2.0)], blobs_outliers, ["id", "x"])
    assert rows.dtypes == [("id", "bigint"), ("x", "double")] and rows.collect() == [(1, 2.0)]
    assert rows_like(spark, [], blobs_outliers, ["label"]).dtypes == [("label", "string")]
