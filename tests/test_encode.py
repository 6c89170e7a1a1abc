import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import encode, rank


@pytest.fixture(scope="module")
def categories(spark):
    """Ties, nulls, the text NA, the empty string."""
    values = ["b", "b", "a", "a", "NA", "NA", "NA", "", "?", None, None]
    other = ["x", "y", "y", "x", "x", "z", "y", "y", "x", "x", "y"]
    return spark.createDataFrame(list(enumerate(zip(values, other))), "id long, v struct<_1:string,_2:string>").select(
        "id", F.col("v._1").alias("s"), F.col("v._2").alias("t")
    )


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("invalid", ["skip", "keep"])
@pytest.mark.parametrize("limit", [100, 0])
def test_index_equals_string_indexer(categories, invalid, limit):
    stage = StringIndexer(inputCols=["s", "t"], outputCols=["s_index", "t_index"], handleInvalid=invalid)
    wanted = stage.fit(categories).transform(categories)
    got = encode.index_table(categories, ["s", "t"], invalid=invalid, max_labels=limit)
    assert got.columns == wanted.columns
    assert _rows(got) == _rows(wanted)


@pytest.mark.parametrize("limit", [100, 0])
def test_null_category_is_an_error_when_asked(categories, limit):
    with pytest.raises(Exception, match="(?i)null"):
        encode.index_table(categories, ["s"], invalid="error", max_labels=limit).collect()


def test_wide_column_splits_hot_and_cold_values(spark, monkeypatch):
    monkeypatch.setattr(encode, "HEAD_ROWS", 3)
    # one value holds a third of the rows
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 700)).alias("s")
    )
    wanted = StringIndexer(inputCol="s", outputCol="s_index").fit(df).transform(df)
    got = encode.index_table(df, ["s"], max_labels=10)
    assert _rows(got) == _rows(wanted)
    assert got.where("s = 'hot'").select("s_index").distinct().collect() == [(0.0,)]


def test_model_indexer_refuses_wide_columns(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("s"))
    with pytest.raises(encode.TooManyCategories):
        encode.fit_indexer(df, ["s"], max_labels=49)
    assert encode.fit_indexer(df, ["s"], max_labels=50).transform(df).select("s_index").distinct().count() == 50


def test_one_hot_drops_the_last_category(mixed_net):
    encoded = encode.fit_one_hot(mixed_net, ["protocol_type", "service"]).transform(mixed_net)
    sums = encoded.select(
        "protocol_type", F.aggregate(vector_to_array("protocol_type_vec"), F.lit(0.0), lambda a, b: a + b).alias("n")
    ).distinct()
    got = {r.protocol_type: r.n for r in sums.collect()}
    assert sorted(got.values()) == [0.0, 1.0, 1.0] and got["tcp"] == 1.0


def test_scaling_keeps_zero_for_a_constant(mixed_net):
    assembled = encode.assembler(["a", "c"]).transform(mixed_net)
    scaled = encode.scaler("features", "s").fit(assembled).transform(assembled)
    sd = mixed_net.agg(F.stddev_samp("a")).first()[0]
    for row in scaled.limit(20).collect():
        assert row.s[0] == pytest.approx(row.a / sd) and row.s[1] == 0.0


def test_assembly_fails_on_null(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        encode.assembler(["a", "b"]).transform(df).collect()


def test_unencode_gives_minus_one_without_a_set_column(spark):
    df = spark.createDataFrame([(1, 0, 1, 0, 5.0), (2, 0, 0, 0, 6.0), (3, 1, 0, 1, 7.0)], "id int, a0 int, a1 int, b0 int, z double")
    got = encode.unencode_one_hot(df, {"a": ["a0", "a1"], "b": ["b0"]})
    assert got.columns == ["id", "z", "a", "b"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, 5.0, 1.0, -1.0), (2, 6.0, -1.0, -1.0), (3, 7.0, 0.0, 0.0)]


def test_recoding_puts_zero_first(spark):
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate([-2.0, 0.0, 3.0, 0.0])], "v double, w double")
    assembled = encode.assembler(["v", "w"]).transform(df)
    recoded = encode.vector_indexer("features", "x", 3).fit(assembled).transform(assembled)
    got = {(r.v, r.w): (r.x[0], r.x[1]) for r in recoded.collect()}
    assert got[(0.0, 1.0)][0] == 0.0 and {got[k][0] for k in got} == {0.0, 1.0, 2.0}
    assert all(x == w for (_, w), (_, x) in got.items())  # four values stay as they are


def test_column_lists_by_type(mixed_house):
    assert encode.string_columns(mixed_house) == ["Zone", "Style", "Roof"]
    assert encode.integer_columns(mixed_house)[0] == "Id" and len(encode.integer_columns(mixed_house)) == 6
    assert "Zone" not in encode.drop_nonnumeric(mixed_house).columns


@pytest.mark.parametrize("k", [1, 7, 500, 2000])
def test_kth_largest_both_ways(spark, monkeypatch, k):
    df = spark.range(1000).select(((F.col("id") * 37) % 101).cast("double").alias("d"))
    values = sorted((r.d for r in df.collect()), reverse=True)
    wanted = values[min(k, len(values)) - 1]
    assert rank.kth_largest(df, "d", k).first().threshold == wanted
    monkeypatch.setattr(rank, "TOP_K_ROWS", 0)
    assert rank.kth_largest(df, "d", k).first().threshold == wanted


def test_total_before_is_a_running_sum(spark):
    df = spark.range(200).select("id", (F.col("id") % 4 + 1).alias("w"))
    got = {r.id: r["rank"] for r in rank.total_before(df, "w", F.desc("id")).collect()}
    total = 0
    for i in reversed(range(200)):
        assert got[i] == total
        total += i % 4 + 1


@pytest.mark.parametrize("invalid", ["skip", "keep", "error"])
def test_wide_index_with_clashing_names(spark, invalid):
    rows = [("a", "r1", "c1", 1)] * 5 + [("b", "r2", "c1", 2)] * 3 + [("c", "r2", "c2", 3)]
    if invalid != "error":
        rows += [(None, "r1", "c1", 4)]
    df = spark.createDataFrame(rows, "value string, rank string, center string, _code_hot int")
    columns = ["value", "rank", "center"]
    few = encode.index_table(df, columns, invalid=invalid)
    wide = encode.index_table(df, columns, invalid=invalid, max_labels=0)
    assert wide.columns == few.columns
    assert sorted(map(str, wide.collect())) == sorted(map(str, few.collect()))


def test_wide_index_reads_the_rows_once(spark, tmp_path):
    df = spark.range(50).select(*[(F.col("id") % n).cast("string").alias(f"c{n}") for n in (3, 5, 7, 11)])
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))

    def leaves(n):
        out = encode.index_table(df, df.columns[:n], max_labels=0)
        return out._jdf.queryExecution().optimizedPlan().toString().count("parquet")

    assert leaves(1) == leaves(2) == leaves(4)


def test_wide_index_stops_at_nulls(spark):
    df = spark.createDataFrame([("a",), (None,)], "value string")
    with pytest.raises(Exception, match="null category"):
        encode.index_table(df, ["value"], invalid="error", max_labels=0).collect()


def test_labels_of_all_columns_share_one_bound(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("x"), (F.col("id") + 1).cast("string").alias("y"))
    with pytest.raises(encode.TooManyCategories):
        encode.fit_indexer(df, ["x", "y"], max_labels=40)
