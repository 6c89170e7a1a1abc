"""Encoding, assembly and scaling; vectors come out as one column per slot."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import query, rounded, table
from millrace.functions import vector_slots
from millrace.operators.encode import (
    assembler,
    fit_one_hot,
    index_table,
    scaler,
    unencode_one_hot,
    vector_indexer,
)
from millrace.plans.features import fit_mixed_features

_EVENT_INDEX = """
t AS (SELECT event_type AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS i
      FROM e WHERE event_type IS NOT NULL GROUP BY 1)
"""
_ALL_EVENTS = "WITH e AS (SELECT event_id, event_type FROM events), " + _EVENT_INDEX


@query(
    "string_index",
    _ALL_EVENTS + "SELECT event_id, t.i AS event_type_index FROM e JOIN t ON e.event_type = t.v",
)
def string_index(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return index_table(events, ["event_type"], invalid="error").drop("event_type")


@query(
    "string_index_wide",
    """
WITH t AS (SELECT user_id AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(user_id AS VARCHAR)) - 1 AS DOUBLE) AS i
           FROM events GROUP BY 1)
SELECT event_id, value, t.i AS user_id_index FROM events JOIN t ON events.user_id = t.v
""",
)
def string_index_wide(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return index_table(events, ["user_id"], max_labels=5).drop("user_id")


# events whose type counts as unknown, to have nulls to skip
_UNKNOWN = "CASE WHEN value < 5 THEN NULL ELSE event_type END"


@query(
    "string_index_skip",
    f"WITH e AS (SELECT event_id, {_UNKNOWN} AS event_type FROM events), "
    + _EVENT_INDEX
    + "SELECT event_id, t.i AS event_type_index FROM e JOIN t ON e.event_type = t.v",
)
def string_index_skip(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.expr(_UNKNOWN).alias("event_type"))
    return index_table(events, ["event_type"], invalid="skip").drop("event_type")


_ONE_HOT_SQL = (
    _ALL_EVENTS
    + "SELECT event_id, "
    + ", ".join(f"CASE WHEN t.i = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v_{i}" for i in range(4))
    + " FROM e JOIN t ON e.event_type = t.v"
)


@query("one_hot", _ONE_HOT_SQL)
def one_hot(spark, sf_dir):
    from pyspark.ml.feature import OneHotEncoder

    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    indexed = index_table(events, ["event_type"])
    encoder = OneHotEncoder(inputCols=["event_type_index"], outputCols=["vec"], dropLast=True)
    return encoder.fit(indexed).transform(indexed).select("event_id", *vector_slots("vec", 4, "v_"))


@query("index_and_one_hot", _ONE_HOT_SQL)
def index_and_one_hot(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    encoded = fit_one_hot(events, ["event_type"]).transform(events)
    return encoded.select("event_id", *vector_slots("event_type_vec", 4, "v_"))


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "assemble_features",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS f_{i}" for i, c in enumerate([*_NUMBERS, "l_linenumber"]))
    + " FROM lineitem",
)
def assemble_features(spark, sf_dir):
    columns = [*_NUMBERS, "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *columns)
    assembled = assembler(columns).transform(lines)
    return assembled.select("l_orderkey", "l_linenumber", *vector_slots("features", 5, "f_"))


@query(
    "standard_scale",
    "WITH s AS (SELECT "
    + ", ".join(f"stddev_samp({c}) AS s{i}" for i, c in enumerate(_NUMBERS))
    + " FROM lineitem) SELECT l_orderkey, "
    + ", ".join(f"round({c} / s{i}, 6) AS f_{i}" for i, c in enumerate(_NUMBERS))
    + " FROM lineitem, s",
)
def standard_scale(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *_NUMBERS)
    assembled = assembler(_NUMBERS).transform(lines)
    scaled = scaler("features", "scaled").fit(assembled).transform(assembled)
    out = scaled.select("l_orderkey", *vector_slots("scaled", 4, "f_"))
    return rounded(out, *[f"f_{i}" for i in range(4)])


@query(
    "unencode_one_hot",
    """
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN l_linenumber = 7 THEN -1 ELSE l_linenumber - 1 END AS DOUBLE) AS line_code,
       CAST(CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1 ELSE 2 END AS DOUBLE) AS flag_code
FROM lineitem
""",
)
def unencode_one_hot_lineitem(spark, sf_dir):
    # six columns for seven lines: the seventh has none set
    lines = [(F.col("l_linenumber") == i + 1).cast("int").alias(f"line_{i}") for i in range(6)]
    flags = [(F.col("l_returnflag") == f).cast("int").alias(f"flag_{f}") for f in "ANR"]
    encoded = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *lines, *flags)
    return unencode_one_hot(
        encoded,
        {"line_code": [f"line_{i}" for i in range(6)], "flag_code": [f"flag_{f}" for f in "ANR"]},
    )


@query(
    "vector_index",
    """
WITH d AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS i, count(*) OVER () AS n
           FROM (SELECT DISTINCT p_size AS v FROM part))
SELECT p_partkey, CASE WHEN d.n <= 60 THEN d.i ELSE p_size END AS f_0, p_retailprice AS f_1
FROM part JOIN d ON p_size = d.v
""",
)
def vector_index(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    assembled = assembler(["p_size", "p_retailprice"]).transform(part)
    recoded = vector_indexer("features", "indexed", 60).fit(assembled).transform(assembled)
    return recoded.select("p_partkey", *vector_slots("indexed", 2, "f_"))


# a column of up to 20 values is recoded from 0, a wider one stays as it is
_MIXED_NUMBERS = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]
_MIXED_TEXTS = ["l_returnflag", "l_linestatus"]


def _recode_cte(column: str) -> str:
    return (
        f"d_{column} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS i, count(*) OVER () AS n "
        f"FROM (SELECT DISTINCT {column} AS v FROM lineitem))"
    )


def _text_cte(column: str) -> str:
    return (
        f"d_{column} AS (SELECT {column} AS v, "
        f"CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS i, 0 AS n FROM lineitem GROUP BY 1)"
    )


def _mixed_sql() -> str:
    ctes = [_recode_cte(c) for c in _MIXED_NUMBERS] + [_text_cte(c) for c in _MIXED_TEXTS]
    slots = []
    for p, c in enumerate(_MIXED_NUMBERS):
        slots.append(f"CAST({c} AS DOUBLE) AS f_{p}")
        slots.append(f"CASE WHEN d_{c}.n <= 20 THEN d_{c}.i ELSE CAST({c} AS DOUBLE) END AS i_{p}")
    for p, c in enumerate(_MIXED_TEXTS, len(_MIXED_NUMBERS)):
        slots += [f"d_{c}.i AS f_{p}", f"d_{c}.i AS i_{p}"]
    joins = " ".join(f"JOIN d_{c} ON l.{c} = d_{c}.v" for c in [*_MIXED_NUMBERS, *_MIXED_TEXTS])
    return f"WITH {', '.join(ctes)} SELECT l_extendedprice, {', '.join(slots)} FROM lineitem l {joins}"


@query("index_mixed_table", _mixed_sql())
def index_mixed_table(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *_MIXED_TEXTS, *_MIXED_NUMBERS, "l_extendedprice"
    )
    indexed = fit_mixed_features(lines, "l_extendedprice", drop=["l_orderkey"], invalid="skip").transform(lines)
    return indexed.select(
        "l_extendedprice", *vector_slots("features", 6, "f_"), *vector_slots("indexedFeatures", 6, "i_")
    )
