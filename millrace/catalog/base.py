"""Registry, table access and the SQL fragments the checks share."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions import Keys
from millrace.session import laid_out

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# lineitem has no unique id; these columns keep copies of a line on one side of a split.
LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE = Keys(tuple(LINE_KEYS), portable=True)
EVENT = Keys(("event_id",), portable=True)

# 0/1 features of lineitem, as expressions both engines read the same way.
BINARY = {
    "is_open": "CAST(l_linestatus = 'O' AS INT)",
    "qty_high": "CAST(l_quantity > 25 AS INT)",
    "disc_high": "CAST(l_discount > 0.045 AS INT)",
    "tax_high": "CAST(l_tax > 0.035 AS INT)",
    "price_high": "CAST(l_extendedprice > 35000 AS INT)",
}
FLAG_CODE = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of a fit in one partition. Every partition holds statistics of all nodes
# of a tree level, so small ones cost more than they gain.
ROWS_PER_PARTITION = 1 << 15

# Partitions before they are filled up, and the rows of a full one. An iterative fit runs
# one or two tasks for each partition and step, and every task reports to the driver.
FIT_PARTITIONS = 48
FULL_PARTITION = 1 << 20


def partitions_for(rows: int) -> int:
    """Partitions of so many rows of a fit; the cores play no part."""
    few = math.ceil(rows / ROWS_PER_PARTITION)
    return max(1, min(few, FIT_PARTITIONS), math.ceil(rows / FULL_PARTITION))


def layout(df: DataFrame) -> int:
    """Partitions of the rows a model is fitted on: by their number, not by the cores; fuller ones where there are many."""
    return partitions_for(df.count())


def full_layout(df: DataFrame) -> int:
    """Full partitions of the rows of a sampled forest, whose fit holds statistics of all nodes of a step in every partition."""
    return max(1, math.ceil(df.count() / FULL_PARTITION))


def line_rows(spark: SparkSession, sf_dir: str, *columns: str | Column, layout: Callable[[DataFrame], int] | None = layout) -> DataFrame:
    """Columns of lineitem for a fit, laid out by the line's keys, or as they lie without a layout."""
    lines = table(spark, sf_dir, "lineitem")
    if layout is None:
        return lines.select(*columns)
    keys = [F.col(k).alias(f"_{k}") for k in LINE_KEYS]
    wanted = lines.select(*columns)
    dealt = laid_out(lines.select(*keys, *columns), layout(lines), *[f"_{k}" for k in LINE_KEYS])
    return dealt.select(*wanted.columns)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Round the named columns, so that summation order does not show."""
    return df.select(*[F.round(c, places).alias(c) if c in columns else F.col(c) for c in df.columns])


def exprs(spec: dict[str, str]) -> list[Column]:
    return [F.expr(text).alias(name) for name, text in spec.items()]


def select_sql(spec: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in spec.items())


def bucket_sql(keys: list[str], buckets: int, salt: str = "") -> str:
    parts = ([f"'{salt}'"] if salt else []) + [f"CAST({k} AS VARCHAR)" for k in keys]
    text = " || '|' || ".join(parts)
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {buckets})"


def class_metrics_sql(ctes: str) -> str:
    """Metrics over a CTE named pred(label, prediction)."""
    return f"""
WITH {ctes},
cm AS (SELECT label, prediction, CAST(count(*) AS DOUBLE) AS n FROM pred GROUP BY 1, 2),
pc AS (
  SELECT a.c, a.actual, coalesce(g.guessed, 0) AS guessed, coalesce(h.tp, 0) AS tp
  FROM (SELECT label AS c, sum(n) AS actual FROM cm GROUP BY 1) a
  LEFT JOIN (SELECT prediction AS c, sum(n) AS guessed FROM cm GROUP BY 1) g ON a.c = g.c
  LEFT JOIN (SELECT label AS c, sum(n) AS tp FROM cm WHERE label = prediction GROUP BY 1) h ON a.c = h.c
),
pr AS (SELECT *, CASE WHEN guessed = 0 THEN 0 ELSE tp / guessed END AS p, tp / actual AS r FROM pc),
pf AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM pr)
SELECT 'accuracy' AS metric, round(sum(tp) / sum(actual), 6) AS value FROM pf
UNION ALL SELECT 'weightedPrecision', round(sum(actual * p) / sum(actual), 6) FROM pf
UNION ALL SELECT 'weightedRecall', round(sum(actual * r) / sum(actual), 6) FROM pf
UNION ALL SELECT 'f1', round(sum(actual * f) / sum(actual), 6) FROM pf
"""


def value_metrics_sql(ctes: str, places: int = 4) -> str:
    """Metrics over a CTE named pred(label, prediction)."""
    return f"""
WITH {ctes},
m AS (
  SELECT avg((label - prediction) * (label - prediction)) AS mse,
         avg(abs(label - prediction)) AS mae, var_pop(label) AS spread
  FROM pred
)
SELECT 'mse' AS metric, round(mse, {places}) AS value FROM m
UNION ALL SELECT 'rmse', round(sqrt(mse), {places}) FROM m
UNION ALL SELECT 'r2', round(1 - mse / spread, {places}) FROM m
UNION ALL SELECT 'mae', round(mae, {places}) FROM m
"""
