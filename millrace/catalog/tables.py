"""Scans, loaders, previews and schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import query, table
from millrace.operators.encode import drop_nonnumeric
from millrace.operators.inspect import schema_report
from millrace.operators.rank import preview
from millrace.session import shared_path
from millrace.sources import (
    bad_apart,
    index_all,
    index_target,
    load_binary_numeric,
    load_connections,
    load_cover,
    scan_csv,
    write_csv,
)

_PART = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"


def _as_csv(df, name: str, header: bool) -> str:
    return write_csv(df, shared_path(df.sparkSession, name), header)


@query("csv_headerless_scan", _PART)
def csv_headerless_scan(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = _as_csv(part, "part-csv", header=False)
    return scan_csv(spark, path, header=False, schema=part.schema, names=part.columns)


@query("csv_header_scan", _PART)
def csv_header_scan(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    found = scan_csv(spark, _as_csv(part, "part-csv", header=True))
    # inference picks the narrowest type that fits; give every scale the same ones
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in part.schema.fields])


@query(
    "csv_bad_records",
    "SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS p_size, p_partkey % 7 = 0 AS bad FROM part",
)
def csv_bad_records(spark, sf_dir):
    """Every seventh size is not a number; its line is kept apart."""
    size = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("size "), "p_size")).otherwise(F.col("p_size").cast("string"))
    part = table(spark, sf_dir, "part")
    path = _as_csv(part.select("p_partkey", "p_name", size.alias("p_size")), "part-csv", header=False)
    schema = part.select("p_partkey", "p_name", "p_size").schema
    good, bad = bad_apart(scan_csv(spark, path, header=False, schema=schema, bad_records="line"), "line")
    good, bad = (side.select("p_partkey", "p_size", F.lit(is_bad).alias("bad")) for side, is_bad in ((good, False), (bad, True)))
    return good.unionByName(bad)


@query("preview_rows", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def preview_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return preview(orders, 10, "o_orderkey")


@query(
    "schema_report",
    """
SELECT column_name AS "column",
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                        WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                        ELSE lower(column_type) END AS type
FROM (DESCRIBE lineitem)
""",
)
def schema_report_lineitem(spark, sf_dir):
    return schema_report(table(spark, sf_dir, "lineitem")).select("column", "type")


_COVER_MEASURES = ["Elevation", "Aspect", "Slope", "Hillshade_Noon"]
_COVER_SOURCE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "load_cover_like",
    "SELECT "
    + ", ".join(f"{c} AS {m}" for c, m in zip(_COVER_SOURCE, _COVER_MEASURES))
    + ", "
    + ", ".join(f"CAST(l_linenumber = {i + 1} AS INT) AS Soil_Type_{i}" for i in range(7))
    + ", CAST(l_linenumber AS DOUBLE) AS Cover_Type FROM lineitem",
)
def load_cover_like(spark, sf_dir):
    soils = [(F.col("l_linenumber") == i + 1).cast("int").alias(f"s{i}") for i in range(7)]
    source = table(spark, sf_dir, "lineitem").select(*_COVER_SOURCE, *soils, "l_linenumber")
    path = _as_csv(source, "cover-csv", header=False)
    return load_cover(spark, path, _COVER_MEASURES, {"Soil_Type": 7}, schema=source.schema)


@query("load_binary_numeric", "SELECT p_partkey, p_size, p_retailprice FROM part")
def load_binary_numeric_part(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return load_binary_numeric(spark, _as_csv(part, "numeric-csv", header=True), part.schema)


@query(
    "load_connection_like",
    """
SELECT l_quantity AS duration, l_returnflag AS protocol_type, l_linestatus AS service,
       l_extendedprice AS src_bytes, l_discount AS serror_rate, l_tax AS rerror_rate,
       CAST(l_linenumber AS VARCHAR) AS label
FROM lineitem
""",
)
def load_connection_like(spark, sf_dir):
    source = table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_returnflag", "l_linestatus", "l_extendedprice", "l_discount", "l_tax",
        F.col("l_linenumber").cast("string").alias("line"),
    )
    names = ["duration", "protocol_type", "service", "src_bytes", "serror_rate", "rerror_rate", "label"]
    return load_connections(spark, _as_csv(source, "net-csv", header=False), names, source.schema)


@query(
    "index_all_columns",
    """
WITH f AS (SELECT l_returnflag AS v, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS i
           FROM lineitem GROUP BY 1),
     s AS (SELECT l_linestatus AS v, row_number() OVER (ORDER BY count(*) DESC, l_linestatus) - 1 AS i
           FROM lineitem GROUP BY 1)
SELECT CAST(f.i AS DOUBLE) AS l_returnflag_index, CAST(s.i AS DOUBLE) AS l_linestatus_index
FROM lineitem l JOIN f ON l.l_returnflag = f.v JOIN s ON l.l_linestatus = s.v
""",
)
def index_all_columns(spark, sf_dir):
    return index_all(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus"))


@query(
    "index_target_drop_raw",
    """
WITH t AS (SELECT event_type AS v, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS i
           FROM events GROUP BY 1)
SELECT user_id, value, CAST(t.i AS DOUBLE) AS event_type_index
FROM events e JOIN t ON e.event_type = t.v
""",
)
def index_target_drop_raw(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    return index_target(events, "event_type", drop=["event_id"])


@query(
    "drop_nonnumeric",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
)
def drop_nonnumeric_lineitem(spark, sf_dir):
    return drop_nonnumeric(table(spark, sf_dir, "lineitem"))
