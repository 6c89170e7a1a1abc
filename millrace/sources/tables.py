"""CSV scans and small in-memory frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def scan_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    schema: StructType | str | None = None,
    names: Sequence[str] | None = None,
    sampling_ratio: float = 1.0,
    bad_records: str | None = None,
) -> DataFrame:
    """A CSV table, with or without a header line.

    With a schema the files are read once. Without one the types are inferred,
    which costs a pass over `sampling_ratio` of the rows. `names` renames the
    columns by position.

    `bad_records` names one more column, for a scan with a schema: the whole line
    where it does not fit the schema, null elsewhere. What could be read of such a
    line is in the other columns. Use it by `bad_apart`: by itself it is set only
    for values in columns that the query reads.
    """
    reader = spark.read.option("header", header)
    if bad_records is not None:
        if schema is None:
            raise ValueError("bad records are found by a schema")
        fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if bad_records in fields.names or names and bad_records in names:
            raise ValueError(f"the table has a column {bad_records}")
        schema = StructType([*fields.fields, StructField(bad_records, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", bad_records).option("columnPruning", False)
        names = [*names, bad_records] if names else None
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not header)
    else:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    df = reader.csv(path)
    return df.toDF(*names) if names else df


def bad_apart(df: DataFrame, bad_records: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a scan that fit the schema, without the column of bad records, and those that do not, with it.

    Spark parses only the columns a query uses and finds bad values only there, so
    both sides look at all of them: a line is bad or not whatever is selected later.
    """
    read = F.length(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in df.columns])) >= 0
    bad = F.col(f"`{bad_records}`").isNotNull()
    return df.where(~bad & read).drop(bad_records), df.where(bad & read)


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.option("header", header).csv(path)
    return path


def rows_like(spark: SparkSession, rows: Sequence[tuple], like: DataFrame, columns: Sequence[str]) -> DataFrame:
    """In-memory rows with the column types of another table, for scoring."""
    return spark.createDataFrame(list(rows), like.select(*columns).schema)
