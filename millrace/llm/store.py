"""Intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import atexit
import contextlib

from pyspark.sql import DataFrame, SparkSession

from millrace.session import shared_path

# Most bytes of rows that go to a Python worker at once; 10,000 long texts would be many times that.
BATCH_BYTES = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_made: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, taken away when the driver ends."""
    path = shared_path(spark, name)
    if not _made:
        atexit.register(_remove)
    _made.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once as Parquet and go on from the files, which outlive lost executors."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of BATCH_BYTES at most, where the session was started without a bound of its own.

    Scores and pieces of a text do not depend on the batch it comes in.
    """
    named = spark.sparkContext.getConf().get(_BATCH_SETTING, None)
    if named is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def _remove() -> None:
    """At the end of the driver, take away what written() made."""
    for spark, path in _made:
        with contextlib.suppress(Exception):
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
