"""Helpers around the caller's session: shared storage, caching, layout."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Largest side that is broadcast by hint. Anything above takes a shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without one gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="millrace-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to shared storage once and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame cached for several passes and release it afterwards."""
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def laid_out(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Rows dealt by hash of their keys over a given number of partitions, sorted inside.

    For fits that draw samples or sum in row order: the same rows lie in the same
    places whatever the files' splits and the number of cores.
    """
    return df.repartition(partitions, *keys).sortWithinPartitions(*df.columns)
