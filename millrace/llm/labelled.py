"""Labelled texts for fitting: a bounded sample, the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % modulus


def sample_of_class(
    docs: DataFrame, labels: DataFrame, label: str, value: int, rows: int, skip: Column, longest: int
) -> DataFrame:
    """Texts whose label has the value: at most `rows`, the first by a hash of the id.

    Rows that `skip` marks, null ids, null labels and texts over `longest`
    characters are left out of the fit. The bound is on fitting alone.
    """
    marked = labels.filter((F.col(label) == value) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("of")).distinct()
    marked = marked.filter(~skip)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.length("text") <= longest)
    # ids first, so that only the chosen texts move; repeated ids are one row
    ids = texts.select("doc_id").distinct().join(marked, F.col("doc_id") == F.col("of"), "left_semi")
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("of"))
    chosen = F.broadcast(chosen)  # at most `rows` ids
    return texts.join(chosen, F.col("doc_id") == F.col("of"), "left_semi").dropDuplicates(["doc_id"])
