"""From raw documents to packed training sequences, in five stages.

Every stage takes the documents its predecessor kept, as read back from Parquet,
and all but the last return the columns of documents. A stage fits what it
needs on its own input and the labels table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import packing, quality, toxicity
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.ngram_join import link_documents
from millrace.llm.queries import TOKENIZER, table, tokenizer_path
from millrace.llm.store import bounded_batches, written
from millrace.session import BROADCAST_BYTES

TOXIC_FROM = 0.5
GOOD_FROM = 0.7


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below TOXIC_FROM."""
    bounded_batches(spark)
    model = toxicity.fit_from_labels(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, output="_score").filter(F.col("_score") < TOXIC_FROM).drop("_score")


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored GOOD_FROM or above."""
    bounded_batches(spark)
    model = quality.fit_from_labels(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, output="_score").filter(F.col("_score") >= GOOD_FROM).drop("_score")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat or nearly repeat an earlier one; n_chars follows."""
    bounded_batches(spark)
    columns = docs.columns
    cut = dedup_lines(docs).select(*columns)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in columns else cut


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link, directly or over others, the one with the least id."""
    bounded_batches(spark)
    linked = link_documents(docs)
    gone = written(linked.filter("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct(), "pipeline-gone")
    gone = F.broadcast(gone) if gone.count() * 64 <= BROADCAST_BYTES else gone
    return docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 ids."""
    bounded_batches(spark)
    return packing.pack_documents(docs, tokenizer=tokenizer_path(TOKENIZER))


STAGES = [
    ("toxicity", without_toxic),
    ("quality_classifier", of_quality),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("packing", packed),
]

# A fitted classifier and a tokenizer have no form in SQL. The operators have tests of their own; the stages are
# tested for the columns, rows and labels they keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
