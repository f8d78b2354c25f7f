"""From raw documents to packed sequences: the stages of the training-data pipeline.

Every stage takes (spark, docs, sf_dir) and works on all that the one before has kept. All but the last return the columns of
the documents; the last returns the packed pieces.

Every stage sets the session's bytes of an Arrow batch to BATCH_BYTES, as it is read when the stage runs; ``run`` puts back what was set.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchflow.llm import line_templates, packing, pu_quality, simhash_bk, suffix_dedup
from matchflow.llm.common import table
from matchflow.session import materialise

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Of texts handed to Python the JVM and the worker both hold a batch, and neither gives all of its memory back.
BATCH_BYTES = 2 << 20


def small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, after the bytes of a batch have been set."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


@small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return pu_quality.keep_good(docs, pu_quality.fit(docs, table(spark, sf_dir, "labels")))


def counted(docs: DataFrame) -> DataFrame:
    """n_chars as of the text that is left."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


@small_batches
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates, and short lines that recur as they stand, go from all documents but the first."""
    return counted(line_templates.drop_recurring(docs, short_lines=True).drop("n_lines", "n_dropped"))


@small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_bk.drop_near_copies(docs)


@small_batches
def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that stand elsewhere too are cut out."""
    return counted(suffix_dedup.without_repeats(docs))


@small_batches
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_array_dedup),
    ("packing", best_fit_packing),
]

#: A trained classifier, whole-text matching and a tokenizer are not for SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    docs, before = table(spark, sf_dir, "documents"), spark.conf.get(BATCH_CONF)
    try:
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), name)
    finally:
        spark.conf.set(BATCH_CONF, before)
    return docs
