"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchflow.llm import ann_forest, byte_bpe, decontamination, line_templates, multiset_hash, packing, pu_quality, revisits, simhash_bk, suffix_dedup, token_alignment, toxicity, whitening
from matchflow.llm.common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(table(spark, sf_dir, "documents"))


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.drop_recurring(table(spark, sf_dir, "documents"), short_lines=True).select("doc_id", "text", "n_lines", "n_dropped")


def op4_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve_revisits(revisits.captures_of(table(spark, sf_dir, "pages")))
    headers = [F.col("headers")[name].alias(name.replace("-", "_")) for name in ("cache-control", "content-length", "content-type", "server")]
    return found.select("record_id", "key", "outcome", "resolved_id", *headers)


def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pu_quality.score(docs, pu_quality.fit(docs, table(spark, sf_dir, "labels")))


def op6_nb_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bk.near_duplicates(table(spark, sf_dir, "documents"))


def op8_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op9_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_best_fit_packing, op2_suffix_dedup, op3_line_templates, op4_revisit_resolution, op5_pu_quality, op6_nb_toxicity, op7_simhash_near_dedup, op8_multiset_fingerprints, op9_projection_forest, op10_byte_bpe, op11_token_alignment, op12_embedding_whitening, op13_benchmark_decontamination)}
ORACLE_SQL: dict[str, str] = {"op3_line_templates": line_templates.ORACLE_SQL, "op4_revisit_resolution": revisits.ORACLE_SQL, "op13_benchmark_decontamination": decontamination.ORACLE_SQL}
