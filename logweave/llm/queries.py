"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from logweave.llm.html_text import visible_text
from logweave.llm.interpolated_lm import lm_scores
from logweave.llm.kneser_ney import perplexities
from logweave.llm.knn_join import top_inner_products
from logweave.llm.license_scan import license_digest
from logweave.llm.minhash_dedup import near_duplicates
from logweave.llm.mixing import mixed_words
from logweave.llm.oracle import LLM_ORACLE as _ORACLE
from logweave.llm.packing import packed_digest
from logweave.llm.periodic_runs import runs_digest
from logweave.llm.prefix_trie import rebuilt_trie
from logweave.llm.quality_rules import quality_rules
from logweave.llm.substring_dedup import repeated_text
from logweave.llm.toxicity import toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _over(operator: Callable[[DataFrame], DataFrame], name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


def q_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted text: the documents labelled as good."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return perplexities(table(spark, sf_dir, "documents"), trusted)


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kneser_ney": q_kneser_ney,
    "op2_quality_rules": _over(quality_rules, "documents"),
    "op3_html_text": _over(visible_text, "pages"),
    "op4_substring_dedup": _over(repeated_text, "documents"),
    "op5_license_scan": _over(license_digest, "documents"),
    "op6_minhash_dedup": _over(near_duplicates, "documents"),
    "op7_toxicity": q_toxicity,
    "op8_knn_join": _over(lambda vectors: top_inner_products(vectors, F.col("vec_id") % 50 == 0), "embeddings"),
    "op9_packing": _over(packed_digest, "documents"),
    "op10_mixing": _over(mixed_words, "documents"),
    "op11_periodic_runs": _over(runs_digest, "documents"),
    "op12_prefix_trie": _over(rebuilt_trie, "conversations"),
    "op13_lm_scoring": _over(lm_scores, "documents"),
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLE: dict[str, str] = dict(_ORACLE)
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
