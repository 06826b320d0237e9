"""Registered queries of this subpackage: each takes (spark, sf_dir), reads whole tables and returns its operator's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from maintlake.llm import op10_jaccard, op11_variants, op12_negatives, op13_votes, op1_mixing, op2_lines, op3_pieces, op4_secrets, op5_neighbours, op6_exact_topk, op7_quality, op8_substrings, op9_urls
from maintlake.llm.shared import documents


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_mixing.mixed_documents(documents(spark, sf_dir))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_lines.repeated_lines(documents(spark, sf_dir)).drop("text_key")


def op3_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    return op3_pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_secrets.secret_digest(documents(spark, sf_dir))


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_neighbours.neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_sorted_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_exact_topk.exact_top(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return op7_quality.score_quality(documents(spark, sf_dir), labels)


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_substrings.without_repeats(documents(spark, sf_dir))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return op9_urls.filter_urls(pages, F.col("url").rlike(op9_urls.CAMPAIGN))


def op10_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_jaccard.jaccard_components(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_variants.spelling_variants(documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_voted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_votes.voted_documents(documents(spark, sf_dir))


QUERIES = {
    "op1_source_mix": op1_source_mix,
    "op2_line_dedup": op2_line_dedup,
    "op3_piece_codec": op3_piece_codec,
    "op4_secret_scan": op4_secret_scan,
    "op5_multi_index": op5_multi_index,
    "op6_sorted_lists": op6_sorted_lists,
    "op7_quality_score": op7_quality_score,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_url_filter": op9_url_filter,
    "op10_jaccard_groups": op10_jaccard_groups,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_voted_quality": op13_voted_quality,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL = {"op6_sorted_lists": op6_exact_topk.ORACLE, "op8_repeated_passages": op8_substrings.ORACLE, "op9_url_filter": op9_urls.ORACLE, "op10_jaccard_groups": op10_jaccard.ORACLE, "op12_hard_negatives": op12_negatives.ORACLE}
