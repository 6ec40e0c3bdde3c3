"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trendloom.llm import conversations, decontaminate, knn, langid, licenses, lines, minhash, mixing, passages, phrases, pii, token_counts, urls
from trendloom.llm.common import table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op6_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_token_counts": op2_token_counts,
    "op3_minhash_near_duplicates": op3_minhash_near_duplicates,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_personal_data": op5_personal_data,
    "op6_voronoi_top_k": op6_voronoi_top_k,
    "op7_repeated_passages": op7_repeated_passages,
    "op8_line_dedup": op8_line_dedup,
    "op9_language_id": op9_language_id,
    "op10_mix_sources": op10_mix_sources,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_license_scan": op13_license_scan,
}

ORACLE: dict[str, str] = {
    "op1_url_filter": urls.oracle(),
    "op6_voronoi_top_k": knn.ORACLE,
    "op11_conversation_repair": conversations.ORACLE,
    "op12_phrase_collocations": phrases.ORACLE,
}
