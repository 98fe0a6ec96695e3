"""The queries opN_<name> over the synthetic tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontamination, html_extraction, language_id, merge_dropout, quality_rules, secret_scan, simhash_dedup, suffix_dedup, token_output, toxicity

END_ID = 2


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score_documents(docs, toxicity.fit_model(docs, table(spark, sf_dir, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, sf_dir, "documents"))


def op3_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_shards(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), END_ID)


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit_language_model(docs)
    found = language_id.identify_languages(docs, model)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), threshold=50)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_quality_rules": op2_quality_rules,
        "op3_merge_dropout": op3_merge_dropout,
        "op4_token_output": op4_token_output,
        "op5_simhash_dedup": op5_simhash_dedup,
        "op6_html_extraction": op6_html_extraction,
        "op7_language_id": op7_language_id,
        "op8_secret_scan": op8_secret_scan,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_decontamination": op10_decontamination,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": quality_rules.ORACLE}
