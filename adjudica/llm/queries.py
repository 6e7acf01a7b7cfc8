"""The operators as queries over whole tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.llm import decontamination, embedding_dedup, hard_negatives, hmm_lm, html_extraction, license_scan, minhash_dedup, mixing, oracles, packing, pii, quality_rules, spelling_variants, substring_dedup


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(_read(spark, sf_dir, "documents"), window=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.plan(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_lines", "n_left_words")


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op10_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score(_read(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_read(spark, sf_dir, "documents"))
    counts = [F.size(f"{k}_spans").cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"), threshold=0.98)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(_read(spark, sf_dir, "pages"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), with_text=False)
    n_hit, n_items = decontamination.n_hit(F.col("hits")), F.size("items").cast("long")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), n_items.alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(_read(spark, sf_dir, "documents"))


def base8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op8 that SQL can say."""
    return op8_pii(spark, sf_dir).drop("spans")


def base10_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op10 that SQL can say; they need no training."""
    scored = hmm_lm.score(_read(spark, sf_dir, "documents"), rounds=0)
    return scored.drop("score").withColumn("base_score", F.round("base_score", 4))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op7_html_extraction": op7_html_extraction,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op8_pii": op8_pii,
    "op10_hmm_lm": op10_hmm_lm,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op2_packing": op2_packing,
    "op3_license_scan": op3_license_scan,
    "op1_substring_dedup": op1_substring_dedup,
    "op5_mixing": op5_mixing,
    "op11_decontamination": op11_decontamination,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling_variants": op13_spelling_variants,
    "base8_pii": base8_pii,
    "base10_hmm_lm": base10_hmm_lm,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": oracles.substring_dedup(),
    "op3_license_scan": oracles.license_scan(),
    "op4_quality_rules": oracles.quality_rules(),
    "op5_mixing": oracles.mixing(),
    "op6_embedding_dedup": oracles.embedding_dedup(),
    "op9_minhash_dedup": oracles.minhash_dedup(),
    "op11_decontamination": oracles.decontamination(),
    "op12_hard_negatives": oracles.hard_negatives(),
    "op13_spelling_variants": oracles.spelling_variants(),
    "base8_pii": oracles.pii(),
    "base10_hmm_lm": oracles.hmm_lm(),
}
