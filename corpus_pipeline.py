"""The corpus pipeline: quality rules, MinHash near-dedup, PII, mixing, packing, each on all that the stage before kept.

Every stage but the last returns the columns of documents (doc_id, text, lang, source, n_chars); n_chars follows the
text. Null texts are empty and fail the quality rules. Each stage is written and read again by whoever runs them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.llm import _common, minhash_dedup, mixing, packing, pii, quality_rules

OTHER = ("lang", "source")
ORACLE_SQL = None


def _documents(df: DataFrame, text: str = "text") -> DataFrame:
    return df.select("doc_id", F.col(text).alias("text"), *[F.col(f"keep_{c}").alias(c) for c in OTHER], F.length(text).cast("long").alias("n_chars"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without lines too many documents of their source share.

    Null and empty texts fail; a null source is a source of its own; rows of one id, or of none, are judged apart.
    """
    return _documents(quality_rules.judge(docs, keep=OTHER).where("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of five-word shingle similarity 0.8 or more: the one of the smallest id.

    A row without an id takes part by its text, after all that have one. Of rows of one id in one class those of one text
    stay, and of repeated rows one. Texts without words are in no class and stay once per id.
    """
    by_text = F.xxhash64(F.coalesce("text", F.lit("")))
    # an id of their own for rows without, above all ids there are
    own = F.coalesce(F.col("doc_id").cast("long"), by_text.bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62)))
    numbered = docs.withColumn("given_id", F.col("doc_id").cast("long")).withColumn("doc_id", own)
    found = minhash_dedup.near_duplicates(numbered, shingle=5, percent=80, keep=("text", *OTHER, "given_id")).where("chosen")
    rest = F.struct("keep_given_id", "keep_text", *[f"keep_{c}" for c in OTHER])
    first = found.groupBy("doc_id", "at").agg(F.min_by(rest, F.struct(*[f"keep_{c}" for c in OTHER])).alias("r"))
    return _documents(first.select(F.col("r.keep_given_id").alias("doc_id"), "r.keep_text", *[f"r.keep_{c}" for c in OTHER]), "keep_text")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind. Null texts are empty; rows are independent."""
    found = pii.find(docs, keep=OTHER)
    return _documents(found.withColumn("text", pii.redacted(F.col("text"), F.col("spans"))))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document stands as often as it is taken whole, and once more with the words
    of it that are taken in part, if any.

    Null sources are one source, the last; texts without words are no part of a mix; repeated rows are rows of their own.
    """
    taken = mixing.plan(docs, keep=("text", "lang"))
    return mixing.materialised(taken, "text").select("doc_id", "text", *OTHER, F.length("text").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids' checksum. A null or empty text is its end id alone."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality rules", quality), ("MinHash near-dedup", near_dedup), ("PII", redact), ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = _common.Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = work.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
