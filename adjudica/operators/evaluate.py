"""Aggregates over judged samples. A failed judgement counts against: severe for fidelity, an error for parity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.functions.text import rounded_percent, trim_all


def fidelity_report(outcomes: DataFrame) -> DataFrame:
    """One row from outcomes(severity, n_unsupported, score): a null severity is a failed call."""
    failed = F.col("severity").isNull()
    severity, score = F.coalesce("severity", F.lit("severe")), F.coalesce(F.when(~failed, F.col("score")), F.lit(0.0))
    clean = ~failed & (F.coalesce("n_unsupported", F.lit(0)) == 0)
    n = F.count("*")
    return outcomes.agg(
        n.alias("sampled"), F.count_if(severity == "ok").alias("n_ok"), F.count_if(severity == "minor").alias("n_minor"), F.count_if(severity == "severe").alias("n_severe"), F.count_if(failed).alias("n_failed"),
        rounded_percent(F.count_if(clean), n).alias("clean_pct"), rounded_percent(F.count_if(severity == "severe"), n).alias("severe_pct"), (F.floor(F.avg(score) * 10 + 0.5) / 10).alias("mean_score"),
    )


def parity_report(outcomes: DataFrame) -> DataFrame:
    """One row from outcomes(verdict, same_outcome, house_style, score): a null verdict is a failed call."""
    v = F.coalesce("verdict", F.lit("error"))
    failed, n = F.col("verdict").isNull(), F.count("*")
    score = F.coalesce(F.when(~failed, F.col("score")), F.lit(0.0))
    names = ("equivalent", "ours_more_complete", "ours_worse", "conflict", "error")
    yes = lambda c: F.count_if(~failed & F.coalesce(F.col(c), F.lit(False)))
    return outcomes.agg(
        n.alias("sampled"), *[F.count_if(v == k).alias(f"n_{k}") for k in names],
        rounded_percent(yes("same_outcome"), n).alias("same_outcome_pct"), rounded_percent(F.count_if(v.isin("equivalent", "ours_more_complete")), n).alias("at_least_as_good_pct"),
        rounded_percent(yes("house_style"), n).alias("house_style_pct"), (F.floor(F.avg(score) * 10 + 0.5) / 10).alias("mean_score"),
    )


def delivered(records: DataFrame) -> DataFrame:
    """Rows that were written: writeable ones with a summary that is not blank."""
    return records.where((F.col("status") == "writeable") & (trim_all(F.coalesce("summary", F.lit(""))) != ""))


def measurable(gold: DataFrame, docs: DataFrame) -> DataFrame:
    """Approved rows that have a document to read; drawn before any sample, so that the sample is not short."""
    return gold.join(docs.where("case_number is not null").select("case_number").distinct(), "case_number", "left_semi")


def pairs(gold: DataFrame, made: DataFrame) -> DataFrame:
    """case_number, reference, generated of approved rows whose generated summary is not blank."""
    some = made.where(trim_all(F.coalesce("summary", F.lit(""))) != "").select("case_number", F.col("summary").alias("generated"))
    return gold.select("case_number", F.col("existing").alias("reference")).join(some, "case_number")
