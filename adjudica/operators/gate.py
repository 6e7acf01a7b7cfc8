"""The gate before delivery: ordered rules, then an audit that may only take rows back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.text import trim_all
from adjudica.plans.policy import LEGAL, MERITS_OPENING, Gate


def refusal(summary: Column, gate: Gate = LEGAL.gate) -> Column:
    """Why a summary may not be written; null where it may. The first rule that applies decides."""
    t = trim_all(F.coalesce(summary, F.lit("")))
    silent = F.rlike(t, F.lit(gate.settlement_opening)) & ~F.rlike(t, F.lit(gate.amount)) & F.rlike(t, F.lit(gate.terms_unavailable))
    rules = F.when(F.startswith(t, F.lit(gate.undetermined)), "no_final_decision")
    rules = rules.when(~F.rlike(t, F.lit(gate.valid_opening)), "off_house_style").when(silent, "settlement_without_terms")
    return rules.when(F.rlike(t, F.lit(gate.self_declared)), "self_declared_insufficiency")


def gated(df: DataFrame, summary: str = "summary", gate: Gate = LEGAL.gate) -> DataFrame:
    """df with gate_reason and status."""
    d = df.withColumn("gate_reason", refusal(F.col(summary), gate))
    return d.withColumn("status", F.when(F.col("gate_reason").isNull(), "writeable").otherwise("needs_review"))


def audited(records: DataFrame, verdicts: DataFrame, key: str = "case_number") -> DataFrame:
    """records(key, status, …) with audit_severity, audit_reason and the status after the audit.

    verdicts(key, severity, unsupported): severe takes a row back, anything else and a failed or missing verdict keeps
    it; no verdict can let a row through.
    """
    why = F.concat(F.lit("audit: "), F.coalesce(F.nullif(F.array_join("unsupported", " | "), F.lit("")), F.lit("an assertion the source does not support")))
    both = records.join(verdicts.select(key, "severity", "unsupported"), key, "left")
    severe = F.coalesce((F.col("severity") == "severe") & (F.col("status") == "writeable"), F.lit(False))
    out = both.withColumn("audit_reason", F.when(severe, why)).withColumn("status", F.when(severe, "needs_review").otherwise(F.col("status")))
    return out.withColumnRenamed("severity", "audit_severity").drop("unsupported")


def audit_report(records: DataFrame) -> DataFrame:
    """kept, demoted and failed of the audited rows (failed: no verdict came)."""
    demoted = F.col("audit_reason").isNotNull()
    return records.agg(F.count_if(~demoted).alias("kept"), F.count_if(demoted).alias("demoted"), F.count_if(F.col("audit_severity").isNull()).alias("failed"))


def _reason() -> Column:
    return F.when(F.col("audit_reason").isNotNull(), "audit").otherwise(F.coalesce("gate_reason", F.lit("unknown")))


def refused(records: DataFrame) -> DataFrame:
    """The refused rows with reason and why: an audit's refusal comes before the gate's."""
    why = F.coalesce("audit_reason", "gate_reason", F.lit("unknown"))
    return records.where("status <> 'writeable'").withColumn("reason", _reason()).withColumn("why", why)


def refusal_groups(records: DataFrame) -> DataFrame:
    """Refused rows per reason."""
    return refused(records).groupBy("reason").agg(F.count("*").alias("n"))


def cell_state(existing: Column, gate: Gate = LEGAL.gate, merits: str = MERITS_OPENING) -> Column:
    """blank, house_style or off_style."""
    t = trim_all(F.coalesce(existing, F.lit("")))
    styled = F.rlike(t, F.lit(merits)) | F.rlike(t, F.lit(gate.valid_opening))
    return F.when(t == "", "blank").when(styled, "house_style").otherwise("off_style")
