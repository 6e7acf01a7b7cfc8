"""Rows of the case table: their state, and which of them are targets, gold or drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.operators.gate import cell_state

TARGET, GOLD, DRIFT = "not approved and state <> 'house_style'", "approved and state = 'house_style'", "approved and state = 'off_style'"


def with_state(rows: DataFrame) -> DataFrame:
    return rows.withColumn("state", cell_state(F.col("existing")))


def targets(rows: DataFrame) -> DataFrame:
    return rows.where(TARGET)


def gold(rows: DataFrame) -> DataFrame:
    return rows.where(GOLD)


def drift(rows: DataFrame) -> DataFrame:
    return rows.where(DRIFT)


def histogram(rows: DataFrame) -> DataFrame:
    """One row of counts."""
    count = lambda e: F.count_if(F.expr(e))
    states = [count(f"state = '{s}'").alias(f"n_{s}") for s in ("house_style", "off_style", "blank")]
    return rows.agg(F.count("*").alias("n_rows"), count("approved").alias("n_approved"), *states, count(TARGET).alias("n_targets"), count(GOLD).alias("n_gold"), count(DRIFT).alias("n_drift"))
