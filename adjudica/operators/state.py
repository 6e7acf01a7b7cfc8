"""What makes a run resumable: what is left to do, the latest record of each key, batches and their chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.functions.text import trim_all


def todo(wanted: DataFrame, done: DataFrame, key: str, in_flight: DataFrame | None = None) -> DataFrame:
    """Rows of wanted whose key is neither done nor, where given, in a batch that is still open."""
    out = wanted.join(done.select(key).distinct(), key, "left_anti")
    return out if in_flight is None else out.join(in_flight.select(key).distinct(), key, "left_anti")


def latest(records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last record of each key, by a combining aggregation: a key with very many records is no single task."""
    last = F.max_by(F.struct(*records.columns), F.struct(*order))
    return records.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(last.alias("_r")).select("_r.*")


def batch_ids(parts: DataFrame, id_col: str, order: str) -> DataFrame:
    """Ordered set union: each id once, at its first place."""
    return parts.groupBy(id_col).agg(F.min(order).alias("first_at"))


def non_blank(texts: DataFrame, text: str = "text") -> DataFrame:
    return texts.where(trim_all(F.coalesce(text, F.lit(""))) != "")


def collected(results: DataFrame, targets: DataFrame, done: DataFrame, key: str = "custom_id") -> DataFrame:
    """results with outcome: known (done before, never priced twice), invalid (no such target or a failed call), new."""
    t = targets.select(key, F.lit(True).alias("_target")).distinct()
    d = done.select(key, F.lit(True).alias("_done")).distinct()
    both = results.join(t, key, "left").join(d, key, "left")
    outcome = F.when(F.col("_done"), "known").when(F.col("_target").isNull() | ~F.col("ok"), "invalid").otherwise("new")
    return both.select(*results.columns, outcome.alias("outcome"))


def billed() -> Column:
    """Whether a tagged result is paid for: an answer that came, of use or not, and had not been paid before."""
    return F.col("ok") & (F.col("outcome") != "known")


def capped(df: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first rows of a list that a report cuts, with how many more there are."""
    n = df.agg(F.count("*").alias("_n"))
    return df.orderBy(*order).limit(most).crossJoin(F.broadcast(n)).withColumn("more", F.col("_n") - most).drop("_n")


def outcome_counts(df: DataFrame, column: str = "outcome") -> DataFrame:
    return df.groupBy(F.col(column).alias("outcome")).agg(F.count("*").alias("n"))


def first_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """A limit that comes before anything is dropped as done."""
    return df.orderBy(*order).limit(n)


def last_row_wins(targets: DataFrame, key: str = "custom_id", row: str = "row") -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.col(row).desc())
    return targets.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
