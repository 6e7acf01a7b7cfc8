"""A long text reduced to the part that decides it. One projection; texts are neither exploded nor shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.text import first_marker, let, marker_positions, running_sums
from adjudica.plans.policy import LEGAL, Segmentation

RANGES = "array<struct<a:int,b:int>>"


def windows(positions: Column, length: Column, p: Segmentation) -> Column:
    """Ranges around positions (ascending), merged where they touch, without the earliest ones beyond the budget.

    Starts and ends both ascend, so a range is new exactly where it starts after the one before it ends.
    """

    def merged(at: Column) -> Column:
        first = lambda i: F.greatest(F.lit(0), F.get(at, i) - p.before)
        last = lambda i: F.least(length, F.get(at, i) + p.after)
        fresh = F.filter(F.sequence(F.lit(0), F.size(at) - 1), lambda i: (i == 0) | (first(i) > last(i - 1)))
        return let(fresh, lambda f: F.transform(f, lambda i, k: F.struct(first(i).alias("a"), last(F.coalesce(F.get(f, k + 1), F.size(at)) - 1).alias("b"))))

    def kept(r: Column) -> Column:
        sizes = F.transform(F.reverse(r), lambda x: x["b"] - x["a"])
        after = let(running_sums(sizes), F.reverse)
        return let(after, lambda t: F.filter(r, lambda x, i: (i == F.size(r) - 1) | (F.get(t, i) + x["b"] - x["a"] <= p.budget)))

    return let(positions, lambda at: F.when(F.size(at) > 0, let(merged(at), kept)).otherwise(F.array().cast(RANGES)))


def segment(df: DataFrame, text: str = "text", policy: Segmentation = LEGAL.segmentation) -> DataFrame:
    """df with segmented, mode, original_length, segmented_length, reduction_pct, found_operative, found_report,
    found_signature and found_windows. Null text is empty. A cut that saves too little is undone."""
    p = policy
    t = F.coalesce(F.col(text), F.lit(""))
    cols = df.columns
    d = df.withColumn("_t", t).withColumn("original_length", F.length("_t"))
    long_enough = F.col("original_length") >= p.min_length
    d = d.withColumn("_at", F.when(long_enough, marker_positions(F.col("_t"), p.operative)).otherwise(F.array().cast("array<int>")))
    d = d.withColumn("_report", F.when(long_enough, first_marker(F.col("_t"), p.report))).withColumn("_sign", F.when(long_enough, first_marker(F.col("_t"), p.signature)))
    d = d.withColumn("found_operative", F.size("_at") > 0)
    docket = F.col("found_operative") & (F.col("original_length") > p.docket_above)
    d = d.withColumn("_w", F.when(docket, windows(F.col("_at"), F.col("original_length"), p)))
    cut = F.transform("_w", lambda r: F.substring(F.col("_t"), r["a"] + 1, r["b"] - r["a"]))
    whole = F.concat(F.lit(p.header_label + "\n"), F.substring(F.col("_t"), 1, p.header_cap), F.lit(f"\n\n{p.windows_label}\n"), F.array_join(cut, f"\n\n{p.gap}\n\n"))
    first = F.get("_at", F.lit(0))
    header = F.substring(F.col("_t"), F.lit(1), F.least(F.lit(p.header_cap), first))
    report = F.substring(F.col("_t"), F.col("_report") + 1, first - F.col("_report"))
    report = F.when(F.length(report) > p.report_cap, F.concat(F.substring(report, 1, p.report_cap), F.lit(f"\n{p.gap}"))).otherwise(report)
    middle = F.when(F.col("_report") < first, F.concat(F.lit(f"{p.report_label}\n"), report, F.lit("\n\n"))).otherwise("")
    tail = F.substring(F.col("_t"), first + 1, F.col("original_length") - first)
    one = F.concat(F.lit(p.header_label + "\n"), header, F.lit("\n\n"), middle, F.lit(f"{p.tail_label}\n"), tail)
    d = d.withColumn("_cut", F.when(docket, whole).when(F.col("found_operative"), one))
    saved = (F.col("original_length") - F.length("_cut")) / F.col("original_length") >= p.min_reduction
    worth = F.coalesce(saved, F.lit(False))
    d = d.withColumn("mode", F.when(~worth, "none").when(docket, "full-docket").otherwise("decision")).withColumn("segmented", F.when(worth, F.col("_cut")).otherwise(F.col("_t")))
    d = d.withColumn("segmented_length", F.length("segmented"))
    saved_pct = F.try_divide(F.col("original_length") - F.col("segmented_length"), F.col("original_length")) * 100
    return d.select(
        *cols, "segmented", "mode", "original_length", "segmented_length",
        F.coalesce(F.floor(saved_pct + 0.5).cast("int"), F.lit(0)).alias("reduction_pct"),
        "found_operative", F.col("_report").isNotNull().alias("found_report"), F.col("_sign").isNotNull().alias("found_signature"),
        F.when(docket, F.size("_w")).when(F.col("found_operative"), 1).otherwise(0).alias("found_windows"),
    )
