"""House style, counted off the approved rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.functions.text import SPACE, rounded_percent, trim_all
from adjudica.plans.policy import MERITS_OPENING, MERITS_WORDS, SETTLEMENT_MENTION, SETTLEMENT_OPENING

EXAMPLES, CLIP = 3, 160
SETTLEMENT, MIXED, NO_FORM = "Acordo homologado", "JULGADO EXTINTO (settlement)", "no accepted opening"


def opening_form(text: Column) -> Column:
    """Which accepted opening a text has."""
    t = trim_all(text)
    flat = F.regexp_replace(F.upper(t), f"{SPACE}+", " ")
    word = F.coalesce(*[F.when(F.startswith(flat, F.lit(f"JULGADO {w}")), F.lit(w)) for w in MERITS_WORDS])
    mixed = F.rlike(t, F.lit(SETTLEMENT_MENTION)) & (word == "EXTINTO")
    merits = F.when(mixed, MIXED).otherwise(F.concat(F.lit("JULGADO "), word))
    return F.when(F.rlike(t, F.lit(SETTLEMENT_OPENING)), SETTLEMENT).when(F.rlike(t, F.lit(MERITS_OPENING)), merits).otherwise(NO_FORM)


def approved_rows(rows: DataFrame) -> DataFrame:
    """Approved rows with a text: row, form, settlement, clip."""
    some = rows.where("approved").where(trim_all(F.coalesce("existing", F.lit(""))) != "")
    t = trim_all(F.col("existing"))
    return some.select("row", opening_form(F.col("existing")).alias("form"), F.rlike(t, F.lit(SETTLEMENT_MENTION)).alias("settlement"), F.substring(t, 1, CLIP).alias("clip"))


def forms(approved: DataFrame) -> DataFrame:
    """form, n, examples (the first three by row). Rows per form are counted apart from the three that are listed."""
    counts = approved.groupBy("form").agg(F.count("*").alias("n"), F.min("row").alias("first_row"))
    # the three smallest rows of each form, by combining aggregation: no task holds a form's rows
    smallest = F.expr(f"slice(sort_array(array_agg(struct(row, clip))), 1, {EXAMPLES})")
    by_part = approved.groupBy("form", F.pmod(F.col("row"), F.lit(64)).alias("p")).agg(smallest.alias("s"))
    merged = by_part.groupBy("form").agg(F.slice(F.sort_array(F.flatten(F.collect_list("s"))), 1, EXAMPLES).alias("s"))
    return counts.join(merged, "form").select("form", "n", "first_row", F.transform("s", lambda x: x["clip"]).alias("examples"))


def dominance(approved: DataFrame) -> DataFrame:
    """One row: approved rows, settlement rows, unrecognised, the settlement form most rows have and its share."""
    counts = approved.groupBy("form").agg(F.count("*").alias("n"), F.count_if("settlement").alias("s"), F.min("row").alias("first_row"))
    contest = F.col("form").isin(SETTLEMENT, MIXED)
    total = F.sum(F.when(contest, F.col("n")))
    best = F.max_by(F.struct("form", "n"), F.when(contest, F.struct("n", -F.col("first_row"))))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("approved_rows"), F.coalesce(F.sum("s"), F.lit(0)).alias("settlement_rows"), F.coalesce(F.sum(F.when(F.col("form") == NO_FORM, F.col("n"))), F.lit(0)).alias("unrecognised"),
        best["form"].alias("dominant_form"), rounded_percent(best["n"], total).alias("dominance_pct"),
    )


def ranked_forms(counted: DataFrame) -> DataFrame:
    """Forms by rows, most first; forms are few."""
    return counted.withColumn("place", F.row_number().over(Window.orderBy(F.col("n").desc(), "first_row")))
