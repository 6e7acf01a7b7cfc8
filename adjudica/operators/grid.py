"""Cells as rows (r, c, text, …): guarded writing and cell-by-cell verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.scratch import written
from adjudica.functions.text import column_letter, trim_all

#: fixed values: colours that carry meaning
APPROVED, WRITTEN_FONT, WRITTEN_FILL, REVIEW_FILL = "FF00B050", "FF0000FF", "FFDDEBF7", "FFFFF2CC"


def approved(cell_argb: Column, runs: Column) -> Column:
    """A cell is approved if its own colour, or that of any of its runs, is the approved one."""
    return F.coalesce(cell_argb == APPROVED, F.lit(False)) | F.coalesce(F.exists(runs, lambda r: F.coalesce(r["argb"] == APPROVED, F.lit(False))), F.lit(False))


def write_actions(items: DataFrame, cells: DataFrame, row_count: int) -> DataFrame:
    """items(row, status, summary) with action: missingRow, skippedApproved, written or flagged.

    cells(row, approved) are the summary column's; a row without a cell is not approved.
    """
    both = items.join(cells.select("row", "approved"), "row", "left")
    blank = trim_all(F.coalesce("summary", F.lit(""))) == ""
    action = F.when(F.col("row").isNull() | (F.col("row") < 2) | (F.col("row") > row_count), "missingRow").when(F.coalesce("approved", F.lit(False)), "skippedApproved")
    return both.select(*items.columns, action.when((F.col("status") == "writeable") & ~blank, "written").otherwise("flagged").alias("action"))


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """r, c, before, after, approved (of the cell before) of every cell whose trimmed text differs; a missing cell is
    empty. One shuffle of both sides by (r, c)."""
    b = before.select("r", "c", trim_all(F.coalesce("text", F.lit(""))).alias("before"), "approved")
    a = after.select("r", "c", trim_all(F.coalesce("text", F.lit(""))).alias("after"))
    both = b.join(a, ["r", "c"], "full_outer")
    both = both.select("r", "c", F.coalesce("before", F.lit("")).alias("before"), F.coalesce("after", F.lit("")).alias("after"), F.coalesce("approved", F.lit(False)).alias("approved"))
    return both.where("before <> after")


def range_hashes(cells: DataFrame, rows: int) -> DataFrame:
    """range, n, h, k: of each stretch of so many rows the number of cells that are not empty, and two hashes of them in any
    order. Tasks combine their cells, so a row of each range a task has cells of is all that travels."""
    text = trim_all(F.coalesce("text", F.lit("")))
    some = cells.select(F.floor(F.col("r") / rows).alias("range"), F.xxhash64("r", "c", text).alias("h"), F.xxhash64(F.lit(1), text, "c", "r").alias("k"), text.alias("t")).where("t <> ''")
    # the same cell twice would cancel out under exclusive or: sums do not, and parts of 31 bits do not overflow
    part = F.col("k").bitwiseAND(F.lit((1 << 31) - 1))
    return some.groupBy("range").agg(F.count("*").alias("n"), F.bit_xor("h").alias("h"), F.sum(part).alias("k"))


def _unequal(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys whose hashes differ, or that one side lacks."""
    b, a = (df.select(F.col(key).alias(f"_{key}{i}"), F.struct("n", "h", "k").alias(f"_x{i}")) for i, df in enumerate((before, after)))
    both = b.join(a, F.col(f"_{key}0") == F.col(f"_{key}1"), "full_outer")
    return both.where(~F.col("_x0").eqNullSafe(F.col("_x1"))).select(F.coalesce(f"_{key}0", f"_{key}1").alias(key))


def unequal_ranges(before: DataFrame, after: DataFrame, rows: int = 256, fanout: int = 256) -> DataFrame:
    """range: stretches of so many rows in which the two differ, by a tree of hashes: ranges are compared only below those
    nodes, of so many ranges each, that differ."""
    leaves = [written(range_hashes(df, rows), "ranges") for df in (before, after)]
    nodes = [leaf.groupBy(F.floor(F.col("range") / fanout).alias("node")).agg(F.sum("n").alias("n"), F.bit_xor(F.xxhash64("range", "n", "h", "k")).alias("h"), F.count("*").alias("k")) for leaf in leaves]
    differ = written(_unequal(*nodes, "node"), "nodes")
    below = [leaf.join(differ, F.floor(leaf["range"] / fanout) == differ["node"], "left_semi") for leaf in leaves]
    return _unequal(*below, "range")


def differences_by_range(before: DataFrame, after: DataFrame, rows: int = 256) -> DataFrame:
    """What differences() returns, for copies that are mostly equal: only rows of ranges that differ meet cell by cell, so
    of equal copies nothing but hashes is shuffled."""
    ranges = written(unequal_ranges(before, after, rows), "unequal")

    def own(cells: DataFrame) -> DataFrame:
        return cells.join(ranges, F.floor(cells["r"] / rows) == ranges["range"], "left_semi")

    return differences(own(before), own(after))


def by_column(diff: DataFrame) -> DataFrame:
    """c, letter, n: differing cells per column."""
    return diff.groupBy("c").agg(F.count("*").alias("n")).select("c", column_letter(F.col("c")).alias("letter"), "n")


def verification(diff: DataFrame, summary_column: int, rows_compared: int) -> DataFrame:
    """One row: differences per column (map), unexpected columns, approved cells touched, ok."""
    own = F.col("c") == summary_column
    counts = diff.groupBy("c").agg(F.count("*").cast("int").alias("n"), F.count_if("approved").alias("touched"))
    return counts.agg(
        F.map_from_entries(F.collect_list(F.struct("c", "n"))).alias("differences_by_column"),
        F.count_if(~own).alias("unexpected_columns"), F.coalesce(F.sum(F.when(own, F.col("touched"))), F.lit(0)).alias("approved_cells_touched"),
    ).withColumn("rows_compared", F.lit(rows_compared)).withColumn("ok", (F.col("unexpected_columns") == 0) & (F.col("approved_cells_touched") == 0))


def samples(diff: DataFrame, summary_column: int, limit: int = 6) -> DataFrame:
    """The first differing rows of the summary column, clipped."""
    return diff.where(F.col("c") == summary_column).orderBy("r").limit(limit).select("r", F.substring("before", 1, 60).alias("before"), F.substring("after", 1, 160).alias("after"))
