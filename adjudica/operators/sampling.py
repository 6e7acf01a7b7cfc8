"""Ranks over whole tables without one task that sees all rows: even samples, rows at given ranks, and chunks."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.functions.scratch import written


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """df with a rank from 0 over the order: range partitions are numbered apart and shifted by what stands before.

    The ranged rows are written to the shared folder, because both the sizes and the rows must see the same partition
    bounds, which Spark draws from a sample: a lost executor's partitions could be drawn anew with others.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("_part").orderBy(*order)
    parts = written(parts.withColumn("_rn", F.row_number().over(inside) - 1), "ranked")
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    # one row per partition, as many as the session's setting
    return parts.join(F.broadcast(shift), F.col("_part") == F.col("_p")).withColumn(name, F.col("_rn") + F.col("_shift")).drop("_part", "_p", "_rn", "_shift")


#: ranges a pass counts inside one it refines, and rows of a range that are ranked rather than refined
RANGES, FEW = 512, 2000
#: bytes of a text that make one number
STEP = 6
INTEGRAL = ("tinyint", "smallint", "int", "bigint", "date")


@dataclass(frozen=True)
class _Range:
    """Keys that begin with these numbers and go on with one from low to high; so many rows are before, so many in it."""

    begin: tuple[int, ...]
    low: int
    high: int
    before: int
    rows: int


def _digit(key: Column, kind: str, depth: int) -> Column:
    """The key as a number that keeps its order, the part of it at a depth; null comes first."""
    if kind == "string":
        part = F.rpad(F.hex(F.substring(F.encode(key, "utf-8"), 1 + depth * STEP, STEP)), 2 * STEP, "0")
        return F.coalesce(F.conv(part, 16, 10).cast("long"), F.lit(-1))
    number = F.unix_date(key) if kind == "date" else key
    return F.coalesce(number.cast("long"), F.lit(-(1 << 63)))


def _inside(key: Column, kind: str, r: _Range) -> Column:
    where = F.lit(True)
    for depth, value in enumerate(r.begin):
        where = where & (_digit(key, kind, depth) == value)
    return where & _digit(key, kind, len(r.begin)).between(r.low, r.high)


def at_ranks(df: DataFrame, order: list[Column], ranks: list[int], name: str = "rank") -> DataFrame:
    """The rows of df at the given ranks (from 0) of an order, with their rank: nothing is written or sorted as a whole.

    A pass counts rows by ranges of the first order column inside those ranges that hold a wanted rank; passes go on until
    a wanted range has few rows, or rows that only further columns tell apart, which are ranked. The first column is
    integral, a date or a text; nulls come first.
    """
    kind = df.select(order[0].alias("k")).dtypes[0][1]
    if kind != "string" and kind not in INTEGRAL:
        return ranked(df, order, name).where(F.col(name).isin(ranks))
    key = order[0]
    first = _digit(key, kind, 0)
    low, high, n, longest = df.agg(F.min(first), F.max(first), F.count("*"), F.max(F.octet_length(F.encode(key.cast("string"), "utf-8")))).first()
    wanted = sorted({k for k in ranks if 0 <= k < n})
    if not wanted:
        return df.limit(0).withColumn(name, F.lit(0).cast("long"))
    deepest = (longest or 0) // STEP if kind == "string" else 0
    ready, open_ = [], [_Range((), low, high, 0, n)]
    while open_:
        found = _refined(df, key, kind, open_, wanted)
        ready += [r for r in found if r.rows <= FEW or r.low == r.high and len(r.begin) >= deepest]
        more = [r for r in found if not (r.rows <= FEW or r.low == r.high and len(r.begin) >= deepest)]
        # keys that agree so far are told apart by what follows
        open_ = [replace(r, begin=(*r.begin, r.low), low=-1, high=(1 << 8 * STEP) - 1) if r.low == r.high else r for r in more]
    which = F.coalesce(*[F.when(_inside(key, kind, r), F.lit(i)) for i, r in enumerate(ready)])
    before = F.element_at(F.array(*[F.lit(r.before) for r in ready]), F.col("_range") + 1)
    few = df.withColumn("_range", which).where("_range is not null")
    placed = few.withColumn(name, (F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1 + before).cast("long"))
    return placed.where(F.col(name).isin(wanted)).drop("_range")


def _refined(df: DataFrame, key: Column, kind: str, ranges: list[_Range], wanted: list[int]) -> list[_Range]:
    """The parts of ranges that hold wanted ranks; as many rows come back as there are parts with rows."""
    widths = [max(1, -(-(r.high - r.low + 1) // RANGES)) for r in ranges]

    def place(r: _Range, w: int) -> Column:
        # whole-number division of decimals: a range may be as wide as 64 bits
        return F.call_function("div", _digit(key, kind, len(r.begin)).cast("decimal(30,0)") - F.lit(r.low).cast("decimal(20,0)"), F.lit(w).cast("decimal(20,0)")).cast("int")

    part = F.coalesce(*[F.when(_inside(key, kind, r), place(r, w) + i * RANGES) for i, (r, w) in enumerate(zip(ranges, widths, strict=True))])
    counts = {r.part: r.n for r in df.select(part.alias("part")).where("part is not null").groupBy("part").agg(F.count("*").alias("n")).collect()}
    out = []
    for i, (r, w) in enumerate(zip(ranges, widths, strict=True)):
        before = r.before
        for k in range(RANGES):
            if rows := counts.get(i * RANGES + k, 0):
                low = r.low + k * w
                if any(before <= x < before + rows for x in wanted):
                    out.append(_Range(r.begin, low, min(r.high, low + w - 1), before, rows))
                before += rows
    return out


def uniform_stride(df: DataFrame, order: list[Column], size: int) -> DataFrame:
    """An even sample: all rows if there are no more than size, none for size 0 or less, else the rows at
    min(n - 1, floor(i * (n / size))) with the step in double arithmetic."""
    if size <= 0:
        return df.limit(0)
    n = df.count()
    if size >= n:
        return df
    step = float(n) / float(size)
    return at_ranks(df, order, [min(n - 1, int(float(i) * step)) for i in range(size)], name="_rank").drop("_rank")


def chunked(df: DataFrame, order: list[Column], size: int, name: str = "chunk") -> DataFrame:
    """df with the number of its chunk of ``size`` consecutive rows."""
    return ranked(df, order, "_rank").withColumn(name, F.floor(F.col("_rank") / size).cast("long")).drop("_rank")
