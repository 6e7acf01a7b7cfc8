"""Mixing sources to target weights by Sainte-Lague apportionment; DataFrame functions only.

A source's target is its share of the wanted total by weight, held at ``most`` times its size. Targets become equal-token
blocks of ``block`` words: first to sources, then within a source to its shards, each time by highest quotients
votes / (2 * seat - 1). A shard lays its documents end to end in a seeded order, as a circle; the blocks of its quota
follow one another from a seeded place on, so a quota is met to the word, and at most two documents of a shard are cut.

The quotients that are ranked lie between two divisors that provably enclose the last seat (``_open``), about five a row,
so the apportionment is the exact one whatever the votes. Sources are ranked over range partitions, shards within their
source. Work per document is one shuffle of a narrow row by (source, shard); the number of shards of a source and the
words of a shard both grow with the square root of the source, so neither a source with a third of all rows nor a very
large corpus makes one large task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.llm import _common as C

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
#: sources up to this number are broadcast (under 100 bytes a row)
BROADCAST_SOURCES = 20_000
#: words of a source that would be one shard; n times as many words are sqrt(n) shards
SHARD_WORDS = 1024
#: largest block in words; smaller where a target is so small that it would be fewer than LEAST_BLOCKS
BLOCK, LEAST_BLOCKS = 1024, 64


def _seeded(seed: int, *parts: Column) -> Column:
    """A number from 0 to 2**60 - 1 that looks random, the same on every engine."""
    text = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _targets(work: C.Scratch, sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target: weights repeat over sources in code point order, null last; excess is reshared."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = C.running(work, totals, [F.col("source").asc_nulls_last()], {"place": F.lit(1)}, "names")
    t = named.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
    t = t.withColumn("cap", F.lit(most) * F.col("source_size")).withColumn("level", F.col("cap") / F.col("weight"))
    order = [F.col("level"), F.col("source").asc_nulls_last()]
    t = C.running(work, t.drop("place"), order, {"caps": F.col("cap"), "weights": F.col("weight")}, "levels")
    everything, open_weight = t.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    fill = F.try_divide(F.lit(share) * F.lit(everything) - F.col("caps"), F.lit(open_weight) - F.col("weights"))
    first_open = F.min(F.when(F.col("level") > fill, F.struct("level", F.col("source").isNull().alias("last"), "source", fill.alias("fill"))))
    level = t.agg(first_open["fill"].alias("fill")).first()[0]
    target = F.col("cap") if level is None else F.when(F.col("level") <= level, F.col("cap")).otherwise(F.lit(level) * F.col("weight"))
    return t.select("source", "source_size", target.alias("target"))


def _open(t: DataFrame, votes: str, total: Column, rows: Column, house: Column, full: float, at_full: Column) -> DataFrame:
    """t (with ``_cap``) with ``_house``, ``_sure`` and ``_last``: seats a row has for certain, and may have at most.

    A row has floor(votes / d + 1/2) seats at divisor d, at most _cap, and the last seat stands at the divisor where they
    are as many as the house. With n rows, those are at most total / d + n / 2, and, as _cap >= votes / full - 1, at
    least total / d - 2 n for d >= full; so the divisor lies between max(full, total / (house + 2 n)) and
    total / (house - n / 2). One seat more on both sides covers rounding. A house above the seats at ``full`` is cut to
    those (``at_full``): every row then has its votes / full, rounded.
    """
    seats = lambda d: F.floor(F.try_divide(F.col(votes), d) + 0.5)
    t = t.withColumn("_house", F.least(house, at_full))
    low = F.greatest(F.lit(float(full)), F.try_divide(total, F.col("_house") + 2 * rows))
    high = F.when(F.col("_house") > rows / 2, F.try_divide(total, F.col("_house") - rows / 2))
    t = t.withColumn("_sure", F.greatest(F.lit(0), F.least(F.coalesce(seats(high), F.lit(0)), F.col("_cap")) - 1).cast("long"))
    return t.withColumn("_last", F.greatest(F.col("_sure"), F.least(F.coalesce(seats(low), F.lit(0)) + 1, F.col("_cap"))).cast("long"))


def _quotients(t: DataFrame, votes: str) -> DataFrame:
    """One row per seat a row may win, with its quotient; a row without any keeps one that wins nothing."""
    seat = F.explode(F.sequence(F.col("_sure") + 1, F.greatest(F.col("_last"), F.col("_sure") + 1))).alias("_seat")
    q = t.select("*", seat).withColumn("_fits", (F.col("_seat") <= F.col("_last")) & (F.col(votes) > 0))
    return q.withColumn("_q", F.when(F.col("_fits"), F.col(votes) / (2 * F.col("_seat") - 1)).otherwise(-1.0))


def _won(q: DataFrame, rank: Column, free: Column, keys: list[str]) -> DataFrame:
    won = q.withColumn("_won", (F.col("_fits") & (rank < free)).cast("long"))
    return won.groupBy(*keys, "_sure").agg(F.sum("_won").alias("_won")).select(*keys, (F.col("_sure") + F.col("_won")).alias("seats"))


def _rounded(votes: str, full: float) -> Column:
    return F.least(F.floor(F.col(votes) / full + 0.5), F.col("_cap"))


def apportion(work: C.Scratch, t: DataFrame, name: str, votes: str, house: int | None, cap: Column, full: float) -> DataFrame:
    """t with ``seats``: Sainte-Lague seats of all rows, house in all (None: all votes / full, rounded), none above cap.

    name: what decides between equal quotients, smallest first, null last. cap must be at least votes / full - 1.
    """
    keys = t.columns
    t = t.withColumn("_cap", cap.cast("long"))
    n, total, at_full = t.agg(F.count("*"), F.coalesce(F.sum(votes), F.lit(0)).cast("double"), F.coalesce(F.sum(_rounded(votes, full)), F.lit(0))).first()
    house = int(total / full + 0.5) if house is None else house
    t = _open(t, votes, F.lit(total), F.lit(n), F.lit(house).cast("long"), full, F.lit(at_full).cast("long"))
    sure = t.agg(F.coalesce(F.sum("_sure"), F.lit(0))).first()[0]
    ranked = C.running(work, _quotients(t, votes), [F.col("_q").desc(), F.col(name).asc_nulls_last(), F.col("_seat")], {"_rank": F.lit(1)}, "quotients")
    return _won(ranked, F.col("_rank"), F.lit(min(house, at_full) - sure), keys)


def apportion_within(t: DataFrame, group: str, name: str, votes: str, house: Column, cap: Column, full: float) -> DataFrame:
    """The same within each group; the group's rows are sorted in one task."""
    keys = t.columns
    every = Window.partitionBy(group)
    t = t.withColumn("_cap", cap.cast("long")).withColumn("_wanted", house.cast("long"))
    t = _open(t, votes, F.sum(votes).over(every).cast("double"), F.count("*").over(every), F.col("_wanted"), full, F.sum(_rounded(votes, full)).over(every))
    t = t.withColumn("_free", F.col("_house") - F.sum("_sure").over(every))
    rank = F.row_number().over(every.orderBy(F.col("_q").desc(), name, "_seat")) - 1
    return _won(_quotients(t, votes).withColumn("_rank", rank), F.col("_rank"), F.col("_free"), keys)


def plan(docs: DataFrame, seed: int = 17, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """How many words of each document the mix takes.

    Returns doc_id, source, the columns of ``keep``, size (words ``[^\\x20\\x09-\\x0D]+``; null text: 0), source_size,
    target, shard_size, begin (the document's first word in its shard), full (times the whole shard is taken), start and
    rest (the stretch of the circle that is taken once more) and taken (words, repeats counted; never above
    ceil(most) * size). Null sources form one source, the last. Rows of the same id are separate rows. An empty table
    gives an empty one.
    """
    spark = docs.sparkSession
    work = C.Scratch(spark, "mixing")
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    sizes = docs.select(*[F.col(k).alias(f"keep_{k}") for k in keep], F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), _seeded(seed, key).alias("at"))
    if not keep:
        sizes = work.write(sizes, "sizes")
    sources = work.write(_targets(work, sizes, weights, share, most), "targets")
    n_sources, least = sources.agg(F.count("*"), F.min(F.when(F.col("target") > 0, F.col("target")))).first()
    block = int(min(BLOCK, max(1, (least or 0) // LEAST_BLOCKS)))
    sources = apportion(work, sources, "source", "target", None, F.floor(F.lit(most) * F.col("source_size") / block), block)
    shards = F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("source_size") / SHARD_WORDS))).cast("long")
    sources = work.write(sources.withColumn("shards", shards), "quotas").withColumnRenamed("source", "name")

    def hint(t: DataFrame) -> DataFrame:
        return F.broadcast(t) if n_sources <= BROADCAST_SOURCES else t

    placed = sizes.join(hint(sources), F.col("source").eqNullSafe(F.col("name"))).withColumn("shard", F.col("at") % F.col("shards")).drop("name", "shards", "seats")
    totals = placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size")).join(hint(sources.select("name", "seats")), F.col("source").eqNullSafe(F.col("name")))
    totals = totals.select("source", "shard", "shard_size", F.col("seats").alias("house"))
    quotas = apportion_within(totals, "source", "shard", "shard_size", F.col("house"), F.floor(F.lit(most) * F.col("shard_size") / block), block / most)
    words = F.col("seats") * F.lit(block)
    quotas = quotas.select(F.col("source").alias("name"), F.col("shard").alias("of"), "shard_size", F.coalesce(F.floor(F.try_divide(words, F.col("shard_size"))), F.lit(0)).cast("long").alias("full"), F.coalesce(F.try_mod(words, F.col("shard_size")), F.lit(0)).cast("long").alias("rest"), F.coalesce(F.try_mod(_seeded(seed, F.coalesce("source", F.lit("")), F.col("shard")), F.col("shard_size")), F.lit(0)).alias("start"))
    quotas = work.write(quotas, "shards")

    run = Window.partitionBy("source", "shard").orderBy("at", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("begin", F.coalesce(F.sum("size").over(run), F.lit(0)))
    placed = placed.join(quotas, F.col("source").eqNullSafe(F.col("name")) & (F.col("shard") == F.col("of")))
    head, tail = stretches()
    taken = F.col("full") * F.col("size") + head["n"] + tail["n"]
    kept = [F.col(f"keep_{k}").alias(k) for k in keep]
    return placed.select("doc_id", "source", *kept, "size", "source_size", "target", "shard_size", "begin", "full", "start", "rest", taken.alias("taken"))


def stretches() -> tuple[Column, Column]:
    """(first word, n) of the document's words before the circle's end and after it that are taken once more."""

    def common(a: Column, z: Column) -> Column:
        first = F.greatest(F.col("begin"), a)
        return F.struct((first - F.col("begin")).alias("first"), F.greatest(F.least(F.col("begin") + F.col("size"), z) - first, F.lit(0)).alias("n"))

    end = F.col("start") + F.col("rest")
    return common(F.col("start"), F.least(end, F.col("shard_size"))), common(F.lit(0), end - F.col("shard_size"))


def materialised(taken: DataFrame, text: str) -> DataFrame:
    """The rows of a mix with texts: plan() rows that kept ``text``, once per whole taking and once for a part.

    The part is the words of the document in the stretch that is taken once more, joined by one space. Documents of which
    nothing is taken are gone; one without words is no part of a mix.
    """
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    one, other = stretches()
    cut = lambda s: F.slice(words, (s["first"] + 1).cast("int"), s["n"].cast("int"))
    # the stretch beyond the circle's end stands first in the document
    part = F.array_join(F.concat(F.when(other["n"] > 0, cut(other)).otherwise(F.array().cast("array<string>")), F.when(one["n"] > 0, cut(one)).otherwise(F.array().cast("array<string>"))), " ")
    rest = F.col("taken") - F.col("full") * F.col("size")
    whole = F.array_repeat(F.col(text), F.when(F.col("size") > 0, F.col("full")).otherwise(0).cast("int"))
    texts = F.when((F.col("size") > 0) & (rest == F.col("size")), F.concat(whole, F.array(F.col(text)))).when((F.col("size") > 0) & (rest > 0), F.concat(whole, F.array(part))).otherwise(whole)
    others = [c for c in taken.columns if c != text]
    return taken.withColumn("_texts", texts).select(*others, F.explode("_texts").alias(text))
