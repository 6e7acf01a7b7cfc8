"""The most similar name of a catalogue: a prefix and length filtered set join on bigrams, best first.

A name is the set of its bigrams, each with the number of its occurrence, and similarity is Dice's: twice what two sets
share over what they hold. Bigrams stand in one order of rarity. Two sets that share enough share one of the rarest few of
each, and are not too different in size, so names meet by an equi-join on a rare bigram and a class of sizes. The search
goes down in levels: a name that has found a similarity of a level's or more has seen all that could be better, and one
that has not goes on with that bound. The last level has none, so the best similarity is exact however low it is.

Joins of names and entries are by shuffles: Spark takes a written table for as large as its compressed files, and would
send one of 10 MB, with its sets repeated for each bigram, through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.scratch import counted

#: levels below the threshold, as shares of it; at the last any common bigram counts
LEVELS = (1.0, 0.5, 0.0)
#: occurrences of a bigram in a key up to which their rarity is counted; later ones stand first, as the rarest
ORDERED = 8
#: what is taken off before rounding up, so that sums of doubles do not lose a pair
TINY = 1e-9


def _grams(df: DataFrame, key: str, *own: str) -> DataFrame:
    """Rows of a bigram with the number of its occurrence in the key, as one number, for each of own's values."""
    places = F.sequence(F.lit(1), F.length(key) - 1)
    pairs = F.transform(places, lambda i: F.ascii(F.substring(key, i, F.lit(1))).cast("long") * 128 + F.ascii(F.substring(key, i + 1, F.lit(1))))
    counted = df.where(F.length(key) > 1).select(*own, F.explode(pairs).alias("gram")).groupBy(*own, "gram").agg(F.count("*").cast("int").alias("c"))
    return counted.select(*own, F.explode(F.transform(F.sequence(F.lit(1), F.col("c")), lambda k: k.cast("long") * 16384 + F.col("gram"))).alias("token"))


def _wide(size: Column) -> Column:
    """Class of a size: two to a doubling."""
    return F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) * 2 + TINY).cast("int")


def _least_shared(size: Column, level: Column) -> Column:
    """What a set of a size shares at least with one that is similar by the level."""
    return F.greatest(F.lit(1), F.ceil(level * size / (2 - level) - TINY)).cast("int")


def best(names: DataFrame, catalogue: DataFrame, threshold: float) -> DataFrame:
    """key, idx, score of the most similar entry of catalogue(key, idx) for each distinct key of names(key): the first idx
    on ties. Keys hold ASCII characters only. A key that shares no bigram with any entry has no row.

    Below the threshold, which is above 0, the search goes on until the best is certain. Entries of one key are one, that
    of the first idx.
    """
    entry = _grams(catalogue.groupBy("key").agg(F.min("idx").alias("idx")), "key", "idx")
    # a bigram of ASCII is one of 16,384, so at most 131,072 rows are broadcast
    rarity = F.broadcast(entry.where(F.col("token") < (ORDERED + 1) * 16384).groupBy("token").agg(F.count("*").alias("f")))
    f = F.when(F.col("token") < (ORDERED + 1) * 16384, F.col("f")).otherwise(0)
    order = F.struct("f", "token")
    sets = entry.join(rarity, "token", "left").withColumn("f", f).groupBy("idx").agg(F.array_sort(F.collect_list(order)).alias("tokens"))
    sets, seen = counted(sets.select("idx", F.transform("tokens", lambda t: t["token"]).alias("tokens"), F.size("tokens").alias("m")), "sets", widest=F.max("m"))
    known = _grams(names.select("key").distinct(), "key", "key").join(rarity, "token", "left").withColumn("f", f).groupBy("key")
    known = known.agg(F.array_sort(F.collect_list(F.when(F.col("f").isNotNull(), order))).alias("tokens"), F.count("*").cast("int").alias("n"))
    known = known.select("key", F.transform("tokens", lambda t: t["token"]).alias("tokens"), "n", F.lit(0.0).alias("bound"))
    open_, n = counted(known.where(F.size("tokens") > 0), "open", open=F.count("*"))
    found = []
    for share in LEVELS:
        if found and not n["open"]:
            break
        level = threshold * share
        # at the last level whatever is found is certain
        done = F.coalesce(F.col("score") >= level, F.lit(False))
        got = _level(open_, sets, level, seen["widest"] or 1).withColumnRenamed("key", "_key")
        step, n = counted(open_.join(got.hint("merge"), F.col("key") == F.col("_key"), "left").drop("_key"), "level", open=F.count_if(~done))
        found.append(step.where(done).select("key", "idx", "score"))
        open_ = step.where(~done).select("key", "tokens", "n", F.greatest("bound", F.coalesce("score", F.lit(0.0))).alias("bound"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _level(open_: DataFrame, sets: DataFrame, level: float, widest: int) -> DataFrame:
    """key, idx, score of the best pair of each open name, certain where it is at the level or above, or no less than any
    bound the name has; a lower one is that of some pair."""
    bound = F.greatest(F.lit(level), F.col("bound"))
    size = F.size("tokens")
    few = F.greatest(F.lit(0), size - _least_shared(F.col("n"), F.col("s")) + 1)
    low, high = F.ceil(F.col("s") * F.col("n") / (2 - F.col("s")) - TINY), F.least(F.floor((2 - F.col("s")) * F.col("n") / F.greatest(F.col("s"), F.lit(TINY)) + TINY), F.lit(widest))
    mine = open_.withColumn("s", bound).withColumn("classes", F.when(low <= high, F.sequence(_wide(low), _wide(high))).otherwise(F.array().cast("array<int>")))
    mine = mine.select("key", "s", "n", "tokens", "classes", F.posexplode(F.slice("tokens", F.lit(1), few)).alias("i", "token")).select("key", "s", "n", "tokens", "i", "token", F.explode("classes").alias("class"))
    first = F.slice("tokens", F.lit(1), F.col("m") - _least_shared(F.col("m"), F.lit(level)) + 1)
    theirs = sets.select("idx", F.col("m"), F.col("tokens").alias("other"), _wide(F.col("m")).alias("class"), F.posexplode(first).alias("j", "token"))
    met = mine.join(theirs.hint("merge"), ["token", "class"])
    whole = F.col("n") + F.col("m")
    # a pair is taken at its first common bigram: from there on either set has so many left
    left = F.least(F.size("tokens") - F.col("i"), F.col("m") - F.col("j"))
    met = met.where(2 * left >= F.col("s") * whole - TINY)
    met = met.select("key", "idx", "token", whole.alias("whole"), F.array_intersect("tokens", "other").alias("shared")).where(F.get("shared", F.lit(0)) == F.col("token"))
    score = 2.0 * F.size("shared") / F.col("whole")
    return met.groupBy("key").agg(F.max_by(F.struct("idx", score.alias("score")), F.struct(score, -F.col("idx"))).alias("b")).select("key", "b.idx", "b.score")
