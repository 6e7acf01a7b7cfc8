"""Which case a document belongs to, and which cases have documents, under ever looser keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions import keys
from adjudica.functions.text import let, rounded_percent

DIGITS = 20
#: up to this number of keys (20 characters each) are broadcast
BROADCAST_KEYS = 200_000


def _runs(docs: DataFrame) -> DataFrame:
    """Every stretch of 20 digits in a document's bare digits: a contains join as an equi-join."""
    def stretches(bare: Column) -> Column:
        starts = F.when(F.length(bare) >= DIGITS, F.sequence(F.lit(1), F.length(bare) - (DIGITS - 1))).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.substring(bare, i, F.lit(DIGITS))))

    return docs.select("id", F.explode(let(keys.digits(F.concat_ws(" ", "path", "name")), stretches)).alias("run"))


def _known_runs(docs: DataFrame, keys_: DataFrame) -> DataFrame:
    """The stretches of documents that are some key's digits (column run): the keys go to the documents while they are
    few, so nothing else of the stretches is shuffled; beyond that both sides are."""
    wanted = keys_.select("run").distinct()
    few = wanted.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return _runs(docs).join(F.broadcast(wanted) if few else wanted, "run", "left_semi")


def attribute(docs: DataFrame, cases: DataFrame) -> DataFrame:
    """docs(id, path, name) with case_number: the key in the path, else in the name, else the first known case
    (by ``ord``) whose digits stand in path and name; null where none does. cases(case_number, ord)."""
    own = docs.withColumn("own", F.coalesce(keys.first_key(F.col("path")), keys.first_key(F.col("name"))))
    known = cases.select(F.col("case_number").alias("known"), "ord", keys.digits(F.col("case_number")).alias("run"))
    best = _known_runs(own.where("own is null"), known).join(known, "run").groupBy("id").agg(F.min_by("known", "ord").alias("by_digits"))
    return own.join(best, "id", "left").withColumn("case_number", F.coalesce("own", "by_digits")).drop("own", "by_digits")


def covered(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """targets(case_number) with by_filename, by_path, by_digits: whether some document has it under that key."""
    t = targets.select("case_number").distinct()
    found = docs.select(F.explode(F.array(F.struct(keys.first_key(F.col("name")).alias("k"), F.lit(1).alias("n")), F.struct(keys.first_key(F.col("path")).alias("k"), F.lit(0).alias("n")))).alias("p"))
    found = found.select(F.col("p.k").alias("case_number"), "p.n").where("case_number is not null").groupBy("case_number").agg(F.max("n").alias("named"))
    t_runs = t.withColumn("run", keys.digits(F.col("case_number")))
    runs = _known_runs(docs, t_runs).select("run").distinct()
    by_digits = t_runs.join(runs, "run", "left_semi").select("case_number", F.lit(True).alias("hit"))
    out = t.join(found, "case_number", "left").join(by_digits, "case_number", "left")
    return out.select("case_number", (F.coalesce("named", F.lit(0)) == 1).alias("by_filename"), F.col("named").isNotNull().alias("by_path"), F.coalesce("hit", F.lit(False)).alias("by_digits"))


def _key_rows(counts: list[tuple[str, Column]]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(k).alias("key"), c.alias("covered")) for i, (k, c) in enumerate(counts)])).alias("r")


def progression(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per key: targets, covered, coverage_pct (0 without targets)."""
    c = covered(docs, targets)
    sums = c.agg(F.count("*").alias("targets"), *[F.count_if(f"by_{k}").alias(k) for k in ("filename", "path", "digits")])
    out = sums.select("targets", _key_rows([(k, F.col(k)) for k in ("filename", "path", "digits")]))
    return out.select("r.step", "r.key", "targets", "r.covered", F.coalesce(rounded_percent(F.col("r.covered"), F.col("targets")), F.lit(0.0)).alias("coverage_pct"))


def unattributable(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """id and no_filename, no_path, no_digits: documents that a key leaves with no case at all."""
    runs = targets.select(keys.digits(F.col("case_number")).alias("run")).distinct()
    holds = _known_runs(docs, runs).select("id").distinct().withColumn("hit", F.lit(True))
    name, path = keys.first_key(F.col("name")).isNull(), keys.first_key(F.col("path")).isNull()
    both = docs.join(holds, "id", "left")
    return both.select("id", name.alias("no_filename"), (name & path).alias("no_path"), (name & path & F.col("hit").isNull()).alias("no_digits")).where("no_filename")


def indexed(cases: DataFrame, row: str = "row") -> DataFrame:
    """case_number, ord: known cases in the order of their rows; a case in several rows has its first."""
    return cases.groupBy("case_number").agg(F.min(row).alias("ord"))
