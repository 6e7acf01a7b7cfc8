"""Free names snapped onto a closed catalogue: exact by normalised key, else the most similar above a threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.functions.scratch import written
from adjudica.functions.text import normalise_key
from adjudica.operators import similarity
from adjudica.plans.policy import LEGAL


def load(spark: SparkSession, path: str, field: str = "claims") -> DataFrame:
    """canonical, idx of a JSON file that lists the names under a field, in its order; the form match() takes."""
    file = spark.read.schema(f"`{field}` array<string>").json(path, multiLine=True)
    return file.select(F.posexplode(field).alias("idx", "canonical")).select("canonical", "idx")


def match(names: DataFrame, catalogue: DataFrame, name: str = "name", threshold: float = LEGAL.match_threshold) -> DataFrame:
    """name, canonical, method (exact, fuzzy, none) and score for each distinct name. catalogue(canonical, idx).

    The best score wins, the first catalogue entry on ties; equal keys in the catalogue leave the last. Below the
    threshold canonical is null and the score stays. A null name, and one that shares no bigram with any entry, has
    score 0. Catalogues of any size take the same way.
    """
    entries = catalogue.select("canonical", "idx", normalise_key(F.col("canonical")).alias("key"))
    exact = entries.groupBy("key").agg(F.max_by("canonical", "idx").alias("exact"))
    keyed = names.select(name).distinct().withColumn("key", normalise_key(F.col(name)))
    looked = written(keyed.join(exact.hint("merge"), "key", "left"), "looked")
    best = similarity.best(looked.where("exact is null").select("key"), entries, threshold)
    fuzzy = best.join(entries.select("idx", F.col("canonical").alias("near")).hint("merge"), "idx").select(F.col("key").alias("_key"), "near", F.col("score").alias("near_score"))
    out = looked.join(fuzzy.hint("merge"), F.col("key") == F.col("_key"), "left")
    hit = F.col("near_score") >= threshold
    return out.select(
        name,
        F.when(F.col("exact").isNotNull(), F.col("exact")).when(hit, F.col("near")).alias("canonical"),
        F.when(F.col("exact").isNotNull(), "exact").when(hit, "fuzzy").otherwise("none").alias("method"),
        F.when(F.col("exact").isNotNull(), 1.0).otherwise(F.coalesce("near_score", F.lit(0.0))).alias("score"),
    )


def repair(claims: DataFrame, catalogue: DataFrame, sentinel: str = LEGAL.not_identified, threshold: float = LEGAL.match_threshold) -> DataFrame:
    """claims(…, raw_claim, canonical_claim) with the canonical name where one is found: looked up by the canonical
    name given, or by the raw one where that is the sentinel; without a match the given name stays."""
    base = claims.withColumn("_base", F.when(F.col("canonical_claim") == sentinel, F.col("raw_claim")).otherwise(F.col("canonical_claim")))
    found = match(base.select(F.col("_base").alias("name")), catalogue, threshold=threshold).select(F.col("name").alias("_name"), "canonical")
    out = base.join(found, F.col("_base") == F.col("_name"), "left")
    return out.withColumn("canonical_claim", F.coalesce("canonical", "canonical_claim")).select(*claims.columns)
