"""What calls cost, by a small price table; an unknown price is unknown, never free."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.plans.policy import LEGAL, Policy

PRICES = "model string, in_price double, out_price double, write_price double, read_price double"
PRICE_FILE = "default string, models map<string,struct<inputPerMTok:double,outputPerMTok:double,cacheWritePerMTok:double,cacheReadPerMTok:double,source:string>>"


def price_rows(prices: DataFrame, policy: Policy = LEGAL) -> DataFrame:
    """prices(model, input, output, cache_write, cache_read; US$ per million tokens) with cache prices filled in."""
    write = F.coalesce("cache_write", F.col("input") * policy.cache_write_factor)
    read = F.coalesce("cache_read", F.col("input") * policy.cache_read_factor)
    return prices.select("model", F.col("input").cast("double").alias("in_price"), F.col("output").cast("double").alias("out_price"), write.cast("double").alias("write_price"), read.cast("double").alias("read_price"))


def load_prices(spark: SparkSession, path: str | None, policy: Policy = LEGAL) -> tuple[DataFrame, str | None]:
    """(price table, default model) of a JSON file {"default", "models": {name: {inputPerMTok, outputPerMTok, …, source}}}.

    A price says where it comes from; an entry without its source or a price is refused. Without a file nothing is priced.
    """
    if path is None:
        return spark.createDataFrame([], PRICES), None
    file = spark.read.schema(PRICE_FILE).json(path, multiLine=True)
    rows = file.select(F.explode("models").alias("model", "p")).select("model", F.col("p.inputPerMTok").alias("input"), F.col("p.outputPerMTok").alias("output"), F.col("p.cacheWritePerMTok").alias("cache_write"), F.col("p.cacheReadPerMTok").alias("cache_read"), "p.source")
    bad = [r.model for r in rows.where("input is null or output is null or coalesce(source, '') = ''").collect()]
    if bad:
        raise ValueError(f"prices without figures or source: {', '.join(sorted(bad))}")
    return price_rows(rows, policy), file.first()["default"]


def unpriced_warning(model: str | None, prices: DataFrame) -> str | None:
    """What to say where a model has no price; the table is as small as a price list."""
    known = sorted(r.model for r in prices.select("model").collect())
    return None if model in known else f"costs are not reported: no price is known for {json.dumps(model)} (priced: {', '.join(known) or 'none'})"


def priced(usage: DataFrame, prices: DataFrame, discount: float = 1.0) -> DataFrame:
    """usage(model, input_tokens, output_tokens, cache_write_tokens, cache_read_tokens) with cost_usd and priced_with,
    null where the model has no price. Missing token numbers are 0."""
    def part(tokens: str, price: str) -> Column:
        return F.coalesce(F.col(tokens), F.lit(0)) / 1e6 * F.col(price)

    total = part("input_tokens", "in_price") + part("output_tokens", "out_price") + part("cache_write_tokens", "write_price") + part("cache_read_tokens", "read_price")
    both = usage.join(F.broadcast(prices.withColumnRenamed("model", "_model")), F.col("model") == F.col("_model"), "left")
    return both.select(*usage.columns, (total * discount).alias("cost_usd"), F.col("_model").alias("priced_with"))


def total_cost(cost: str = "cost_usd") -> Column:
    """The sum of costs; null as soon as one part has none, 0 for no parts at all."""
    return F.when(F.count(cost) == F.count("*"), F.coalesce(F.sum(cost), F.lit(0.0)))


def total_usage(usage: DataFrame, by: list[str], seq: str) -> DataFrame:
    """Tokens and cost per group; priced_with is that of the last part that has one."""
    sums = [F.sum(c).alias(c) for c in ("input_tokens", "output_tokens", "cache_write_tokens", "cache_read_tokens")]
    last = F.max_by("priced_with", F.when(F.col("priced_with").isNotNull(), F.col(seq)))
    return usage.groupBy(*by).agg(*sums, total_cost().alias("cost_usd"), last.alias("priced_with"))


def format_usd(cost: Column) -> Column:
    return F.when(cost.isNotNull(), F.format_string("US$ %.4f", cost)).otherwise("unpriced")


def format_usage(cost: Column, tokens_in: Column, tokens_out: Column, cached: Column) -> Column:
    """Cost and tokens in a line, with what came from a cache if anything did."""
    hit = F.when(cached > 0, F.concat(F.lit(" (cache hit "), cached.cast("string"), F.lit(")"))).otherwise("")
    return F.concat(format_usd(cost), F.lit(" · in "), tokens_in.cast("string"), F.lit(" / out "), tokens_out.cast("string"), hit)


def format_rate(rate: Column) -> Column:
    return F.when(rate.isNotNull(), F.format_string("%.1f%%", rate)).otherwise("n/a")
