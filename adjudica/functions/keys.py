"""The case key NNNNNNN-DD.YYYY.J.TR.OOOO: finding it, its other spellings, its check digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}"
#: the year that marks an invented key
FICTIONAL_YEAR = "2099"


def first_key(text: Column) -> Column:
    """The first key in a text, or null."""
    return F.nullif(F.regexp_extract(text, f"({KEY})", 1), F.lit(""))


def all_keys(text: Column) -> Column:
    """Distinct keys in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({KEY})"), F.lit(1)))


def digits(key: Column) -> Column:
    return F.regexp_replace(key, "[^0-9]", "")


def custom_id(key: Column) -> Column:
    """The key with every other character as an underscore."""
    return F.regexp_replace(key, "[^a-zA-Z0-9]", "_")


def from_custom_id(asked: DataFrame, known: DataFrame, id_col: str = "custom_id") -> DataFrame:
    """asked with the known case_number its id was made from, or null; of several the smallest."""
    made = known.groupBy(custom_id(F.col("case_number")).alias(id_col)).agg(F.min("case_number").alias("case_number"))
    return asked.join(made, id_col, "left")


def check_digits(key: Column) -> Column:
    """The two check digits a key should have; null unless the whole string is a key."""
    d = digits(key)
    base = F.concat(F.substring(d, 1, 7), F.substring(d, 10, 11), F.lit("00")).cast("decimal(38,0)")
    return F.when(F.rlike(key, F.lit(f"^{KEY}$")), F.lpad((98 - base % 97).cast("int").cast("string"), 2, "0"))


def is_valid(key: Column) -> Column:
    """Whether the key has the check digits it should have; false for anything that is no key."""
    return F.coalesce(F.substring(digits(key), 8, 2) == check_digits(key), F.lit(False))


def is_fictional(key: Column) -> Column:
    """An invented key: the marked year and wrong check digits."""
    return F.coalesce(F.rlike(key, F.lit(f"^{KEY}$")) & (F.substring(digits(key), 10, 4) == FICTIONAL_YEAR), F.lit(False)) & ~is_valid(key)
