"""Recordings found by key, map or summary, where most rows ask for one text, for one key or for none."""

import collections

import pytest
from pyspark.sql import functions as F

from adjudica.sources import providers

KEY = "{:07d}-11.2099.8.26.0100"
RECORDINGS = [(KEY.format(1), "map one", "sum one"), (KEY.format(1), "map one again", None), (KEY.format(2), "map two", "map one"), (KEY.format(0), "map two", "sum one"), (KEY.format(3), None, "sum three"), (None, "map four", "sum four")]


@pytest.fixture
def shuffled(spark):
    """No join by broadcast that is not asked for, no partitions put together or split."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in was.items():
        spark.conf.set(k, v)


def found(text):
    """By the rules, one text after another."""
    text_is = lambda k: min((r[0] for r in RECORDINGS if text is not None and r[k] == text and r[0]), default=None)
    key = next((r[0] for r in RECORDINGS if text and r[0] and r[0] in text), None)
    return key or text_is(1) or text_is(2)


def test_frequent_texts_and_keys_are_spread(shuffled):
    frequent = ["none"] * 2000 + ["map two"] * 500 + [f"see {KEY.format(2)} of {i}" for i in range(1500)] + [f"see {KEY.format(9)} of {i}" for i in range(300)] + [None] * 200
    texts = frequent + [f"other {i}" for i in range(400)] + ["map one", "map one again", "sum one", "sum three", "map four", "sum four", "", KEY.format(3), "sum one " + KEY.format(8)]
    asked = shuffled.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(16)
    known = shuffled.createDataFrame(RECORDINGS, "case_number string, map string, summary string")
    out = providers.find_recording(asked, known)
    rows = out.select("*", F.spark_partition_id().alias("part")).collect()
    assert {r.id: r.case_number for r in rows} == {i: found(t) for i, t in enumerate(texts)} and len(rows) == len(texts)
    assert max(collections.Counter(r.part for r in rows).values()) < len(texts) / 8
    own = asked.select(F.regexp_extract("text", r"\d{7}-[\d.]+", 0).alias("_key"), "text")
    keys, often = providers._often(own, "_key", "text")
    assert {KEY.format(2), KEY.format(9)} <= set(keys) and {"none", "map two"} <= set(often) and max(len(keys), len(often)) <= 256


def test_nothing_asked_or_nothing_known(spark):
    asked = spark.createDataFrame([(1, "map one"), (2, None)], "id long, text string")
    known = spark.createDataFrame(RECORDINGS, "case_number string, map string, summary string")
    assert providers.find_recording(asked.limit(0), known).count() == 0
    assert {tuple(r) for r in providers.find_recording(asked, known.limit(0)).select("id", "case_number").collect()} == {(1, None), (2, None)}
