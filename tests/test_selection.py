"""Rows at ranks by range histograms, and copies compared by range hashes, against plain versions."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from adjudica.operators import grid, sampling


def picked(spark, rows, schema, order, ranks):
    df = spark.createDataFrame(rows, schema).repartition(5)
    return [(r["rank"], r.k, r.t) for r in sampling.at_ranks(df, [F.col(c) for c in order], ranks).orderBy("rank").collect()]


@pytest.mark.parametrize("few", [5, 2000])
def test_rows_at_ranks(spark, monkeypatch, few):
    monkeypatch.setattr(sampling, "FEW", few)
    monkeypatch.setattr(sampling, "RANGES", 8)
    r = random.Random(few)
    numbers = [(r.choice([0, 7, 7, 7, r.randint(-(10**6), 10**6)]), i) for i in range(900)] + [(2**63 - 1, 1000), (-(2**63) + 1, 1001), (None, 1002), (None, 1003)]
    first = lambda x: (x[0] is not None, x[0] or 0, x[1])
    ranks = [0, 1, 2, 3, 450, 451, 600, 902, 903, 904, 5000, -1]
    want = sorted(numbers, key=first)
    assert picked(spark, numbers, "k long, t int", ["k", "t"], ranks) == [(k, *want[k]) for k in ranks if 0 <= k < len(want)]
    alike = "10000-abcdef-"
    texts = [(r.choice([alike, alike + "x", ""]) + str(r.randint(0, 60)) + r.choice(["", "é", "~~~~~~~~"]), i) for i in range(700)] + [(None, 1), ("", 2), ("\x00", 3), ("zz" * 40 + "1", 4), ("zz" * 40 + "0", 5)]
    want = sorted(texts, key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1]))
    ranks = [0, 1, 2, 100, 333, 334, 335, 700, 703, 704]
    assert picked(spark, texts, "k string, t int", ["k", "t"], ranks) == [(k, *want[k]) for k in ranks]
    days = [(datetime.date(2020, 1, 1) + datetime.timedelta(r.randint(0, 40)), i) for i in range(100)]
    assert picked(spark, days, "k date, t int", ["k", "t"], [0, 50, 99]) == [(k, *sorted(days)[k]) for k in (0, 50, 99)]
    halves = [(x / 2, i) for x, i in ((r.randint(0, 9), i) for i in range(50))]
    assert picked(spark, halves, "k double, t int", ["k", "t"], [3, 49]) == [(k, *sorted(halves)[k]) for k in (3, 49)]
    assert picked(spark, [], "k long, t int", ["k", "t"], [0]) == []


def test_few_passes_and_nothing_written(spark, monkeypatch):
    """A sample of a million rows takes a count, bounds, one histogram and the rows; no table is written."""
    monkeypatch.setattr(sampling, "written", lambda *a: pytest.fail("a table was written"))
    passes = []
    refine = sampling._refined
    monkeypatch.setattr(sampling, "_refined", lambda *a: passes.append(1) or refine(*a))
    df = spark.range(1_000_000).withColumn("k", F.col("id") * 3)
    got = sorted(r.k for r in sampling.uniform_stride(df, [F.col("k")], 25).collect())
    assert got == [min(999_999, int(i * (1_000_000 / 25))) * 3 for i in range(25)] and len(passes) == 1


def cells(spark, rows):
    return spark.createDataFrame(rows, "r long, c int, text string, approved boolean").repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_differences_by_range(spark, seed):
    r = random.Random(seed)
    before = [(i, c, r.choice(["a", " b ", "", None, f"t{i}"]), i % 5 == 0) for i in range(1, 1500) for c in (1, 2)]
    after = [(i, c, (t or "") + r.choice(["", " ", " "]), False) for i, c, t, _ in before]
    for _ in range(r.choice([0, 1, 12])):
        k = r.randrange(len(after))
        after[k] = (*after[k][:2], r.choice(["new", None, "a"]), False)
    for _ in range(r.choice([0, 3])):
        after.pop(r.randrange(len(after)))
    after += r.choice([[], [(9000, 3, "far", False)], [after[3], after[3]]])
    b, a = cells(spark, before), cells(spark, r.sample(after, len(after)))
    want = sorted(map(tuple, grid.differences(b, a).collect()))
    assert sorted(map(tuple, grid.differences_by_range(b, a, rows=16).collect())) == want


def test_equal_copies_meet_by_hashes_alone(spark):
    b = cells(spark, [(i, 1, f"t{i}", False) for i in range(5000)])
    assert grid.unequal_ranges(b, b.withColumn("text", F.concat("text", F.lit(" "))), rows=16, fanout=4).count() == 0
    changed = b.withColumn("text", F.when(F.col("r") == 1234, "x").otherwise(F.col("text")))
    assert [r.range for r in grid.unequal_ranges(b, changed, rows=16, fanout=4).collect()] == [1234 // 16]
    # a cell twice in place of one is a difference of hashes too
    assert grid.unequal_ranges(b, b.unionByName(b.where("r = 7")), rows=16).count() == 1
    assert grid.range_hashes(b, 100).count() == 50
