"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm import _common as C

LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: links a task contracts at once
AT_ONCE = 1_000_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the links a task happens to hold: each node with the smallest one it reaches over them."""
    for part in C.joined_batches(batches, AT_ONCE):
        ends = np.stack([np.asarray(part.column("a")), np.asarray(part.column("b"))])
        nodes, at = np.unique(ends, return_inverse=True)
        a, b = at.reshape(2, -1)
        label = np.arange(len(nodes))
        while True:
            # hang the roots of both ends on the smaller one, then shorten all ways to the roots
            x, y = label[a], label[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            if np.array_equal(low, high):
                break
            np.minimum.at(label, high, low)
            while not np.array_equal(label[label], label):
                label = label[label]
        some = np.flatnonzero(label != np.arange(len(nodes)))
        yield pa.record_batch([pa.array(nodes[some]), pa.array(nodes[label[some]])], schema=LINKS)


def connected(links: DataFrame, work: C.Scratch) -> DataFrame:
    """node, label (the smallest node reachable) for every node of the links (columns a, b; any order).

    Links with a null end, of a node with itself and repeated ones change nothing; no links give no rows. Tasks contract
    the links they hold before every step, so steps are few. A step joins links with one row per node; nodes of very many
    links are told by count, are few by that count, and their rows go to the links by broadcast, so no task has all links
    of a node. Every step is a written table.
    """
    e = links.where("a is not null and b is not null and a != b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    e = work.write(e.mapInArrow(_contracted, "a bigint, b bigint").distinct(), "links")
    while not _is_done(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = work.write(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"), "n"), "least")
        large = C.join_one(both.where("b > a"), "a", least, "node", "n").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = work.write(large.distinct(), "large")
        down = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
        small = large.join(down, F.col("a") == F.col("node")).select(F.explode(F.array(F.struct(F.col("a"), F.col("m")), F.struct(F.col("b").alias("a"), F.col("m").alias("m")))).alias("p"))
        small = small.select(F.col("p.a").alias("a"), F.col("p.m").alias("b")).where("a != b")
        for t in (e, least):
            work.drop(t)
        e = work.write(small.mapInArrow(_contracted, "a bigint, b bigint").distinct(), "small")
        work.drop(large)
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _is_done(e: DataFrame) -> bool:
    """Whether every node hangs on one smaller node, and nothing hangs on a node that hangs."""
    ends = e.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(e.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    return ends.groupBy("node").agg(F.sum("hangs").alias("h"), F.max("holds").alias("o")).where("h > 1 or (h > 0 and o > 0)").isEmpty()
