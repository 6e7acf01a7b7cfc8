"""Document scans: a folder tree, a manifest, and several of them one after another."""

from __future__ import annotations

from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.functions import keys
from adjudica.operators.planning import document_kind
from adjudica.plans.policy import LEGAL, Kinds


#: so many wanted files are read by name; more are found by a join over the whole folder
MOST_PATHS = 10_000


def _described(df: DataFrame, kinds: Kinds, *more: str) -> DataFrame:
    key = F.coalesce(keys.first_key(F.col("path")), keys.first_key(F.col("name")))
    return df.select("id", "name", "path", "bytes", document_kind(F.col("name"), kinds).alias("kind"), key.alias("case_number"), *more)


def _base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def folder(spark: SparkSession, root: str, kinds: Kinds = LEGAL.kinds) -> DataFrame:
    """Files below a folder: id, name, path (relative), bytes, kind, case_number. Contents are not read."""
    files, path = _files(spark, root)
    return _described(files.select(path.alias("id"), _base_name(path).alias("name"), path.alias("path"), F.col("length").alias("bytes")), kinds)


def _quoted(s: str) -> str:
    return r"\Q" + s + r"\E"


def _files(spark: SparkSession, root: str) -> tuple[DataFrame, Column]:
    """The files below a folder, and their paths relative to it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    marker = root.rstrip("/").split("://")[-1].lstrip("/")
    return files, F.regexp_replace("path", f"^.*?{_quoted(marker)}/", "")


def folder_contents(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """id, content of the wanted ids only: their paths are looked up without reading any file, then only those are read."""
    files, path = _files(spark, root)
    ids = wanted.select(F.col("id").alias("_id")).distinct()
    listed = files.select(path.alias("_id"), "path").join(ids, "_id")
    paths = [r.path for r in listed.limit(MOST_PATHS + 1).collect()]
    if not paths:
        return spark.createDataFrame([], "id string, content binary")
    if len(paths) <= MOST_PATHS:
        files = spark.read.format("binaryFile").load([p.replace("{", "\\{").replace("[", "\\[").replace("*", "\\*").replace("?", "\\?") for p in paths])
    return files.select(path.alias("id"), "content").join(ids, F.col("id") == F.col("_id"), "left_semi")


def manifest(spark: SparkSession, path: str, kinds: Kinds = LEGAL.kinds) -> DataFrame:
    """Entries of a JSON list of {name, path, bytes, location}, with location; of entries with one path the first stays.

    The file is one array, read in one task, so its entries are numbered in its own order.
    """
    one = spark.read.schema("name string, path string, bytes bigint, location string")
    entries = one.json(path, multiLine=True).coalesce(1).withColumn("_n", F.monotonically_increasing_id())
    first = entries.groupBy("path").agg(F.min_by(F.struct("name", "bytes", "location"), "_n").alias("e"))
    described = first.select(F.col("path").alias("id"), F.col("e.name").alias("name"), "path", F.col("e.bytes").alias("bytes"), F.col("e.location").alias("location"))
    return _described(described, kinds, "location")


def manifest_contents(spark: SparkSession, entries: DataFrame, wanted: DataFrame, root: str) -> DataFrame:
    """id, content of the wanted entries of a manifest: locations below a folder (a path of their own, else the path)."""
    at = F.coalesce("location", "path")
    own = entries.join(wanted.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("_id"), at.alias("_at"))
    files = folder_contents(spark, root, own.select(F.col("_at").alias("id")))
    return own.join(files, F.col("_at") == F.col("id")).select(F.col("_id").alias("id"), "content")


class Decoder(Protocol):
    """What turns a document's bytes into its text and number of pages; none is shipped."""

    def __call__(self, content: bytes) -> tuple[str, int]: ...


def texts_of(contents: DataFrame, decode: Decoder) -> DataFrame:
    """id, text, pages of documents(id, content) by a decoder; a document without bytes has no text and no pages."""

    def task(batches):
        for b in batches:
            got = [decode(c) if c is not None else ("", 0) for c in b.column("content").to_pylist()]
            yield pa.record_batch([b.column("id"), pa.array([t for t, _ in got], pa.string()), pa.array([n for _, n in got], pa.int32())], names=["id", "text", "pages"])

    return contents.select("id", "content").mapInArrow(task, "id string, text string, pages int")


def composite(stores: dict[str, DataFrame]) -> DataFrame:
    """Stores one after another: ids get the store's name in front, priority its place; nothing is dropped."""
    out = None
    for i, (name, df) in enumerate(stores.items()):
        part = df.withColumn("id", F.concat(F.lit(f"{name}:"), F.col("id"))).withColumn("priority", F.lit(i))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no stores")
    return out
