"""Stores of documents: what there is without contents, and the contents of those wanted, each read from the store it is in.

Listing is Spark's own scan of a folder, or a manifest. What is wanted comes as rows with a location, so tasks open these
documents and no others, whatever the store holds. As a data source, ``adjudica-documents`` reads a folder with the columns
asked for and the filters on id and path that Spark pushes down.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from adjudica.plans.policy import LEGAL, Kinds
from adjudica.sources import documents
from adjudica.sources.documents import Decoder
from adjudica.sources.providers import in_order

#: bytes of documents a task of the data source reads
TASK_BYTES = 64 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
CONTENTS = "id string, content binary, error string"
TEXTS = "id string, text string, pages int, error string"


def opened(location: str) -> bytes:
    """The bytes at a path or URI."""
    scheme, colon, rest = location.partition(":")
    if not colon or "/" in scheme or len(scheme) < 2:
        with open(location, "rb") as f:
            return f.read()
    if scheme == "file":
        with open("/" + rest.lstrip("/"), "rb") as f:
            return f.read()
    from pyarrow import fs

    host, _, path = rest.lstrip("/").partition("/")
    store, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    with store.open_input_stream(f"{base.rstrip('/')}/{path}") as f:
        return f.read()


def _each(wanted: DataFrame, take: Callable[[bytes], tuple], columns: dict[str, pa.DataType], schema: str, at_once: int) -> DataFrame:
    """Rows of wanted(id, location) with what take makes of the bytes, or with the error; at_once are open in a task."""

    def one(location: str | None) -> tuple:
        try:
            return (*take(opened(location)), None)
        except Exception as e:  # noqa: BLE001  a document that cannot be read is told, the others go on
            return (*[None] * len(columns), f"{type(e).__name__}: {e}")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, locations = batch.column("id").to_pylist(), batch.column("location").to_pylist()
            # documents are large: a batch of its own for every few
            for k in range(0, len(ids), at_once):
                rows = in_order(locations[k : k + at_once], one, at_once)
                parts = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((*columns.values(), pa.string()))]
                yield pa.record_batch([pa.array(ids[k : k + at_once], pa.string()), *parts], names=["id", *columns, "error"])

    return wanted.select("id", "location").mapInArrow(task, schema)


class Located:
    """A store whose listing says where each document is; contents are opened there by tasks."""

    def __init__(self, at_once: int = 2) -> None:
        self.at_once = at_once

    def list(self) -> DataFrame:
        """id, name, path, bytes, kind, case_number, location."""
        raise NotImplementedError

    def located(self, wanted: DataFrame) -> DataFrame:
        """id, location of the wanted(id) that there are, each once; dealt out evenly, since they are few and large."""
        own = self.list().select("id", "location").join(wanted.select("id").distinct(), "id", "left_semi")
        return own.repartition(max(1, int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def read(self, wanted: DataFrame) -> DataFrame:
        """id, content, error of wanted(id): nothing wanted opens nothing."""
        return _each(self.located(wanted), lambda b: (b,), {"content": pa.binary()}, CONTENTS, self.at_once)

    def texts(self, wanted: DataFrame, decode: Decoder) -> DataFrame:
        """id, text, pages, error of wanted(id), decoded where they are read, so contents do not travel."""
        return _each(self.located(wanted), lambda b: tuple(decode(b)), {"text": pa.string(), "pages": pa.int32()}, TEXTS, self.at_once)


class Folder(Located):
    """All files below a folder."""

    def __init__(self, spark: SparkSession, root: str, kinds: Kinds = LEGAL.kinds, at_once: int = 2) -> None:
        super().__init__(at_once)
        self.spark, self.root, self.kinds = spark, root, kinds

    def list(self) -> DataFrame:
        return documents.folder(self.spark, self.root, self.kinds).withColumn("location", F.concat(F.lit(self.root.rstrip("/") + "/"), "path"))


class Manifest(Located):
    """The entries of a manifest; locations without a scheme are below a root."""

    def __init__(self, spark: SparkSession, path: str, root: str, kinds: Kinds = LEGAL.kinds, at_once: int = 2) -> None:
        super().__init__(at_once)
        self.spark, self.path, self.root, self.kinds = spark, path, root, kinds

    def list(self) -> DataFrame:
        at = F.coalesce("location", "path")
        whole = F.when(at.rlike("^([A-Za-z][A-Za-z0-9+.-]+:|/)"), at).otherwise(F.concat(F.lit(self.root.rstrip("/") + "/"), at))
        return documents.manifest(self.spark, self.path, self.kinds).withColumn("location", whole)


class Composite:
    """Stores by name, one after another; an id says which store it is of, and is read there."""

    def __init__(self, stores: dict[str, Located]) -> None:
        self.stores = stores

    def list(self) -> DataFrame:
        return documents.composite({name: s.list() for name, s in self.stores.items()})

    def _routed(self, wanted: DataFrame, read: Callable[[Located, DataFrame], DataFrame]) -> DataFrame:
        out = None
        for name, store in self.stores.items():
            owner = F.lit(f"{name}:")
            own = wanted.where(F.startswith("id", owner)).select(F.expr(f"substring(id, {len(name) + 2})").alias("id"))
            part = read(store, own).withColumn("id", F.concat(owner, "id"))
            out = part if out is None else out.unionByName(part)
        return out

    def read(self, wanted: DataFrame) -> DataFrame:
        return self._routed(wanted, lambda s, w: s.read(w))

    def texts(self, wanted: DataFrame, decode: Decoder) -> DataFrame:
        return self._routed(wanted, lambda s, w: s.texts(w, decode))


# --- as a data source -------------------------------------------------------------------------------------------------
class Files(InputPartition):
    """Documents of one task: (id, bytes, path on disk)."""

    def __init__(self, files: list[tuple[str, int, str]]) -> None:
        self.files = files


class _FilesReader(DataSourceReader):
    def __init__(self, root: str, columns: list[str]) -> None:
        self.root, self.columns = os.path.abspath(unquote(root.removeprefix("file://"))), columns
        self.ids: set[str] | None = None
        self.under = ""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute in (("id",), ("path",)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.ids = values if self.ids is None else self.ids & values
            elif isinstance(f, StringStartsWith) and f.attribute in (("id",), ("path",)) and f.value.startswith(self.under):
                self.under = f.value
            else:
                yield f

    def _found(self) -> Iterator[tuple[str, int, str]]:
        """The files that pass: those named are looked up, without going through the folder."""
        if self.ids is not None:
            for i in sorted(i for i in self.ids if i is not None and i.startswith(self.under)):
                at = os.path.join(self.root, i)
                if os.path.relpath(at, self.root) == i and not i.startswith("../") and os.path.isfile(at):
                    yield i, os.path.getsize(at), at
            return
        for folder, _, names in os.walk(os.path.join(self.root, os.path.dirname(self.under))):
            for name in sorted(names):
                at = os.path.join(folder, name)
                if (i := os.path.relpath(at, self.root)).startswith(self.under) and os.path.isfile(at):
                    yield i, os.path.getsize(at), at

    def partitions(self) -> list[InputPartition]:
        parts, held, size = [], [], 0
        for f in self._found():
            held.append(f)
            size += f[1] + 4096
            if size >= TASK_BYTES:
                parts.append(Files(held))
                held, size = [], 0
        return [*parts, Files(held)] if held or not parts else parts

    def read(self, partition: Files) -> Iterator[tuple]:
        for i, size, at in partition.files:
            known = {"id": i, "path": i, "name": i.rsplit("/", 1)[-1], "bytes": size}
            yield tuple(opened(at) if c == "content" else known[c] for c in self.columns)


class DocumentFiles(DataSource):
    """Files below a folder that driver and executors share: id and path (relative), name, bytes, content.

    A schema with fewer columns reads no more than these: without content no file is opened.
    """

    @classmethod
    def name(cls) -> str:
        return "adjudica-documents"

    def schema(self) -> str:
        return "id string, name string, path string, bytes bigint, content binary"

    def reader(self, schema) -> DataSourceReader:
        return _FilesReader(self.options["path"], [f.name for f in schema.fields])


def scan(spark: SparkSession, root: str, columns: tuple[str, ...] = ("id", "name", "path", "bytes", "content")) -> DataFrame:
    """The data source over a folder, with these columns only and pushed filters."""
    spark.dataSource.register(DocumentFiles)
    spark.conf.set(PUSHDOWN, "true")
    kinds = {"bytes": "bigint", "content": "binary"}
    return spark.read.format("adjudica-documents").schema(", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)).load(root)
