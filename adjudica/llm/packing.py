"""Bounded-space online packing of token ids into sequences of a fixed length.

A task walks its documents in order and keeps ``open_windows`` windows open. Whole windows of a document leave at once;
its rest goes best-fit into the open window it leaves the least room in. When none fits, the fullest is topped up with
the head of the rest and emitted, so an emitted sequence has no padding. Windows still open at a task's end carry their
ids to a merge, which packs those of ``merge_tasks`` tasks the same way and lays what is left end to end: padding is at
most one part-filled sequence per merge.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm import _common as C
from adjudica.llm.tokens import tokenizer as load_tokenizer

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary, open boolean"
PIECE_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()), ("open", pa.bool_())])
OPEN_WINDOWS, MERGE_TASKS = 16, 64
MERGED = 1 << 62


class _Packer:
    """Windows of ``size`` tokens; pieces are (doc_id, start, ids, doc_tokens)."""

    def __init__(self, size: int, windows: int, first_id: int, with_ids: bool) -> None:
        self.size, self.next_id, self.with_ids = size, first_id, with_ids
        self.open: list[list] = [[] for _ in range(windows)]
        self.room = [size] * windows
        self.out: list[tuple] = []

    def _emit(self, pieces: list, still_open: bool = False) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            raw = ids.tobytes()
            self.out.append((doc, start, len(ids), zlib.crc32(raw), total, self.next_id, at, raw if self.with_ids or still_open else None, still_open))
            at += len(ids)
        self.next_id += 1

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        n = self.size
        while len(ids) >= n:
            self._emit([(doc, start, ids[:n], total)])
            start, ids = start + n, ids[n:]
        while len(ids):
            fits = [r for r in self.room if r >= len(ids)]
            w = self.room.index(min(fits)) if fits else self.room.index(min(self.room))
            put = min(self.room[w], len(ids))
            self.open[w].append((doc, start, ids[:put], total))
            self.room[w] -= put
            start, ids = start + put, ids[put:]
            if self.room[w] == 0:
                self._emit(self.open[w])
                self.open[w], self.room[w] = [], n

    def leave_open(self) -> None:
        for pieces in self.open:
            if pieces:
                self._emit(pieces, still_open=True)

    def close(self) -> None:
        """Lay the open windows end to end, fullest first; only the last sequence may be part-filled."""
        rest = sorted(range(len(self.open)), key=lambda w: self.room[w])
        items = [p for w in rest for p in self.open[w]]
        self.open, self.room = [[]], [self.size]
        for p in items:
            self.add(*p)
        if self.open[0]:
            self._emit(self.open[0])

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*self.out, strict=True), PIECE_ARROW, strict=True)], schema=PIECE_ARROW)
            self.out = []


def _pack(tokenizer: str, size: int, windows: int, end_id: int, with_ids: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_tokenizer(tokenizer).encode
        packer = _Packer(size, windows, TaskContext.get().partitionId() << 32, with_ids)
        for chunk in C.doc_chunks(batches, 2 << 20):
            ids, ends = encode(chunk.column("text"), end_id)
            start = 0
            for doc, end in zip(chunk.column("doc_id").to_pylist(), ends.tolist(), strict=True):
                packer.add(doc, 0, ids[start:end], end - start)
                start = end
            yield from packer.batches()
        packer.leave_open()
        yield from packer.batches()

    return task


def _merge(size: int, windows: int, with_ids: bool):
    def group(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(size, windows, MERGED + (key[0].as_py() << 32), with_ids)
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")]
            for doc, start, ids, total in zip(*cols, strict=True):
                packer.add(doc, start, np.frombuffer(ids, np.uint32), total)
            yield from packer.batches()
        packer.close()
        yield from packer.batches()

    return group


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, open_windows: int = OPEN_WINDOWS, merge_tasks: int = MERGE_TASKS, with_ids: bool = True) -> DataFrame:
    """Pack all documents: one row per piece with doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A document's ids are the tokenizer's, without special tokens, then ``end_id``; null or empty text is the end id
    alone. Each id lies in exactly one piece. ids (little-endian unsigned 32-bit) is null unless ``with_ids``. Rows of
    the same or of no id are packed as rows of their own. No rows give no pieces. tokenizer is a path that every
    executor can read.
    """
    work = C.Scratch(docs.sparkSession, "packing")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = work.write(docs.mapInArrow(_pack(tokenizer, size, open_windows, end_id, with_ids), PIECE), "pieces")
    left = first.where("open").withColumn("task", F.shiftright("sequence_id", 32))
    # a merge reads its windows in a fixed order, so a repeated task makes the same sequences
    left = left.withColumn("merge", F.floor(F.col("task") / merge_tasks).cast("long"))
    left = left.repartition("merge").sortWithinPartitions("merge", "sequence_id", "offset").select("merge", "doc_id", "start", "ids", "doc_tokens")
    merged = left.groupBy("merge").applyInArrow(_merge(size, open_windows, with_ids), PIECE)
    return first.where("not open").unionByName(merged).drop("open")
