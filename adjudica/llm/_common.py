"""Shared pieces: the shared folder, written tables, word hashing and packed exchanges.

Operators written in Python move *packed* rows: ``(bucket int, payload binary)`` where a payload holds columns of a few
thousand entries. Packing keeps the row count of an exchange at tasks x buckets whatever the number of words.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adjudica.functions.scratch import delete, shared_dir

try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim  # noqa: B018  other C libraries have none
except (OSError, AttributeError):
    _libc = None

CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PACKED = "bucket int, payload binary"
PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("payload", pa.binary())])
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: folders of tables this process wrote, by session
_written: dict[int, list[str]] = {}


class Scratch:
    """Tables written to the shared folder by one operator call; they cut lineage, so a lost executor costs one step."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.base, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0
        # texts are long rows: Spark's 10,000 a batch would hold tens of MB twice in every task; a setting of one's own stays
        if spark.conf.get(ARROW_ROWS, "10000") == "10000":
            spark.conf.set(ARROW_ROWS, "2000")
        _written.setdefault(id(spark._jsparkSession), []).append(self.base)

    def write(self, df: DataFrame, tag: str, by: list[str] | None = None) -> DataFrame:
        """Write df and read it back; shuffle files of the step go as soon as the table stands."""
        self.n += 1
        path = f"{self.base}/{self.n:02d}-{tag}"
        was = self.spark.conf.get(CLEAN, "false")
        self.spark.conf.set(CLEAN, "true")
        try:
            out = df.write.option("compression", "zstd")
            (out.partitionBy(*by) if by else out).parquet(path)
        finally:
            self.spark.conf.set(CLEAN, was)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._adjudica_path = path
        return back

    def drop(self, table: DataFrame, part: str = "") -> None:
        """Remove a written table, or one partition of it, that no later step reads."""
        delete(self.spark, f"{table._adjudica_path}/{part}".rstrip("/"))


def finish(spark: SparkSession) -> int:
    """Call once results are written: removes all tables operators wrote for this session and gives Arrow its own batch
    size back; how many folders went. Results that are still lazy can no longer be read."""
    gone = _written.pop(id(spark._jsparkSession), [])
    for base in gone:
        delete(spark, base)
    if spark.conf.get(ARROW_ROWS, "10000") == "2000":
        spark.conf.unset(ARROW_ROWS)
    return len(gone)


def running(work: Scratch, df: DataFrame, order: list[Column], sums: dict[str, Column], tag: str) -> DataFrame:
    """df with, under each name, the sum of a column over all rows that stand before in the order.

    Range partitions are summed apart and shifted by what stands before them, so no task sees all rows; the ranged rows
    are written, because sizes and rows must see the same bounds, which Spark draws from a sample.
    """
    spark = df.sparkSession
    parts = work.write(df.repartitionByRange(buckets_of(spark), *order).withColumn("_part", F.spark_partition_id()), tag)
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, as many as the session's setting
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_all_{k}") for k, c in sums.items()])
    shift = totals.select(F.col("_part").alias("_of"), *[F.coalesce(F.sum(f"_all_{k}").over(before), F.lit(0)).alias(f"_shift_{k}") for k in sums])
    out = parts.join(F.broadcast(shift), F.col("_part") == F.col("_of"))
    return out.select(*df.columns, *[(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_shift_{k}")).alias(k) for k, c in sums.items()])


#: a key with more than this share of all rows, and more than HEAVY_ROWS, is heavy: there are 2,000 such keys at most
HEAVY_SHARE, HEAVY_ROWS = 1 / 2000, 1000


def join_one(many: DataFrame, key: str, one: DataFrame, node: str, count: str) -> DataFrame:
    """many joined with one row per key (a written table), of which the column count says how many rows of many have it.

    Heavy keys are few because of their counts (2,000 of all rows), so theirs are broadcast; the others are shuffled, and
    none of those has many rows.
    """
    rows, most = one.agg(F.coalesce(F.sum(count), F.lit(0)), F.coalesce(F.max(count), F.lit(0))).first()
    limit = max(HEAVY_ROWS, int(rows * HEAVY_SHARE))
    on = F.col(key) == F.col(node)
    if most <= limit:
        return many.join(one, on)
    heavy = one.where(F.col(count) > limit)
    rest = many.join(F.broadcast(heavy.select(F.col(node).alias("_heavy"))), F.col(key) == F.col("_heavy"), "left_anti")
    return many.join(F.broadcast(heavy), on).unionByName(rest.join(one.where(F.col(count) <= limit), on))


def joined_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about so many."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield _joined(held)
            held, n = [], 0
    if held:
        yield _joined(held)


def buckets_of(spark: SparkSession) -> int:
    """Buckets of a packed exchange: the session's shuffle partitions, so it grows with the cluster's own setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def exchange(df: DataFrame, n: int) -> DataFrame:
    """Bring the packed rows of each bucket to the partition of the same number."""
    return df.repartitionById(n, F.col("bucket"))


def words_of(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """Maximal runs of ``[^\\x20\\x09-\\x0D]`` of each text, flattened, and their number per text (null: none)."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    counts = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    flat = lists.flatten()
    counts[np.asarray(pc.binary_length(pc.ascii_trim_whitespace(texts))) == 0] = 0
    keep = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(keep), counts


def hash_words(flat: pa.Array) -> np.ndarray:
    """64-bit hash of every word; each distinct word is hashed once."""
    if len(flat) == 0:
        return np.empty(0, np.uint64)
    d = flat.dictionary_encode()
    table = np.fromiter(map(xxhash.xxh3_64_intdigest, d.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(d.dictionary))
    return table[np.asarray(d.indices)]


MULT = np.uint64(0x9E3779B97F4A7C15)


def power(n: int, mult: np.uint64 = MULT) -> np.uint64:
    """mult to the n, modulo 2**64."""
    return np.uint64(pow(int(mult), n, 1 << 64))


def join_hash(left: np.ndarray, right: np.ndarray, n_right: int, mult: np.uint64 = MULT) -> np.ndarray:
    """Hash of a sequence from the hashes of its two parts; n_right is the number of words of the right part."""
    return left * power(n_right, mult) + right


def rolling(h: np.ndarray, k: int, mult: np.uint64 = MULT) -> np.ndarray:
    """Hash of the k words from each place on (length len(h) - k + 1), built by doubling."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, size, part, width = None, 0, h, 1
    while width <= k:
        if k & width:
            take = part[: len(h) - width + 1]
            if out is None:
                out, size = take, width
            else:
                m = len(h) - size - width + 1
                out, size = join_hash(out[:m], take[size : size + m], width, mult), size + width
        if width * 2 <= k:
            m = len(h) - 2 * width + 1
            part = join_hash(part[:m], part[width : width + m], width, mult)
        width *= 2
    return out[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits over the high ones."""
    x = h ^ (h >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket 0..n-1 by the high bits of the mixed hash."""
    return ((mixed(h) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def id_buckets(ids: np.ndarray, n: int) -> np.ndarray:
    """Bucket of int64 ids."""
    x = ids.astype(np.int64)
    x = x ^ (x.view(np.uint64) >> np.uint64(17)).view(np.int64)
    return np.mod(x, n).astype(np.int32)


def id_bucket(id_col: str, text_col: str, n: int) -> Column:
    """The same as a Spark expression; a row without an id goes by its text."""
    x = F.coalesce(F.col(id_col), F.xxhash64(text_col))
    return F.pmod(x.bitwiseXOR(F.shiftrightunsigned(x, 17)), F.lit(n)).cast("int")


def places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For flattened lists: the list's index and the place within the list of each element."""
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.cumsum(counts) - counts
    return row, np.arange(len(row)) - np.repeat(start, counts)


def _squeeze(a: np.ndarray) -> bytes:
    """Compressed bytes of an integer column whose steps are small: differences, bytes of equal weight side by side."""
    d = np.diff(a.astype(np.int64), prepend=0)
    return pa.compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _expand(b: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(b, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, n).T).view(np.int64).ravel())


def pack(raw: list[np.ndarray], steps: list[np.ndarray]) -> bytes:
    """Columns of equal length to bytes: raw ones as they are (hashes), the others by differences."""
    n = len((raw or steps)[0])
    parts = [pa.py_buffer(np.ascontiguousarray(a)).to_pybytes() for a in raw] + [_squeeze(a) for a in steps]
    head = np.array([n, *[len(p) for p in parts]], np.int64).tobytes()
    return head + b"".join(parts)


def unpack(b: bytes, raw: list, n_steps: int) -> list[np.ndarray]:
    """Columns of pack(); raw: the dtypes of the raw ones."""
    k = len(raw) + n_steps
    head = np.frombuffer(b, np.int64, k + 1)
    at, out = 8 * (k + 1), []
    for i in range(k):
        piece = b[at : at + int(head[i + 1])]
        at += int(head[i + 1])
        out.append(np.frombuffer(piece, raw[i]) if i < len(raw) else _expand(piece, int(head[0])))
    return out


def split_packed(bucket: np.ndarray, n: int, raw: list[np.ndarray], steps: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """One (bucket, payload) for each bucket that has entries; entries keep their order within it."""
    if len(bucket) == 0:
        return
    small = bucket.astype(np.uint16) if n <= 65536 else bucket
    order = np.argsort(small, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=n))
    at = 0
    for b in np.flatnonzero(np.diff(ends, prepend=0)):
        idx = order[at : ends[b]]
        at = ends[b]
        yield int(b), pack([a[idx] for a in raw], [a[idx] for a in steps])


def packed_batches(rows: Iterator[tuple[int, bytes]], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of (bucket, payload) rows, of bounded size."""
    b, p, size = [], [], 0
    for bucket, payload in rows:
        b.append(bucket)
        p.append(payload)
        size += len(payload)
        if size >= most:
            yield pa.record_batch([pa.array(b, pa.int32()), pa.array(p, pa.binary())], schema=PACKED_ARROW)
            b, p, size = [], [], 0
    if b:
        yield pa.record_batch([pa.array(b, pa.int32()), pa.array(p, pa.binary())], schema=PACKED_ARROW)


def gather(batches: Iterator[pa.RecordBatch], raw: list, n_steps: int) -> list[np.ndarray] | None:
    """All columns of the packed rows of a partition, joined; None if it has none."""
    got = [unpack(p, raw, n_steps) for batch in batches for p in batch.column("payload").to_pylist()]
    release()
    return [np.concatenate(c) for c in zip(*got, strict=True)] if got else None


def doc_chunks(batches: Iterator[pa.RecordBatch], most: int = 4 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of a table with a column of texts, cut or joined so that each holds about ``most`` bytes of it."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        part = (np.cumsum(lengths) - lengths) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            held.append(batch.slice(a, b - a))
            size += int(lengths[a:b].sum())
            if size >= most:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)
    held.clear()
    release()


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def release() -> None:
    """Give memory that is free back to the system: a Python worker stays when its task is done, and what it keeps is
    missing beside it."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as int64 and whether each is there (null: 0 and False)."""
    return np.asarray(pc.fill_null(column, 0)).astype(np.int64), np.asarray(column.is_valid())


def text_of_words(flat: pa.Array, keep: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The kept words of each list joined by one space."""
    row, _ = places(counts)
    left = np.bincount(row[keep], minlength=len(counts))
    offsets = pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, flat.filter(pa.array(keep))), " ")
