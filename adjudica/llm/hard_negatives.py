"""Hard negatives by distributed radix selection: histograms of integer scores instead of sorted candidates.

Every anchor's positives, and every anchor-positive window's negatives, are the first k rows of an order by score and id
that no task and no sort ever holds. A pass over the rows counts, for each window, its rows by the leading digit of their
distance from the window's top; the counts of all tasks are added up, the digit that holds the kth row is located, and the
next pass counts only that digit's rows by their next digit, until few rows are left. Rows of one score are told apart by
the digits of their ids in the same way. Then one pass gathers the rows that qualify.

Anchors are a stated set of rows against all rows. They are dealt into blocks of bounded size; a block's vectors and
windows go to every task, and rows are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.llm import _common as C

#: digits have 8 bits
BITS = 8
#: a located digit of at most so many rows needs no further pass
FEW = 32
#: components of a block's anchors; a short anchor counts as ANCHOR of them, so a block has 4,096 anchors at most
BLOCK, ANCHOR = 1 << 19, 1 << 7
#: scores a task looks at at once
AT_ONCE = 1 << 19
LAST = np.uint64(2**64 - 1)
MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def rows_of(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vector of the rows of vectors(vec_id, label, embedding) that take part: none of the three is null,
    and no component is null or not finite."""
    kind = dict(vectors.dtypes)["embedding"]
    vector = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vector.alias("vector")).dropna()
    return own.where(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def whole(vectors: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, components) by length of vector: a component x is floor(256 x), held where a score would not fit 62 bits."""
    sizes = np.asarray(pc.list_value_length(vectors)).astype(np.int64)
    flat = np.asarray(vectors.flatten()).astype(np.float64)
    begins = np.cumsum(sizes) - sizes
    out = []
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        most = math.isqrt((1 << 62) // max(size, 1))
        with np.errstate(over="ignore"):
            out.append((rows, np.clip(np.floor(256 * flat[begins[rows][:, None] + np.arange(size)]), -most, most)))
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles where all sums fit their 53 bits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return a @ b.T if most < 2**53 else a.astype(np.int64) @ b.T.astype(np.int64)


@dataclass
class Anchors:
    vec_id: np.ndarray
    label: np.ndarray
    by_size: dict[int, tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(rows: pa.Table) -> Anchors:
        rows = rows.combine_chunks()
        column = rows.column("vector").combine_chunks()
        parts = whole(column) if rows.num_rows else []
        return Anchors(np.asarray(rows.column("vec_id")).astype(np.int64), np.asarray(rows.column("label")).astype(np.int64), {m.shape[1]: (at, m) for at, m in parts})


@dataclass
class Search:
    """For each window (anchor, from the score top down to low) how far the search for its first ``need`` rows is.

    Rows above ``high`` are known to qualify; the kth is from high to low. Where by_id is set high equals low, and the kth
    has an id (counted from the smallest id there is) from id_low to id_high.
    """

    anchor: np.ndarray
    top: np.ndarray
    low: np.ndarray
    need: np.ndarray
    same: bool
    first_id: int
    last_id: int
    high: np.ndarray = field(init=False)
    by_id: np.ndarray = field(init=False)
    id_low: np.ndarray = field(init=False)
    id_high: np.ndarray = field(init=False)
    open: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = len(self.anchor)
        self.high, self.open, self.by_id = self.top.copy(), self.low <= self.top, np.zeros(n, bool)
        self.id_low, self.id_high = np.zeros(n, np.uint64), np.full(n, LAST)

    def shifts(self) -> np.ndarray:
        """Bits below the digit of this pass."""
        wide = np.where(self.by_id, self.id_high - self.id_low, (self.high - self.low).astype(np.uint64))
        return np.array([max(0, int(w).bit_length() - BITS) for w in wide], np.uint64)

    def locate(self, window: np.ndarray, digit: np.ndarray, before: np.ndarray, inside: np.ndarray, total: np.ndarray) -> None:
        """Take in the digit that holds the kth row, the rows before and in it, and all rows of each window.

        A window that has no more rows than it needs is wanted whole, and one that is not named has none.
        """
        shift, was_open = self.shifts(), self.open.copy()
        self.open[:] = False
        short = total < self.need[window]
        window, digit, before, inside = (x[~short] for x in (window, digit, before, inside))
        self.need[window] -= before
        step, width = digit.astype(np.uint64) << shift[window], (np.uint64(1) << shift[window]) - np.uint64(1)
        ids = self.by_id[window]
        w, s, d = window[~ids], step[~ids].astype(np.int64), width[~ids].astype(np.int64)
        self.high[w] -= s
        self.low[w] = np.maximum(self.low[w], self.high[w] - d)
        v, s, d = window[ids], step[ids], width[ids]
        self.id_low[v] += s
        self.id_high[v] = np.minimum(self.id_high[v], self.id_low[v] + d)
        more = (inside > FEW) & was_open[window]
        exact = shift[window] == 0
        self.open[window[more & ~(exact & ids)]] = True
        turn = window[more & exact & ~ids]
        self.by_id[turn] = True
        self.id_high[turn] = np.uint64(self.last_id - self.first_id)


def _candidates(batch: pa.RecordBatch, anchors: Anchors, s: Search, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, score, vec_id) of the rows of a batch whose score with a window's anchor is from low to high."""
    ids, labels = (np.asarray(batch.column(c)).astype(np.int64) for c in ("vec_id", "label"))
    n = len(anchors.vec_id)
    least, most = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(least, s.anchor, low)
    np.maximum.at(most, s.anchor, high)
    count = np.bincount(s.anchor, minlength=n)
    begins = np.cumsum(count) - count  # windows are in the order of their anchors
    for rows, vectors in whole(batch.column("vector")):
        if vectors.shape[1] not in anchors.by_size:
            continue
        own, matrix = anchors.by_size[vectors.shape[1]]
        step = max(1, AT_ONCE // len(own))
        for k in range(0, len(rows), step):
            part = rows[k : k + step]
            score = products(vectors[k : k + step], matrix)
            fit = (score >= least[own]) & (score <= most[own])
            alike = labels[part][:, None] == anchors.label[own]
            fit &= alike & (ids[part][:, None] != anchors.vec_id[own]) if s.same else ~alike
            r, a = np.nonzero(fit)
            got, at = score[r, a].astype(np.int64), own[a]
            each = count[at]
            w = np.repeat(begins[at], each) + C.places(each)[1]
            got, who = np.repeat(got, each), np.repeat(ids[part[r]], each)
            inside = (got >= low[w]) & (got <= high[w])
            yield w[inside], got[inside], who[inside]


def _counting(anchors: Anchors, s: Search, n_buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that counts its rows by window and digit."""
    shift = s.shifts()
    low, high = np.where(s.open, s.low, 1), np.where(s.open, s.high, 0)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(s.anchor) << BITS, np.int64)
        for batch in batches:
            for w, score, who in _candidates(batch, anchors, s, low, high):
                at = (who - s.first_id).view(np.uint64)
                own = ~s.by_id[w] | ((at >= s.id_low[w]) & (at <= s.id_high[w]))
                w, score, at = w[own], score[own], at[own]
                digit = np.where(s.by_id[w], at - s.id_low[w], (s.high[w] - score).astype(np.uint64)) >> shift[w]
                np.add.at(counts, (w << BITS) + digit.astype(np.int64), 1)
        some = np.flatnonzero(counts)
        w, digit = (some >> BITS).astype(np.int32), (some & ((1 << BITS) - 1)).astype(np.int32)
        yield from C.packed_batches(C.split_packed((w % n_buckets).astype(np.int64), n_buckets, [w, digit, counts[some]], []))

    return task


def _locating(need: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that adds up the counts of its windows and finds the digit of the kth row of each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = C.gather(batches, [np.int32, np.int32, np.int64], 0)
        if got is None:
            return
        window, at = np.unique(got[0], return_inverse=True)
        counts = np.zeros((len(window), 1 << BITS), np.int64)
        np.add.at(counts, (at, got[1]), got[2])
        until = np.cumsum(counts, axis=1)
        digit = np.minimum((until < need[window][:, None]).sum(axis=1), (1 << BITS) - 1)
        rows = np.arange(len(window))
        columns = [window, digit.astype(np.int32), until[rows, digit] - counts[rows, digit], counts[rows, digit], until[:, -1]]
        yield pa.record_batch([pa.array(c) for c in columns], names=["window", "digit", "before", "inside", "total"])

    return task


def _gathering(anchors: Anchors, s: Search) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that keeps the rows that may be among the first of their windows; equal ones as one with their number."""

    def grouped(held: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(held).group_by(["window", "score", "vec_id"]).aggregate([("times", "sum")])
        return out.rename_columns({"times_sum": "times"}).select(["window", "score", "vec_id", "times"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for w, score, who in _candidates(batch, anchors, s, s.low, s.top):
                own = (score > s.low[w]) | ((who - s.first_id).view(np.uint64) <= s.id_high[w])
                if own.any():
                    held.append(pa.table({"window": w[own].astype(np.int32), "score": score[own], "vec_id": who[own], "times": np.ones(int(own.sum()), np.int64)}))
            if len(held) > 16:
                held = [grouped(held)]
        if held:
            yield from grouped(held).to_batches()

    return task


def first_rows(rows: DataFrame, anchors: Anchors, s: Search, k: int) -> DataFrame:
    """window, rank (from 1), score, vec_id of the first k rows of each window: higher scores first, then smaller ids.

    Each pass is a job that returns a row per window of the block; there are as many passes as a score and an id have
    digits at most. Equal rows are ranked one after another.
    """
    n = C.buckets_of(rows.sparkSession)
    while s.open.any():
        packed = rows.mapInArrow(_counting(anchors, s, n), C.PACKED)
        found = C.exchange(packed, n).mapInArrow(_locating(s.need.copy()), "window int, digit int, before bigint, inside bigint, total bigint").toArrow()
        s.locate(*[np.asarray(found.column(c)).astype(np.int64) for c in ("window", "digit", "before", "inside", "total")])
    got = rows.mapInArrow(_gathering(anchors, s), "window int, score bigint, vec_id bigint, times bigint")
    got = got.groupBy("window", "score", "vec_id").agg(F.sum("times").alias("times"))
    before = F.coalesce(F.sum("times").over(Window.partitionBy("window").orderBy(F.desc("score"), "vec_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = F.sequence((F.col("before") + 1).cast("int"), F.least(F.col("before") + F.col("times"), F.lit(k)).cast("int"))
    return got.withColumn("before", before).where(F.col("before") < k).select("window", F.explode(ranks).alias("rank"), "score", "vec_id")


def _share(score: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """percent of a score, rounded up or down, without leaving 64 bits."""
    q, r = np.divmod(score, 100)
    return q * percent + (-(-(r * percent) // 100) if up else r * percent // 100)


def _of_block(rows: DataFrame, anchors: Anchors, ids: tuple[int, int], positives: int, negatives: int, percents: tuple[int, int]) -> DataFrame:
    n = len(anchors.vec_id)
    far = np.full(n, 1 << 62)
    s = Search(np.arange(n), far, -far, np.full(n, positives), True, *ids)
    # positives are as few as a block's anchors times their number, and so are the windows they make
    found = first_rows(rows, anchors, s, positives).toArrow().sort_by([("window", "ascending"), ("rank", "ascending")])
    at, positive, score = (np.asarray(found.column(c)).astype(np.int64) for c in ("window", "vec_id", "score"))
    s = Search(at, _share(score, percents[1], up=False), _share(score, percents[0], up=True), np.full(len(at), negatives), False, *ids)
    mined = first_rows(rows, anchors, s, negatives)
    windows = pa.table({"of": np.arange(len(at), dtype=np.int32), "anchor_id": anchors.vec_id[at], "positive_id": positive, "positive_score": score})
    named = mined.join(F.broadcast(rows.sparkSession.createDataFrame(windows)), F.col("window") == F.col("of"))
    return named.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, percents: tuple[int, int] = (50, 95)) -> DataFrame:
    """Hard negatives of the anchors among vectors(vec_id, label, embedding): anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    A score is the inner product of components floor(256 x). An anchor's positives are its first rows of the same label
    with another id; for each, the first rows of another label whose score is between two percentages of the positive's.
    Higher scores come first, ties by smaller id; where there are fewer rows, all. Rows with a null id, label, vector or
    component, or one that is not finite, take no part; vectors of another length are no candidates of an anchor;
    components beyond 2**31 over the root of a vector's length are held at that. Repeated rows are rows of their own, as
    anchors too. No rows or anchors give no rows. Other columns are not read.
    """
    work = C.Scratch(vectors.sparkSession, "negatives")
    rows = work.write(rows_of(vectors), "rows")
    weight = F.greatest(F.size("vector"), F.lit(ANCHOR)).cast("long")
    chosen = rows.where(is_anchor)
    none = F.lit(0)
    total, first_id, last_id = rows.agg(F.coalesce(F.sum(F.when(is_anchor, weight)), none), F.coalesce(F.min("vec_id"), none), F.coalesce(F.max("vec_id"), none)).first()
    if total > BLOCK:
        placed = C.running(work, chosen, [F.col("vec_id")], {"before": weight}, "anchors")
        chosen = work.write(placed.withColumn("block", F.floor(F.col("before") / BLOCK)), "blocks")
    paths = []
    for k in range(total // BLOCK + 1):
        anchors = Anchors.of((chosen.where(F.col("block") == k) if total > BLOCK else chosen).select("vec_id", "label", "vector").toArrow())
        if len(anchors.vec_id):
            paths.append(work.write(_of_block(rows, anchors, (first_id, last_id), positives, negatives, percents), f"mined{k}")._adjudica_path)
    spark = vectors.sparkSession
    return spark.read.schema(MINED).parquet(*paths) if paths else spark.createDataFrame([], MINED)
