"""Embedding near-dedup by E8 lattice hashing.

A table projects unit vectors on eight random orthonormal directions and decodes the result to the nearest point of the
E8 lattice, its cell; the nearest point of the lattice's other half, and the nearest points beyond the coordinate that
was decoded with the least margin, are probed as well. Vectors that meet in a cell of any table are compared in full.
Equal vectors of a label are one node with a multiplicity, so a vector that very many rows share is compared once.

Ids travel first: cells are counted, and only vectors of cells with company are fetched. A cell above ``BLOCK`` nodes is
dealt out as pairs of blocks, so no task compares a whole one. A pair is counted in the first cell in which it meets,
which both sides can tell from the cells they carry; a task sends on numbers of links per node and a spanning forest of
its links, never its pairs. With the default tables a pair of cosine 0.98 is missed with a chance of about one in a
thousand (measured in the tests against brute force).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm import _common as C
from adjudica.llm.components import connected

TABLES = 8
#: cells a vector is looked for in each table: its own, that of the lattice's other half, and those beyond a close border
PROBES = 3
#: nodes of a cell that one task compares with as many others
BLOCK = 512
#: lattice steps that vectors at the threshold lie apart after projection, on average
STEP = 0.4


def decode_e8(x: np.ndarray) -> list[np.ndarray]:
    """Twice the nearest E8 point of each row, twice the nearest point of the other half of the lattice, and twice the
    point beyond the nearest border: the two coordinates of the least margin rounded the other way."""

    def d8(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        off = y - near
        worst = np.argmax(np.abs(off), axis=1)
        rows = np.flatnonzero(near.sum(axis=1) % 2 != 0)
        near[rows, worst[rows]] += np.where(off[rows, worst[rows]] >= 0, 1, -1)
        return near

    whole, half = d8(x), d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    first = np.where(closer[:, None], whole, half)
    second = np.where(closer[:, None], half, whole)
    off = x - first
    order = np.argsort(-np.abs(off), axis=1)[:, :2]
    rows, third = np.arange(len(x))[:, None], first.copy()
    # two steps keep the sum even
    third[rows, order] += np.where(off[rows, order] >= 0, 1, -1)
    return [np.rint(2 * p).astype(np.int64) for p in (first, second, third)]


def _directions(dim: int, table: int) -> np.ndarray:
    """Eight orthonormal directions (fewer in fewer dimensions, then padded with zeros)."""
    rng = np.random.default_rng([31, dim, table])
    q = np.linalg.qr(rng.standard_normal((dim, min(8, dim))))[0]
    return np.pad(q, ((0, 0), (0, 8 - q.shape[1])))


def cells(unit: np.ndarray, salt: np.ndarray, threshold: float, tables: int = TABLES) -> np.ndarray:
    """The cells of each unit vector in each table, its own first, as hashes that also hold the salt: (vectors, tables,
    PROBES)."""
    dim = unit.shape[1]
    apart = np.sqrt(max(2 - 2 * threshold, 1e-6)) * np.sqrt(min(8, dim) / dim)
    out = np.empty((len(unit), tables, PROBES), np.uint64)
    weights = np.random.default_rng(37).integers(1, 2**62, 8, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    shift = np.random.default_rng(41).uniform(0, 1, (tables, 8))
    for t in range(tables):
        for k, points in enumerate(decode_e8(unit @ _directions(dim, t) * (STEP / apart) + shift[t])):
            out[:, t, k] = C.mixed((points.astype(np.uint64) * weights).sum(axis=1) ^ C.mixed(salt + np.uint64(t)))
    return out


ROWS = pa.schema([("vec_id", pa.int64()), ("node", pa.int64()), ("vector", pa.binary()), ("salt", pa.int64())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node: list = []
        raw: list = []
        salt: list = []
        known = np.asarray(pc.and_(batch.column("vec_id").is_valid(), batch.column("label").is_valid()))
        for ok, label, v in zip(known, batch.column("label").to_pylist(), batch.column("embedding"), strict=True):
            x = None
            if ok and v.is_valid and len(v) and v.values.null_count == 0:
                x = np.asarray(v.values, np.float64)
                x = x if np.isfinite(x).all() and x.any() else None
            if x is None:
                node.append(None), raw.append(None), salt.append(None)
            else:
                s = xxhash.xxh3_64_intdigest(f"{label}\0{len(x)}".encode())
                raw.append(x.tobytes())
                salt.append(np.uint64(s).astype(np.int64).item())
                node.append(np.uint64(xxhash.xxh3_64_intdigest(raw[-1], s)).astype(np.int64).item())
        yield pa.record_batch([batch.column("vec_id"), pa.array(node, pa.int64()), pa.array(raw, pa.binary()), pa.array(salt, pa.int64())], schema=ROWS)


CELLS = "node bigint, cell bigint, table int, own boolean, cells binary, unit binary"
CELLS_ARROW = pa.schema([("node", pa.int64()), ("cell", pa.int64()), ("table", pa.int32()), ("own", pa.bool_()), ("cells", pa.binary()), ("unit", pa.binary())])


def _cells_of(threshold: float):
    """One row per node with its unit vector and all its cells, and one narrow row per cell (cells and unit null)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("vector").to_pylist()
            sizes = np.array([len(r) // 8 for r in raw], int)
            for dim in np.unique(sizes):
                mine = np.flatnonzero(sizes == dim)
                x = np.frombuffer(b"".join(raw[i] for i in mine), np.float64).reshape(-1, dim)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                found = cells(unit, np.asarray(batch.column("salt"))[mine].view(np.uint64), threshold)
                node, k = np.asarray(batch.column("node"))[mine], len(mine)
                yield pa.record_batch([pa.array(node), *[pa.nulls(k, t) for t in (pa.int64(), pa.int32(), pa.bool_())], pa.array([c.tobytes() for c in found], pa.binary()), pa.array([u.tobytes() for u in unit], pa.binary())], schema=CELLS_ARROW)
                each = TABLES * PROBES
                table = np.tile(np.repeat(np.arange(TABLES, dtype=np.int32), PROBES), k)
                own = np.tile(np.arange(PROBES) == 0, k * TABLES)
                yield pa.record_batch([pa.array(np.repeat(node, each)), pa.array(found.reshape(-1).view(np.int64)), pa.array(table), pa.array(own), pa.nulls(k * each, pa.binary()), pa.nulls(k * each, pa.binary())], schema=CELLS_ARROW)

    return task


FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def _meets_first(x: np.ndarray, y: np.ndarray, own_x: np.ndarray, own_y: np.ndarray, cell: int, t: int) -> np.ndarray:
    """For rows x against y of one cell: whether this is the first cell in which the two meet. They meet where one of
    them is at home: in each table in order, and in a table in the smaller cell if in several."""
    first = own_x[:, None] | own_y[None, :]
    for s in range(t):
        for k in range(PROBES):
            first &= x[:, None, s, k] != y[None, :, s, 0]
            first &= x[:, None, s, 0] != y[None, :, s, k]
    here = np.uint64(cell)
    for k in range(PROBES):
        # another cell of this table in which they meet, smaller than this one
        first &= ~((x[:, None, t, k] == y[None, :, t, 0]) & (y[None, :, t, 0] < here))
        first &= ~((x[:, None, t, 0] == y[None, :, t, k]) & (x[:, None, t, 0] < here))
    return first


def _compare(rows: dict[str, np.ndarray], cell: int, t: int, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each row with rows of the other side (partners by their copies), and a spanning forest of the links.

    side has bit 1 for rows compared as one block and bit 2 for the other; a block against itself has both.
    """
    node, side = rows["node"], rows["side"]
    m = len(node)
    links = np.zeros(m, np.int64)
    parent = np.arange(m)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    forest = []
    z = np.flatnonzero(side & 2)
    step = max(1, (1 << 20) // max(1, len(z)))
    left = np.flatnonzero(side & 1)
    for lo in range(0, len(left), step):
        a = left[lo : lo + step]
        good = rows["unit"][a] @ rows["unit"][z].T >= threshold
        good &= node[a][:, None] != node[z][None, :]
        if not good.any():
            continue
        good &= _meets_first(rows["cells"][a], rows["cells"][z], rows["own"][a], rows["own"][z], cell, t)
        links[a] += good @ rows["copies"][z]
        # of two blocks the other side has its links too; in one block each row comes to the left
        other = (side[z] & 1) == 0
        links[z[other]] += good[:, other].T @ rows["copies"][a]
        for i in np.flatnonzero(good.any(axis=1)):
            for j in z[good[i]].tolist():
                ri, rj = root(int(a[i])), root(j)
                if ri != rj:
                    parent[rj] = ri
                    forest.append((int(node[a[i]]), int(node[j])))
    return links, forest


def _meet(threshold: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, int] = {}

        def groups():
            key, held = None, []
            for batch in batches:
                cols = [batch.column(c).to_pylist() for c in ("cell", "i", "j", "table", "own", "side", "node", "copies", "cells", "unit")]
                for cell, i, j, *row in zip(*cols, strict=True):
                    if (cell, i, j) != key:
                        if len(held) > 1:
                            yield key, held
                        key, held = (cell, i, j), []
                    held.append(row)
            if len(held) > 1:
                yield key, held

        for (cell, _, _), held in groups():
            # vectors of other lengths, or of another table, that fell into a cell of one number never meet
            for t, size in {(h[0], len(h[6])) for h in held}:
                mine = [h for h in held if h[0] == t and len(h[6]) == size]
                if len(mine) < 2:
                    continue
                rows = {"own": np.array([h[1] for h in mine]), "side": np.array([h[2] for h in mine]), "node": np.array([h[3] for h in mine]), "copies": np.array([h[4] for h in mine])}
                rows["cells"] = np.frombuffer(b"".join(h[5] for h in mine), np.uint64).reshape(-1, TABLES, PROBES)
                rows["unit"] = np.frombuffer(b"".join(h[6] for h in mine), np.float64).reshape(len(mine), -1)
                links, forest = _compare(rows, np.int64(cell).view(np.uint64), t, threshold)
                for k in np.flatnonzero(links):
                    sums[int(rows["node"][k])] = sums.get(int(rows["node"][k]), 0) + int(links[k])
                if forest:
                    yield pa.record_batch([pa.array([x for x, _ in forest]), pa.array([y for _, y in forest]), pa.nulls(len(forest), pa.int64())], schema=FOUND)
        if sums:
            yield pa.record_batch([pa.array(list(sums)), pa.nulls(len(sums), pa.int64()), pa.array(list(sums.values()))], schema=FOUND)

    return task


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label).

    Rows of equal labels whose cosine, in double precision, is at least the threshold are linked as far as the lattice
    finds them. n_links counts rows, equal vectors included; component_id is the smallest vec_id reachable. A null
    label or vector, an empty or zero one, null or non-finite components, or vectors of different lengths never link.
    Without an id component_id is null and the row is kept. Rows of the same id are separate.
    """
    spark = vectors.sparkSession
    n = C.buckets_of(spark)
    work = C.Scratch(spark, "embeddings")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = work.write(rows.mapInArrow(_rows, "vec_id bigint, node bigint, vector binary, salt bigint"), "rows")
    nodes = rows.where("node is not null").groupBy("node", "salt").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.min("vector").alias("vector"))
    nodes = work.write(nodes, "nodes")
    placed = work.write(nodes.select("node", "vector", "salt").mapInArrow(_cells_of(threshold), CELLS), "cells")
    # a vector meets others only in cells that some vector is at home in; a cell's rows of one node are one
    posted = placed.where("cell is not null").groupBy("cell", "node", "table").agg(F.max("own").alias("own"))
    posted = work.write(posted, "posted")
    sizes = posted.groupBy("cell").agg(F.count("*").alias("members"), F.max("own").alias("homes"))
    sizes = work.write(sizes.where("members > 1 and homes").select(F.col("cell").alias("of_cell"), "members"), "sizes")
    spread = C.join_one(posted, "cell", sizes, "of_cell", "members").select("cell", "node", "table", "own", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("node", "cell"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    side = F.when(F.col("block") == F.col("other"), 3).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side")
    spread = spread.select("*", other).select("cell", "node", "table", "own", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), side)
    vectors_ = placed.where("cell is null").select(F.col("node").alias("of"), "cells", "unit").join(nodes.select("node", "copies"), F.col("of") == F.col("node")).drop("node")
    dealt = spread.join(vectors_, F.col("node") == F.col("of")).repartition(n, "cell", "i", "j").sortWithinPartitions("cell", "i", "j", "node")
    dealt = dealt.select("cell", "i", "j", "table", "own", "side", "node", "copies", "cells", "unit")
    found = work.write(dealt.mapInArrow(_meet(threshold), "a bigint, b bigint, n bigint"), "found")
    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "linked")
    labels = connected(found.where("n is null").select("a", "b"), work).withColumnRenamed("node", "member")
    whole = work.write(nodes.select("node", "first", "copies").join(counts, F.col("node") == F.col("linked"), "left").join(labels, F.col("node") == F.col("member"), "left"), "whole")
    lowest = whole.where("label is not null").groupBy("label").agg(F.min("first").alias("component"), F.count("*").alias("members")).withColumnRenamed("label", "of_label")
    lowest = work.write(lowest, "lowest")
    in_class = C.join_one(whole.where("label is not null"), "label", lowest, "of_label", "members").select("node", "links", "copies", "component")
    alone = whole.where("label is null").select("node", "links", "copies", F.col("first").alias("component"))
    whole = in_class.unionByName(alone).select(F.col("node").alias("of"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "copies", "component")
    whole = work.write(whole, "classes")
    # a vector that very many rows have is one heavy node
    rows = rows.select("vec_id", "node")
    some = C.join_one(rows.where("node is not null"), "node", whole, "of", "copies").select("vec_id", "node", "links", "component")
    out = some.unionByName(rows.where("node is null").select("vec_id", "node", F.lit(None).cast("bigint").alias("links"), F.lit(None).cast("bigint").alias("component")))
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id").isNull() | (F.col("vec_id") == component)).alias("kept"))
