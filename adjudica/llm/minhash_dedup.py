"""MinHash near-dedup by an inverted join over signature coordinates.

Texts of the same shingle set are one node. A node posts its signature under its value of the first ``posts``
coordinates; in each list, nodes whose signatures agree in at least ``matches`` coordinates are candidates. Both numbers
come from the similarity and a stated risk, so a link is lost with a chance below 1e-6. Within a list collisions are counted by
merging the lists of the other coordinate-value pairs: of a node's, the longest ``matches - 1`` are skipped, since nodes
that agree often enough share one of the others; the skipped ones are only looked up. Lists emit only enough candidates
to connect what is connected, never all pairs of a group; candidates make families, and inside a family full shingle
sets decide. A family above ``BLOCK`` nodes is dealt out in blocks, each with the family's ``LEADERS``; what that links is
one class already, and only nodes outside a family's largest class are then compared with the rest of it, in pairs of
blocks, so a large group of near copies costs about as many sets as it has nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm import _common as C
from adjudica.llm.components import connected

COORDINATES = 64
RISK = 1e-7
#: nodes of a family that are compared with each other, and those of a larger one that stand in each of its blocks
BLOCK, LEADERS = 128, 16
#: lists above this number of nodes are gone through by the lists of their other pairs
DIRECT = 256


def thresholds(similarity: float) -> tuple[int, int]:
    """(posts, matches): coordinates to post under, and the least number that must agree."""
    posts = max(1, math.ceil(math.log(RISK / 10) / math.log(1 - similarity))) if similarity < 1 else 1
    below, t = 0.0, 0
    while below + (p := math.comb(COORDINATES, t) * similarity**t * (1 - similarity) ** (COORDINATES - t)) < RISK:
        below += p
        t += 1
    return min(posts, COORDINATES), max(t, 1)


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(1, 2**63, COORDINATES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, COORDINATES, dtype=np.int64).astype(np.uint64)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted and joined, and their number; a text of fewer words has one."""
    flat, counts = C.words_of(texts, lower=True)
    h = C.hash_words(flat)
    row, at = C.places(counts)
    rolled = C.mixed(C.rolling(h, size))
    idx = np.flatnonzero((at + size <= counts[row])[: len(rolled)])
    values, owner = rolled[idx], row[idx]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        start = np.cumsum(counts) - counts
        whole = [C.mixed(C.rolling(h[start[r] : start[r] + counts[r]], int(counts[r])) + np.uint64(counts[r]))[0] for r in short]
        values = np.concatenate([values, np.array(whole, np.uint64)])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    ends = np.cumsum(np.bincount(owner, minlength=len(counts)))
    sets = [np.unique(values[a:b]) for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)]
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.array([len(s) for s in sets], np.int64)


def _set_hashes(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(C.mixed(values ^ np.uint64(0x5BD1E995)))])
    ends = np.cumsum(n)
    return C.mixed(total[ends] - total[ends - n] + n.astype(np.uint64))


def _signatures(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """One row of COORDINATES 32-bit minima per non-empty set."""
    a, b = _coefficients()
    starts = (np.cumsum(n) - n)[n > 0]
    out = np.empty((len(starts), COORDINATES), np.uint32)
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat(((values * a[k] + b[k]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


NODES = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("signature", pa.binary())])


def _sign(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in C.doc_chunks(batches, 2 << 20):
            values, n = shingle_sets(chunk.column("text"), size)
            known = C.ids_of(chunk.column("doc_id"))[1]
            node = pa.array(_set_hashes(values, n).view(np.int64), mask=(n == 0) | ~known)
            signatures: list = [None] * len(n)
            if len(values):
                for r, s in zip(np.flatnonzero(n > 0), _signatures(values, n), strict=True):
                    signatures[r] = s.tobytes()
            yield pa.record_batch([chunk.column("doc_id"), chunk.column("at"), pa.array(n), node, pa.array(signatures, pa.binary())], schema=NODES)

    return task


POSTING = np.dtype([("key", np.uint64), ("node", np.int64), ("n", np.int32), ("signature", np.uint16, COORDINATES)])


def _post(posts: int, n_buckets: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                if not batch.num_rows:
                    continue
                full = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
                one = np.empty(len(full), POSTING)
                one["node"], one["n"] = np.asarray(batch.column("node")), np.asarray(batch.column("n"))
                one["signature"] = full.astype(np.uint16)
                for c in range(posts):
                    one["key"] = C.mixed(full[:, c].astype(np.uint64) | np.uint64((c + 1) << 32))
                    bucket = C.bucket_of(one["key"], n_buckets)
                    order = np.argsort(bucket, kind="stable")
                    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                        yield int(bucket[part[0]]), one[part].tobytes()

        return C.packed_batches(rows())

    return task


def _connecting(group: np.ndarray, own: np.ndarray, matches: int, similarity: float, parent: np.ndarray) -> list[tuple[int, int]]:
    """Enough pairs of the nodes ``own`` of a list to connect all that candidate pairs among them connect: a search that
    visits each node once and passes over those connected before (by parent, which is kept up)."""

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    left = own
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            agree = (group["signature"][left] == group["signature"][x]).sum(axis=1)
            sizes = group["n"][left]
            fits = np.minimum(sizes, group["n"][x]) >= similarity * np.maximum(sizes, group["n"][x]) - 1e-9
            hit = (agree >= matches) & fits
            for y in left[hit].tolist():
                rx, ry = root(x), root(y)
                if rx != ry:
                    parent[ry] = rx
                    out.append((int(group["node"][x]), int(group["node"][y])))
                queue.append(y)
            left = left[~hit]
    return out


def _candidate_links(group: np.ndarray, matches: int, similarity: float) -> list[tuple[int, int]]:
    """Enough pairs of one list to connect all nodes that candidate pairs connect."""
    n, parent = len(group), np.arange(len(group))
    if n <= DIRECT:
        return _connecting(group, np.arange(n), matches, similarity, parent)
    sig = group["signature"]
    often = np.empty((n, COORDINATES), np.int64)
    for c in range(COORDINATES):
        _, code, count = np.unique(sig[:, c], return_inverse=True, return_counts=True)
        often[:, c] = count[code]
    # the shortest lists of each node, in an order that is one for all nodes: by length, then by coordinate
    short = np.argsort(often * COORDINATES + np.arange(COORDINATES), axis=1)[:, : COORDINATES - matches + 1]
    length = np.take_along_axis(often, short, axis=1).ravel()
    pair = (short.astype(np.int64) << 16 | np.take_along_axis(sig, short, axis=1).astype(np.int64)).ravel()
    who = np.repeat(np.arange(n), short.shape[1])
    keep = np.flatnonzero(length > 1)
    order = keep[np.lexsort((pair[keep], length[keep]))]
    pair, who = pair[order], who[order]
    out = []
    for part in np.split(who, np.flatnonzero(np.diff(pair)) + 1):
        if len(part) > 1:
            out += _connecting(group, part, matches, similarity, parent)
    return out


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _lists(matches: int, similarity: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [np.frombuffer(p, POSTING) for batch in batches for p in batch.column("payload").to_pylist()]
        if not got:
            return
        all_ = np.concatenate(got)
        order = np.argsort(all_["key"], kind="stable")
        keys = all_["key"][order]
        cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        links: set = set()
        for i in np.flatnonzero(np.diff(cuts) > 1):
            links.update(_candidate_links(all_[order[cuts[i] : cuts[i + 1]]], matches, similarity))
        a = pa.array([x for x, _ in links], pa.int64())
        yield pa.record_batch([a, pa.array([y for _, y in links], pa.int64())], schema=LINKS)
        del all_, got
        C.release()

    return task


def _wanted_sets(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in C.doc_chunks(batches):
            values, n = shingle_sets(chunk.column("text"), size)
            ends = np.cumsum(n)
            # rows that share an id with the wanted text but not the text itself are left out
            own = np.flatnonzero((_set_hashes(values, n).view(np.int64) == np.asarray(chunk.column("node"))) & (n > 0))
            raw = [values[ends[r] - n[r] : ends[r]].tobytes() for r in own]
            yield pa.record_batch([chunk.column("node").take(pa.array(own)), pa.array(raw, pa.binary())], names=["node", "shingles"])

    return task


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of all intersections: shingles of many sets by a product of matrices, the others pair by pair."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, code, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.zeros((m, m), np.float32)
    common = df >= 16
    number = np.cumsum(common) - 1
    pick = common[code]
    cols, rows = number[code[pick]], owner[pick]
    for lo in range(0, int(common.sum()), 4096):
        part = (cols >= lo) & (cols < lo + 4096)
        x = np.zeros((m, 4096), np.float32)
        x[rows[part], cols[part] - lo] = 1
        out += x @ x.T
    pick = (df[code] > 1) & ~common[code]
    order = np.argsort(code[pick], kind="stable")
    c, o = code[pick][order], owner[pick][order]
    for step in range(1, 16):
        same = np.flatnonzero(c[step:] == c[:-step]) if len(c) > step else []
        if not len(same):
            break
        pairs = np.bincount(o[same].astype(np.int64) * m + o[same + step], minlength=m * m).reshape(m, m)
        out += pairs + pairs.T
    return out


def _similar_links(nodes: np.ndarray, raw: list[bytes], left: np.ndarray, right: np.ndarray, labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the verified links between the rows of left and of right that have not one label."""
    sets = [np.frombuffer(r, np.uint64) for r in raw]
    n = np.array([len(s) for s in sets])
    both = overlaps(sets)
    good = 100 * both >= percent * (n[:, None] + n[None, :] - both)
    good &= (left[:, None] & right[None, :]) | (right[:, None] & left[None, :])
    good &= labels[:, None] != labels[None, :]
    out, fresh = [], np.ones(len(n), bool)
    for s in range(len(n)):
        if not fresh[s]:
            continue
        fresh[s] = False
        queue = [s]
        while queue:
            x = queue.pop()
            hit = np.flatnonzero(good[x] & fresh)
            fresh[hit] = False
            out += [(int(nodes[x]), int(nodes[y])) for y in hit]
            queue += hit.tolist()
    return out


def _verify(percent: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            key, held = None, []
            for batch in batches:
                cols = [batch.column(c).to_pylist() for c in ("family", "i", "j", "side", "node", "class", "shingles")]
                for f, i, j, side, node, of, s in zip(*cols, strict=True):
                    if (f, i, j) != key:
                        if held:
                            yield key, held
                        key, held = (f, i, j), []
                    held.append((side, node, of, s))
            if held:
                yield key, held

        for _, held in groups():
            if len(held) < 2:
                continue
            side, nodes, of = (np.array([h[k] for h in held]) for k in range(3))
            links = _similar_links(nodes, [h[3] for h in held], (side & 1) > 0, (side & 2) > 0, of, percent)
            if links:
                yield pa.record_batch([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], schema=LINKS)
        C.release()

    return task


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, keep: tuple[str, ...] = ()) -> DataFrame:
    """Classes of near-duplicate texts: doc_id, columns of ``keep`` (as keep_<name>), n_shingles, component_id, kept.

    Texts whose sets of distinct ``shingle``-word shingles (A-Z lower-cased) have 100 * intersection >= percent * union
    are linked; component_id is the smallest doc_id reachable over links and kept says whether the row has it. A text of
    fewer words is one shingle. Null or empty texts and rows without an id link with nothing; without an id
    component_id is null and the row is kept. Rows of the same id are nodes by their own texts. With ``keep`` there are
    also at (a hash of the text) and chosen: of a class, only rows of one id and one text.
    """
    spark = docs.sparkSession
    n = C.buckets_of(spark)
    work = C.Scratch(spark, "minhash")
    posts, matches = thresholds(percent / 100)
    kept = [F.col(k).alias(f"keep_{k}") for k in keep]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *kept)
    signed = work.write(docs.select("doc_id", F.xxhash64("text").alias("at"), "text").mapInArrow(_sign(shingle), "doc_id bigint, at bigint, n bigint, node bigint, signature binary"), "signed")
    nodes = work.write(signed.where("node is not null").groupBy("node").agg(F.min(F.struct("doc_id", "at")).alias("f"), F.min("n").alias("n"), F.min("signature").alias("signature"), F.count("*").alias("copies")).select("node", F.col("f.doc_id").alias("first"), F.col("f.at").alias("first_at"), "n", "signature", "copies"), "nodes")
    postings = nodes.select("node", "n", "signature").mapInArrow(_post(posts, n), C.PACKED)
    candidates = work.write(C.exchange(postings, n).mapInArrow(_lists(matches, percent / 100), "a bigint, b bigint"), "candidates")

    families = work.write(connected(candidates, work), "families")
    sizes = work.write(families.groupBy("label").agg(F.count("*").alias("members")).withColumnRenamed("label", "family"), "sizes")
    members = C.join_one(families, "label", sizes, "family", "members").select("family", "node", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    members = work.write(members.join(nodes.select("node", "first"), "node"), "members")
    # always a merge join: how many texts are wanted grows with the corpus, so the plan is the same at every size
    wanted = docs.select("doc_id", "text").join(members.select("node", "first").hint("merge"), F.col("doc_id") == F.col("first")).select("node", "text")
    sets = work.write(wanted.mapInArrow(_wanted_sets(shingle), "node bigint, shingles binary"), "sets")
    verify = lambda spread: spread.repartition(n, "family", "i", "j").sortWithinPartitions("family", "i", "j", "node").select("family", "i", "j", "side", "node", "class", "shingles").mapInArrow(_verify(percent), "a bigint, b bigint")

    # every pair within a block; leaders, a few by hash, stand in every block of their family
    both_sides, block = F.lit(3).alias("side"), F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    chief = members.where("blocks > 1").groupBy("family", "blocks").agg(F.slice(F.array_sort(F.collect_set(F.when(F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks") * F.lit(max(1, BLOCK // LEADERS))) == 0, F.col("node")))), 1, 4 * LEADERS).alias("l"))
    chief = chief.select("family", "blocks", F.explode("l").alias("node")).select("family", "node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"))
    dealt = members.select("family", "node", block.alias("i")).unionByName(chief).distinct()
    first_links = work.write(verify(dealt.join(sets, "node").select("family", "i", F.lit(0).alias("j"), both_sides, "node", F.col("node").alias("class"), "shingles")), "links")

    labels = work.write(connected(first_links, work), "classes-of-blocks")
    large = members.where("blocks > 1")
    if not large.isEmpty():
        placed = large.join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select("family", "node", "blocks", F.coalesce("label", "node").alias("class"))
        placed = work.write(placed, "placed")
        counts = placed.groupBy("family", "class").agg(F.count("*").alias("n"))
        main = counts.groupBy("family").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.sum("n").alias("all"), (F.sum("n") - F.max("n")).alias("apart"))
        main = work.write(main.where("apart > 0").withColumnRenamed("family", "of_family"), "main")
        if not main.isEmpty():
            todo = C.join_one(placed, "family", main, "of_family", "all")
            todo = work.write(todo.withColumn("outside", F.col("class") != F.col("main")).withColumn("small", F.ceil(F.col("apart") / BLOCK).cast("int")), "apart")
            # blocks of nodes outside the main class against all blocks of the family
            a = todo.where("outside").select("family", "node", "class", F.pmod(F.xxhash64("node", F.lit(2)), F.col("small")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(1).alias("side"))
            z = todo.select("family", "node", "class", F.explode(F.sequence(F.lit(0), F.col("small") - 1)).alias("i"), block.alias("j"), F.lit(2).alias("side"))
            spread = a.unionByName(z).groupBy("family", "i", "j", "node", "class").agg(F.sum("side").alias("side"))
            # what is found joins the classes there are
            more = work.write(verify(spread.join(sets, "node")), "more-links")
            links = more.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
            labels = work.write(connected(links, work), "labels")
    work.drop(sets)

    first = work.write(labels.join(nodes.select("node", "first", "first_at"), "node"), "firsts")
    lowest = work.write(first.groupBy("label").agg(F.min(F.struct("first", "first_at")).alias("component"), F.count("*").alias("members")).withColumnRenamed("label", "of_label"), "lowest")
    linked = C.join_one(first.select("node", "label"), "label", lowest, "of_label", "members").select("node", "component")
    classes = nodes.select("node", "copies", F.struct("first", "first_at").alias("own")).join(linked, "node", "left")
    classes = work.write(classes.select(F.col("node").alias("of"), "copies", F.coalesce("component", "own").alias("component")), "classes")
    rows = signed if not keep else signed.select("doc_id", "at", "n", "node").distinct()
    # a text that very many rows have is one heavy node
    some = C.join_one(rows.where("node is not null"), "node", classes, "of", "copies")
    none = rows.where("node is null").withColumn("component", F.lit(None).cast(classes.schema["component"].dataType))
    found = some.select(*rows.columns, "component").unionByName(none).withColumn("component_id", F.coalesce("component.first", "doc_id"))
    kept_ = F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    found = found.select("doc_id", "at", F.col("n").alias("n_shingles"), "component_id", kept_.alias("kept"), (kept_ & (F.coalesce("component.first_at", "at") == F.col("at"))).alias("chosen"))
    if not keep:
        return found.drop("at", "chosen")
    docs = docs.withColumnRenamed("doc_id", "id").withColumn("of", F.xxhash64("text"))
    both = docs.join(found, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("of") == F.col("at")))
    return both.select("doc_id", "at", *[f"keep_{k}" for k in keep], "n_shingles", "component_id", "kept", "chosen")
