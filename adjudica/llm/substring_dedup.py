"""Substring dedup by level-wise doubling.

The first level is of short windows, half as long as those that are removed and not all of them: of the short windows in
a full window the one of the smallest hash stands for it, so about a quarter of all are sent, and two equal full windows
are stood for by the same one. Only where a short window stands in two documents is there a candidate of twice the
length, the full window. Candidates that stand in two documents are removed from all but the first; where a repeated one
is followed, one length on, by another repeated one is a candidate of twice the length again, and so on until none
survives.

Every level is one packed exchange by window hash and one back to the documents. What a task has often (a passage that a
third of all documents share) it keeps: it sends one summary, gets one verdict back, and a join by that summary's own key
returns it to the places, so no bucket sees all occurrences of a window. Full windows carry 96 bits, beside the 64 of the
short window that let them in. Above the full length a passage is followed from few of its places: those whose window has
the least hash of all that start within a length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm import _common as C

#: A slot is a window's place in its text plus, above it, bits of the text's own hash: rows that share an id but not a
#: text keep apart. A slot with its bit is twice the slot plus one bit.
PLACE_BITS = 40
#: windows a task has more often than this are sent as a summary
OFTEN = 64
#: windows that are combined at once
UNIT = 2_000_000
OTHER_MULT = np.uint64(0xC2B2AE3D27D4EB4F)

ROWS = "kind string, bucket int, payload binary, key bigint, low bigint, doc_id bigint, length bigint"
ROWS_ARROW = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("payload", pa.binary()), ("key", pa.int64()), ("low", pa.int64()), ("doc_id", pa.int64()), ("length", pa.int64())])


def _rows(kind: str, k: int, **cols) -> pa.RecordBatch:
    full = {"kind": pa.array([kind] * k, pa.string())} | {f.name: pa.nulls(k, f.type) for f in ROWS_ARROW if f.name != "kind"}
    full |= {name: pa.array(v, ROWS_ARROW.field(name).type) for name, v in cols.items()}
    return pa.record_batch([full[f.name] for f in ROWS_ARROW], schema=ROWS_ARROW)


def _packed(kind: str, bucket: np.ndarray, n: int, raw: list, steps: list) -> Iterator[pa.RecordBatch]:
    for batch in C.packed_batches(C.split_packed(bucket, n, raw, steps)):
        yield _rows(kind, batch.num_rows, bucket=batch.column(0), payload=batch.column(1))


def _marks(text_hash: np.ndarray) -> np.ndarray:
    return (text_hash >> np.uint64(64 - 22)).astype(np.int64) << PLACE_BITS


def _text_hash(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each text's word sequence."""
    with np.errstate(over="ignore"):
        stop = np.cumsum(counts)
        _, at = C.places(counts)
        total = np.concatenate([[np.uint64(0)], np.cumsum(C.mixed(words ^ C.mixed(at.astype(np.uint64) + np.uint64(1))))])
        return C.mixed(total[stop] - total[stop - counts])


class _Texts:
    """A chunk's words, and for each full window the short one that stands for it; rows without an id have none."""

    def __init__(self, batch: pa.RecordBatch, window: int) -> None:
        self.ids, known = C.ids_of(batch.column("doc_id"))
        flat, counts = C.words_of(batch.column("text"))
        self.words = C.hash_words(flat)
        row, at = C.places(counts)
        self.marks = _marks(_text_hash(self.words, counts))
        short = (window + 1) // 2
        small = C.mixed(C.rolling(self.words, short))
        self.start = np.flatnonzero((at + window <= counts[row]) & known[row])
        self.small, self.row, self.at, self.chosen = small, row, at, self.start
        if len(self.start):
            # the least hash of the short windows in each window, with its offset in the low bits: the first of equal ones
            n = len(self.words) - window + 1
            low = np.uint64((1 << (window - short).bit_length()) - 1)
            best = small[:n] & ~low
            for s in range(1, window - short + 1):
                np.minimum(best, small[s : s + n] & ~low | np.uint64(s), out=best)
            self.chosen = self.start + (best[self.start] & low).astype(np.int64)

    def slots(self, places: np.ndarray) -> np.ndarray:
        return self.marks[self.row[places]] + self.at[places]


def _key(h: np.ndarray, doc: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return C.mixed(h ^ C.mixed(doc.astype(np.uint64) ^ C.mixed(slot.astype(np.uint64)))).view(np.int64)


def _sent(units: Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]], n: int, often: int) -> Iterator[pa.RecordBatch]:
    """Units of (hashes, document, slot) by hash: ``plain`` entries with bit 0, summaries (least and largest document of
    a window the unit has often) with bit 1, and ``held`` rows with all that a summary stands for."""
    for hs, doc, slot in units:
        if not len(doc):
            continue
        order = np.lexsort(hs[::-1]) if len(hs) > 1 else np.argsort(hs[0], kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.any([np.diff(h[order]) != 0 for h in hs], axis=0)]))
        size = np.diff(np.append(first, len(doc)))
        plain, bit = np.ones(len(doc), bool), np.zeros(len(doc), np.int64)
        keys, payloads = [], []
        for g in np.flatnonzero(size > max(often, 2)):
            own = np.sort(order[first[g] : first[g] + size[g]])
            least, most = own[np.argmin(doc[own])], own[np.argmax(doc[own])]
            plain[own] = False
            plain[[least, most]] = True
            bit[[least, most]] = 1
            keys.append(_key(hs[0][[least]], doc[[least]], slot[[least]])[0])
            payloads.append(C.pack([hs[0][own]], [doc[own], slot[own]]))
        for lo in range(0, len(keys), 1000):
            yield _rows("held", len(keys[lo : lo + 1000]), key=keys[lo : lo + 1000], payload=payloads[lo : lo + 1000])
        # in the order of the texts, in which places take little room
        keep = np.flatnonzero(plain)
        yield from _packed("plain", C.bucket_of(hs[0][keep], n), n, [h[keep] for h in hs], [doc[keep], 2 * slot[keep] + bit[keep]])


def _in_units(parts: Iterator[tuple]) -> Iterator[tuple]:
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[1])
        if size >= UNIT:
            yield _one(held)
            held, size = [], 0
    if held:
        yield _one(held)


def _one(held: list[tuple]) -> tuple:
    hashes = [np.concatenate(h) for h in zip(*[p[0] for p in held], strict=True)]
    return hashes, np.concatenate([p[1] for p in held]), np.concatenate([p[2] for p in held])


def _send_short(window: int, n: int, often: int):
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for chunk in C.doc_chunks(batches):
            t = _Texts(chunk, window)
            # places only go up from window to window
            at = t.chosen[np.flatnonzero(np.diff(t.chosen, prepend=-1))]
            yield [t.small[at]], t.ids[t.row[at]], t.slots(at)

    return lambda batches: _sent(_in_units(parts(batches)), n, often)


def _judge(n: int, n_hashes: int):
    """Of the windows of a bucket, those that stand in two documents: ``chain`` rows (hash, document, slot with bit 1
    where a smaller document has it), and the verdicts of summaries."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = C.gather(batches, [np.uint64, np.uint32][:n_hashes], 2)
        if got is None:
            return
        hs, (doc, slot2) = got[:n_hashes], got[n_hashes:]
        order = np.lexsort(hs[::-1])
        hs, doc, slot2 = [h[order] for h in hs], doc[order], slot2[order]
        first = np.flatnonzero(np.concatenate([[True], np.any([h[1:] != h[:-1] for h in hs], axis=0)]))
        sizes = np.diff(np.append(first, len(doc)))
        low, high = np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)
        twice, low = np.repeat(low != high, sizes), np.repeat(low, sizes)
        summary = (slot2 & 1) == 1
        told = np.flatnonzero(twice & summary)
        yield _rows("verdict", len(told), key=_key(hs[0][told], doc[told], slot2[told] >> 1), low=low[told])
        keep = np.flatnonzero(twice & ~summary)
        yield from _chain(hs[0][keep], doc[keep], slot2[keep] >> 1, low[keep], n)

    return task


def _chain(h: np.ndarray, doc: np.ndarray, slot: np.ndarray, low: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((slot, doc))
    h, doc, slot2 = h[order], doc[order], (2 * slot + (doc > low))[order]
    yield from _packed("chain", C.id_buckets(doc, n), n, [h], [doc, slot2])


def _release(n: int):
    """Held rows with their verdict as chain rows, many held rows together."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for p, low in zip(batch.column("payload").to_pylist(), batch.column("low").to_pylist(), strict=True):
                h, doc, slot = C.unpack(p, [np.uint64], 2)
                yield [h, np.full(len(doc), low)], doc, slot

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (h, low), doc, slot in _in_units(parts(batches)):
            yield from _chain(h, doc, slot, low, n)

    return task


def _level(work: C.Scratch, sent: DataFrame, n: int, n_hashes: int, tag: str) -> DataFrame:
    """bucket, payload: the chain of all windows of a level that stand in two documents."""
    sent = work.write(sent, f"{tag}-sent", by=["kind"])
    plain = sent.where("kind = 'plain'").select("bucket", "payload")
    judged = work.write(C.exchange(plain, n).mapInArrow(_judge(n, n_hashes), ROWS), f"{tag}-judged", by=["kind"])
    chain = judged.where("kind = 'chain'").select("bucket", "payload")
    held = sent.where("kind = 'held'").select("key", "payload")
    if not held.isEmpty():
        # a key is of one summary of one task, so no key has many rows
        verdicts = judged.where("kind = 'verdict'").select("key", "low").distinct()
        freed = held.join(verdicts.hint("merge"), "key").select("payload", "low").mapInArrow(_release(n), ROWS)
        chain = chain.unionByName(work.write(freed, f"{tag}-freed").select("bucket", "payload"))
    work.drop(sent, "kind=plain")
    return chain


def _marks_then_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.RecordBatch]]:
    """Marks of a bucket by document, as slots with their bits, with each chunk of its documents; marks come first."""
    docs, slots = [], []
    table: dict | None = None

    def built() -> dict:
        if not docs:
            return {}
        doc, slot = np.concatenate(docs), np.concatenate(slots)
        order = np.lexsort((slot, doc))
        doc, slot = doc[order], slot[order]
        ids, at = np.unique(doc, return_index=True)
        return dict(zip(ids.tolist(), np.split(slot, at[1:]), strict=True))

    def texts():
        for batch in batches:
            is_mark = np.asarray(batch.column("payload").is_valid())
            for p in batch.column("payload").filter(pa.array(is_mark)).to_pylist():
                d, s = C.unpack(p, [], 2)
                docs.append(d)
                slots.append(s)
            if not is_mark.all():
                yield batch.filter(pa.array(~is_mark))

    for chunk in C.doc_chunks(texts()):
        if table is None:
            table = built()
        yield table, chunk


def _own(table: dict, doc: int, mark: int) -> np.ndarray:
    """Slots with bits of one row, as places * 2 + bit."""
    s = table.get(doc)
    if s is None:
        return np.empty(0, np.int64)
    lo, hi = np.searchsorted(s, [2 * mark, 2 * (mark + (1 << PLACE_BITS))])
    return s[lo:hi] - 2 * mark


def _without_hash(later_only: bool, n: int):
    """Chain rows without their hashes; for removal only windows that a smaller document has."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for p in batch.column("payload").to_pylist():
                _, doc, slot2 = C.unpack(p, [np.uint64], 2)
                keep = np.flatnonzero(slot2 & 1) if later_only else np.arange(len(doc))
                yield [doc[keep]], doc[keep], slot2[keep]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for _, doc, slot2 in _in_units(parts(batches)):
                order = np.lexsort((slot2, doc))
                yield from C.split_packed(C.id_buckets(doc[order], n), n, [], [doc[order], slot2[order]])

        return C.packed_batches(rows())

    return task


def _send_full(window: int, n: int, often: int):
    """Full windows whose short one stands in two documents."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for table, chunk in _marks_then_docs(batches):
            if not table:
                continue
            hit = np.fromiter((i in table for i in chunk.column("doc_id").to_pylist()), bool, chunk.num_rows)
            t = _Texts(chunk.filter(pa.array(hit)), window)
            alive = np.zeros(len(t.words) + 1, bool)
            begin = np.searchsorted(t.row, np.arange(len(t.ids)))
            for r in range(len(t.ids)):
                alive[begin[r] + (_own(table, int(t.ids[r]), int(t.marks[r])) >> 1)] = True
            at = t.start[alive[t.chosen]]
            if len(at):
                yield [C.mixed(C.rolling(t.words, window))[at], (C.mixed(C.rolling(C.mixed(t.words), window, OTHER_MULT))[at] >> np.uint64(32)).astype(np.uint32)], t.ids[t.row[at]], t.slots(at)

    return lambda batches: _sent(_in_units(parts(batches)), n, often)


def _least_of_next(h: np.ndarray, k: int) -> np.ndarray:
    """For each element the least of it and the k - 1 after it (fewer at the end)."""
    out, width = h.copy(), 1
    while width < k:
        step = min(width, k - width)
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        width += step
    return out


def _ladder(window: int, n: int):
    """From the repeated windows of whole documents: which documents have later ones, and the hashes of twice, four times
    and more the length from the places a passage is followed from, as far as repeated windows go on without a gap."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = C.gather(batches, [np.uint64], 2)
        if got is None:
            return
        h, doc, slot2 = got
        order = np.lexsort((slot2, doc))
        h, doc, slot = h[order], doc[order], slot2[order] >> 1
        ids = np.unique(doc[(slot2[order] & 1) == 1])
        yield _rows("seen", len(ids), doc_id=ids, length=np.full(len(ids), window))
        # a row that stands twice has its windows twice
        once = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (slot[1:] != slot[:-1])]))
        h, doc, slot = h[once], doc[once], slot[once]
        run = np.cumsum(np.concatenate([[0], (doc[1:] != doc[:-1]) | (slot[1:] != slot[:-1] + 1)]))
        ends = np.searchsorted(run, run, side="right")
        at = np.flatnonzero((ends - np.arange(len(h)) > window) & (_least_of_next(h, window) == h))
        hashes, length = h, window
        while len(at):
            # whole is the hash of 2 * length words from each place that has as many repeated windows after it
            fits = np.flatnonzero(ends - np.arange(len(h)) > 2 * length - window)
            whole = np.zeros(len(h), np.uint64)
            whole[fits] = C.mixed(C.join_hash(hashes[fits], hashes[fits + length], length))
            at = at[ends[at] - at > 2 * length - window]
            hashes, length = whole, 2 * length
            for batch in C.packed_batches(C.split_packed(C.id_buckets(doc[at], n), n, [hashes[at]], [doc[at], slot[at]])):
                yield _rows("ladder", batch.num_rows, bucket=batch.column(0), payload=batch.column(1), length=np.full(batch.num_rows, length))

    return task


def _send_longer(length: int, n: int, often: int):
    """Of the windows of a length, those whose half was found repeated (all for the first). Halves are the chain rows
    among them, told by is_chain."""

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        got: dict[bool, list] = {True: [], False: []}
        for batch in batches:
            for is_chain, p in zip(batch.column("is_chain").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                got[is_chain].append(C.unpack(p, [np.uint64], 2))
        if not got[False]:
            return
        h, doc, slot = (np.concatenate(c) for c in zip(*got[False], strict=True))
        if got[True]:
            _, known, slot2 = (np.concatenate(c) for c in zip(*got[True], strict=True))
            alive = np.isin(_key(np.zeros(len(doc), np.uint64), doc, slot), _key(np.zeros(len(known), np.uint64), known, slot2 >> 1))
            h, doc, slot = h[alive], doc[alive], slot[alive]
        yield [h], doc, slot

    return lambda batches: _sent(units(batches), n, often)


def _later(length: int):
    """The documents of chain rows that have a window a smaller one has."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("payload").to_pylist():
                _, doc, slot2 = C.unpack(p, [np.uint64], 2)
                ids = np.unique(doc[(slot2 & 1) == 1])
                yield pa.record_batch([pa.array(ids), pa.array(np.full(len(ids), length))], names=["doc_id", "length"])

    return task


KEPT = "doc_id bigint, n_words bigint, n_removed bigint, text string"
KEPT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])


def _remove(window: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, chunk in _marks_then_docs(batches):
            flat, counts = C.words_of(chunk.column("text"))
            ids, known = C.ids_of(chunk.column("doc_id"))
            hit = np.fromiter((i in table for i in ids.tolist()), bool, len(ids)) & known
            row, _ = C.places(counts)
            gone = np.zeros(len(flat) + 1, np.int32)
            if hit.any():
                some = hit[row]
                marks = np.zeros(len(ids), np.int64)
                marks[hit] = _marks(_text_hash(C.hash_words(flat.filter(pa.array(some))), counts[hit]))
                start = np.cumsum(counts) - counts
                for r in np.flatnonzero(hit):
                    at = start[r] + np.unique(_own(table, int(ids[r]), int(marks[r])) >> 1)
                    gone[at] += 1
                    gone[at + window] -= 1
            keep = np.cumsum(gone)[:-1] == 0
            removed = np.bincount(row[~keep], minlength=len(ids))
            text = C.text_of_words(flat, keep, counts)
            yield pa.record_batch([chunk.column("doc_id"), pa.array(counts), pa.array(removed, pa.int64()), text.cast(pa.string())], schema=KEPT_ARROW)

    return task


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", often: int = OFTEN) -> DataFrame:
    """Remove every word covered by a window of ``window`` words that also starts in a document with a smaller id.

    Windows are judged on the input, not on what is left. Words are runs of ``[^\\x20\\x09-\\x0D]``. Returns per row
    doc_id, n_words, n_removed, text (the kept words joined by one space) and longest, the largest of window * 2**j for
    which a doubled window that also starts in a smaller document was found (0: none); a passage is followed from some
    of its places, so what one shares may be a little more than longest.

    Null or empty text: no words, empty text. Null id: the row keeps all its words and is no source for others. Rows of
    the same id never remove each other's words, and a text's own repeats stay. Other columns are not read. An empty
    table gives an empty one. Windows a task has more than ``often`` times travel as one summary; that changes no result.
    """
    spark = docs.sparkSession
    n = C.buckets_of(spark)
    work = C.Scratch(spark, "repeats")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    by_doc = docs.select(C.id_bucket("doc_id", "text", n).alias("bucket"), "doc_id", "text", F.lit(None).cast("binary").alias("payload"))

    def with_docs(chain: DataFrame, later_only: bool, task: Callable, schema: str) -> DataFrame:
        """The task over each bucket's documents, with what the chain says about them before them."""
        marks = chain.mapInArrow(_without_hash(later_only, n), C.PACKED)
        both = marks.select("bucket", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"), "payload").unionByName(by_doc)
        return C.exchange(both, n).sortWithinPartitions(F.col("payload").isNull()).mapInArrow(task, schema)

    short = _level(work, docs.mapInArrow(_send_short(window, n, often), ROWS), n, 1, "short")
    full = _level(work, with_docs(short, False, _send_full(window, n, often), ROWS), n, 2, "full")
    ladder = work.write(C.exchange(full, n).mapInArrow(_ladder(window, n), ROWS), "ladder", by=["kind"])
    found, length, chain = ladder.where("kind = 'seen'").select("doc_id", "length"), 2 * window, None
    while not (rungs := ladder.where(f"kind = 'ladder' and length = {length}").select("bucket", "payload", F.lit(False).alias("is_chain"))).isEmpty():
        if chain is not None:
            if chain.isEmpty():
                break
            rungs = rungs.unionByName(chain.withColumn("is_chain", F.lit(True)))
        chain = _level(work, C.exchange(rungs, n).mapInArrow(_send_longer(length, n, often), ROWS), n, 1, f"level-{length}")
        found = found.unionByName(chain.mapInArrow(_later(length), "doc_id bigint, length bigint"))
        length *= 2
    longest = found.groupBy("doc_id").agg(F.max("length").alias("longest"))
    out = with_docs(full, True, _remove(window), KEPT)
    return out.join(longest, "doc_id", "left").select("doc_id", "n_words", "n_removed", "text", F.coalesce("longest", F.lit(0)).alias("longest"))
