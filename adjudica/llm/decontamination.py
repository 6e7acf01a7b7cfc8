"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items, each text scanned once.

Items and texts are normalised alike: A-Z lower-cased, words joined by one space. A window is ten consecutive words of an
item. The automaton reads the normalised bytes of many texts at once; a match ends at a space, which says which word of
which text it ends at, and words lead back to places in the text as it was. Windows of very many items are dealt into
blocks of a fixed size, one automaton and one pass each, so neither a task nor the driver holds more than one block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from string import ascii_lowercase, ascii_uppercase

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.text import let
from adjudica.llm import _common as C
from adjudica.llm.license_scan import NOT_WORD

WINDOW = 10
#: an automaton has at most so many bytes of windows, about 50 bytes of memory each
BLOCK_BYTES = 4_000_000
#: longer words are compared by 128 bits of theirs, so that a window is short whatever its words are
LONG_WORD = 64
#: a window's normalised words, their number, and the items it comes from
Window = tuple[bytes, int, list[str]]
#: of this worker, by block
_made: dict[str, ahocorasick.Automaton] = {}
FOUND = "doc_id bigint, text string, n_words bigint, hits array<struct<first:int,last:int,start:int,end:int>>, items array<string>"
HIT = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
#: A-Z to a-z, what is no letter, digit or part of a character beyond ASCII to a space
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def short_word(word: bytes) -> bytes:
    """The word, or a mark and a digest that no word equals."""
    return word if len(word) <= LONG_WORD else b"#" + xxhash.xxh3_128_hexdigest(word).encode()


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """gram (the window's words joined by one space), n (its words), items (sorted ids as text) of all distinct windows.

    An item of fewer words is one window; one without words, or of null text, has none. Rows of one id are one item with
    the windows of all its rows. A row without an id gives windows, but is named nowhere.
    """
    lower = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), ascii_uppercase, ascii_lowercase)
    words = F.split(F.trim(F.regexp_replace(lower, NOT_WORD, " ")), " ")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    grams = F.transform(starts, lambda i: F.array_join(F.slice("words", i, window), " "))
    own = items.select(F.col("item_id").cast("string").alias("item"), words.alias("words"))
    each = own.select("item", F.explode(F.array_distinct(grams)).alias("gram")).where("gram != ''")
    out = each.groupBy("gram").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return out.select("gram", F.size(F.split("gram", " ")).alias("n"), "items")


def _blocks(found: DataFrame, work: C.Scratch) -> tuple[int, Callable[[int], list[Window]]]:
    """The number of blocks of bounded size the windows make, and one block by its number; the driver holds one at a time."""
    weight = F.octet_length("gram") + 1 + F.aggregate("items", F.lit(0), lambda s, x: s + F.octet_length(x) + 8)
    sized = work.write(found.withColumn("bytes", weight.cast("long")), "windows")
    total = sized.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    if total > BLOCK_BYTES:
        placed = C.running(work, sized, [F.col("gram")], {"before": F.col("bytes")}, "placed")
        sized = work.write(placed.withColumn("block", F.floor(F.col("before") / BLOCK_BYTES).cast("int")), "blocks")

    def block(k: int) -> list[Window]:
        rows = (sized.where(F.col("block") == k) if total > BLOCK_BYTES else sized).select("gram", "n", "items").toArrow()
        return [(g.encode(), n, ids) for g, n, ids in zip(*(rows.column(c).to_pylist() for c in ("gram", "n", "items")), strict=True)]

    return total // BLOCK_BYTES + 1, block


def automaton(block: list[Window]) -> ahocorasick.Automaton:
    """An automaton over normalised bytes, each taken as one character; a window's value is its place in the block."""
    a = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, (gram, _, _) in enumerate(block):
        a.add_word(b" ".join([b"", *map(short_word, gram.split(b" ")), b""]).decode("latin-1"), k)
    a.make_automaton()
    return a


def _held(name: str, block: list[Window]) -> ahocorasick.Automaton:
    """The block's automaton, made once in a Python worker that goes through several tasks."""
    if name not in _made:
        _made.clear()
        _made[name] = automaton(block)
    return _made[name]


class Words:
    """The words of some texts: their places in the bytes of all texts joined, and the text each belongs to."""

    def __init__(self, texts: list[bytes]) -> None:
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begins = np.cumsum(self.lengths + 1) - (self.lengths + 1)
        raw = (b" ".join(texts) + b" ").translate(NORMAL)
        self.raw = np.frombuffer(raw, np.uint8)
        word = self.raw != 32
        before = np.concatenate([[False], word[:-1]])
        self.starts, self.ends = np.flatnonzero(word & ~before), np.flatnonzero(before & ~word)
        #: normalised: one space before all and after each word
        self.normal = b" " + self.raw[word | before].tobytes()
        if len(self.starts) and int((self.ends - self.starts).max()) > LONG_WORD:
            self.normal = b" ".join([b"", *(short_word(raw[a:b]) for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)), b""])
        self.spaces = np.flatnonzero(np.frombuffer(self.normal, np.uint8) == 32)
        #: the first word of each text, and the end of the last
        self.first = np.concatenate([np.searchsorted(self.starts, self.begins), [len(self.starts)]])

    def matches(self, a: ahocorasick.Automaton, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, window) of every window that stands in one text, words counted over all texts."""
        got = np.array(list(a.iter(self.normal.decode("latin-1"))), np.int64).reshape(-1, 2)
        last = np.searchsorted(self.spaces, got[:, 0]) - 1
        first = last - sizes[got[:, 1]] + 1
        text = np.searchsorted(self.first, last, side="right") - 1
        inside = first >= self.first[text]
        return text[inside], first[inside], got[inside, 1]

    def code_points(self, text: int, source: bytes, at: np.ndarray) -> np.ndarray:
        """Places among the joined bytes as code points of one text."""
        starts = np.cumsum((np.frombuffer(source, np.uint8) & 0xC0) != 0x80)
        own = at - self.begins[text]
        return np.where(own > 0, starts[np.maximum(own, 1) - 1], 0)


def _runs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of words that some window covers."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    fresh = np.concatenate([[True], first[1:] > reach[:-1] + 1])
    at = np.flatnonzero(fresh)
    return first[at], reach[np.concatenate([at[1:] - 1, [len(first) - 1]])]


def _scanned(block: list[Window], with_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that adds a block's hits and items to those of the rows so far."""
    sizes, name = np.array([n for _, n, _ in block], np.int64), uuid.uuid4().hex

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.doc_chunks(batches):
            texts = pc.fill_null(batch.column("text"), "").cast(pa.binary()).to_pylist()
            w = Words(texts)
            hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            if block and len(w.starts):
                text, first, found = w.matches(_held(name, block), sizes)
                order = np.argsort(text, kind="stable")
                text, first, found = text[order], first[order], found[order]
                cuts = np.flatnonzero(np.diff(text, prepend=-1, append=len(texts)))
                for at, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    t = int(text[at])
                    one, n = first[at:z] - w.first[t], sizes[found[at:z]]
                    old = hits[t]
                    starts, ends = _runs(np.append(one, [h["first"] for h in old]).astype(np.int64), np.append(one + n - 1, [h["last"] for h in old]).astype(np.int64))
                    places = w.code_points(t, texts[t], w.starts[starts + w.first[t]]), w.code_points(t, texts[t], w.ends[ends + w.first[t]])
                    hits[t] = [dict(zip(("first", "last", "start", "end"), h, strict=True)) for h in zip(starts.tolist(), ends.tolist(), places[0].tolist(), places[1].tolist(), strict=True)]
                    items[t] = sorted({*items[t], *(i for k in np.unique(found[at:z]).tolist() for i in block[k][2])})
            n_words = pa.array(np.diff(w.first))
            text = batch.column("text") if with_text else pa.nulls(len(texts), pa.string())
            yield pa.record_batch([batch.column("doc_id"), text, n_words, pa.array(hits, pa.list_(HIT)), pa.array(items, pa.list_(pa.string()))], names=["doc_id", "text", "n_words", "hits", "items"])

    return task


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """What of test items(item_id, text) stands in docs(doc_id, text), one row per row: doc_id, text, n_words, hits, items.

    hits are the maximal runs of words that windows cover, with first and last word (from 0) and the place in the text as
    it is (code points, end exclusive); items are the ids, as sorted text, of the items that windows come from. Null or
    empty texts have no words and no hits; no items, no hits. Repeated rows, and rows of one id or none, are rows of their
    own. Other columns are not read. Texts are never shuffled; without with_text they are null in the result.
    """
    work = C.Scratch(docs.sparkSession, "decontamination")
    none = F.array().cast("array<struct<first:int,last:int,start:int,end:int>>")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"), none.alias("hits"), F.array().cast("array<string>").alias("items"))
    n_blocks, block = _blocks(windows(items, window), work)
    before = None
    for k in range(n_blocks):
        if k:
            done = work.write(out, "scanned")
            if before is not None:
                work.drop(before)
            out = before = done
        out = out.mapInArrow(_scanned(block(k), with_text or k < n_blocks - 1), FOUND)
    return out


def n_hit(hits: Column) -> Column:
    """Words in hits."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda s, h: s + h["last"] - h["first"] + 1)


def cleaned(text: Column, hits: Column) -> Column:
    """The text without its hits; what stands between words stays."""
    ends = F.concat(F.array(F.lit(0)), F.transform(hits, lambda h: h["end"]))
    starts = F.concat(F.transform(hits, lambda h: h["start"]), F.array(F.length(text)))
    return let(F.coalesce(text, F.lit("")), lambda t: F.array_join(F.zip_with(ends, starts, lambda a, b: F.substring(t, a + 1, F.coalesce(b, F.length(t)) - a)), ""))
