"""Quality rules: statistics of each text, and lines that too many documents of a host share.

Normalised lines are hashed; per host, the documents a line stands in are counted, copies of a document once: documents
are told apart by a hash of their whole word sequence, so a family of copies is no boilerplate and different documents
are never one, however much they share. Lines above the limit are removed and a document that has little left is
rejected.

Counting is two combining aggregations, (host, line, document) and then (host, line), so a line that a third of all
documents share is counted in parts. Frequent lines go to the tasks by broadcast only while they are few; beyond that
they are joined to the documents that hold them.
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

#: a line is frequent in more than LEAST_DOCS documents of its host and in more than LEAST_SHARE of them
LEAST_DOCS, LEAST_SHARE = 50, 0.01
#: a document is depleted with fewer words left than this, or a smaller share of its words
LEFT_WORDS, LEFT_SHARE = 10, 0.2
#: bytes of text handled at once; windows and lines of a chunk take about a hundred times as much
CHUNK = 2 << 20
#: frequent lines up to this number are broadcast (16 bytes each)
BROADCAST_LINES = 200_000

LINES = pa.schema([("source", pa.string()), ("line", pa.int64()), ("doc", pa.int64())])


def _lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct lines of a chunk with a normalised hash each (0: no word); index and row of every line."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    rows = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(lists)))
    d = lists.flatten().dictionary_encode()
    plain = pc.utf8_trim_whitespace(pc.replace_substring_regex(pc.utf8_lower(d.dictionary), r"\s+", " "))
    hashes = C.hash_words(plain)
    worded = np.asarray(pc.match_substring_regex(d.dictionary, r"[^ \t\n\v\f\r]"), bool)
    return d.dictionary, np.where(worded, hashes | np.uint64(1), np.uint64(0)), np.asarray(d.indices), rows


def _identity(flat: pa.Array, counts: np.ndarray) -> np.ndarray:
    """Hash of each text's whole word sequence."""
    texts = C.text_of_words(flat, np.ones(len(flat), bool), counts).cast(pa.binary())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, texts.to_pylist()), np.uint64, len(counts))


def _send_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line of each document once, and line 0 for the document itself."""
    for chunk in C.doc_chunks(batches, CHUNK):
        doc = _identity(*C.words_of(chunk.column("text")))
        _, hashes, index, row = _lines(chunk.column("text"))
        own = np.arange(chunk.num_rows)
        line, row = np.concatenate([hashes[index], np.zeros(len(own), np.uint64)]), np.concatenate([row, own])
        pair = np.unique(np.stack([line, row.astype(np.uint64)]), axis=1)
        who = pair[1].astype(np.int64)
        yield pa.record_batch([chunk.column("source").take(pa.array(who)), pa.array(pair[0].view(np.int64)), pa.array(doc[who].view(np.int64))], schema=LINES)


def frequent_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, least_share: float = LEAST_SHARE) -> DataFrame:
    """source, line (hash of the normalised line), n_docs: lines above the limits of their host.

    Documents are distinct word sequences, in the count of a line and in that of its host.
    """
    work = C.Scratch(docs.sparkSession, "lines")
    docs = docs.select(F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    seen = docs.mapInArrow(_send_lines, "source string, line bigint, doc bigint").groupBy("source", "line", "doc").agg(F.lit(1).alias("one"))
    counted = seen.groupBy("source", "line").agg(F.count("*").alias("n_docs")).where((F.col("line") == 0) | (F.col("n_docs") > least_docs))
    counted = work.write(counted, "counted")
    hosts = counted.where("line = 0").select(F.col("source").alias("host"), F.col("n_docs").alias("all_docs"))
    both = counted.where("line <> 0").join(hosts, F.col("source").eqNullSafe(F.col("host")))
    return both.where(F.col("n_docs") > least_share * F.col("all_docs")).select("source", "line", "n_docs")


def _sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)


def _repeat_words(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words of each text that lie in five-word windows found twice or more in it."""
    row, at = C.places(counts)
    five = C.rolling(h, 5)
    idx = np.flatnonzero((at + 5 <= counts[row])[: len(five)])
    key = C.mixed(five[idx] ^ C.mixed(row[idx].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    k = key[order]
    same = k[1:] == k[:-1]
    hit = idx[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]] if len(k) else idx
    cover = np.zeros(len(h) + 1, np.int32)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + 5, -1)
    return np.bincount(row[np.cumsum(cover)[:-1] > 0], minlength=len(counts))


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_lines", "n_left_words"]


def _judge(frequent: dict | None, keep: list[str], types: list):
    """frequent: sorted line hashes of each source; None: they come with each row in the column hot."""
    schema = pa.schema([("doc_id", pa.int64()), *types, *[(s, pa.int64()) for s in STATS], ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("text", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in C.doc_chunks(batches, CHUNK):
            n, texts = chunk.num_rows, pc.fill_null(chunk.column("text"), "")
            flat, counts = C.words_of(texts)
            row, _ = C.places(counts)
            names, hashes, index, line_row = _lines(texts)
            line = hashes[index]
            pair = np.stack([line_row, index])[:, line != 0]
            distinct = np.unique(pair[0] * max(1, len(names)) + pair[1])
            dup = np.bincount(pair[0], minlength=n) - np.bincount(distinct // max(1, len(names)), minlength=n)
            gone = np.zeros(len(line), bool)
            if frequent is None:
                hot = chunk.column("hot")
                owner = np.repeat(np.arange(n), np.asarray(pc.fill_null(pc.list_value_length(hot), 0)))
                values = np.asarray(hot.flatten()).view(np.uint64)
                gone = np.isin(C.mixed(line) ^ line_row.astype(np.uint64), C.mixed(values) ^ owner.astype(np.uint64)) & (line != 0)
            else:
                sources = chunk.column("source").to_pylist()
                for s in set(sources) & frequent.keys():
                    mine = np.fromiter((x == s for x in sources), bool, n)[line_row]
                    gone[mine] = np.isin(line[mine], frequent[s])
            left = counts.copy()
            clean = texts
            if gone.any():
                some = np.unique(line_row[gone])
                words_in = np.asarray(pc.list_value_length(pc.ascii_split_whitespace(pc.ascii_trim_whitespace(names))))
                left -= np.bincount(line_row[gone], weights=words_in[index[gone]], minlength=n).astype(np.int64)
                kept_lines = np.bincount(line_row[~gone], minlength=n)
                offsets = pa.array(np.concatenate([[0], np.cumsum(kept_lines)]).astype(np.int32))
                joined = pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(pa.array(index[~gone]))), "\n")
                changed = np.zeros(n, bool)
                changed[some] = True
                clean = pc.if_else(pa.array(changed), joined, texts)
            repeat = _repeat_words(C.hash_words(flat), counts)
            symbols = np.asarray(pc.count_substring_regex(texts, "[#*$%&|<>]")).astype(np.int64)
            chars = _sums(np.asarray(pc.utf8_length(flat)), row, n)
            base = (counts < 10) | (100 * repeat > 20 * counts)
            depleted = (left < counts) & ((left < LEFT_WORDS) | (left < LEFT_SHARE * counts))
            cols = [counts, chars, symbols, dup, repeat, np.bincount(line_row[gone], minlength=n), left]
            yield pa.record_batch([chunk.column("doc_id"), *[chunk.column(k) for k in keep], *[pa.array(c, pa.int64()) for c in cols], pa.array(base), pa.array(~base & ~depleted), clean.cast(pa.string())], schema=schema)

    return task


def judge(docs: DataFrame, keep: tuple[str, ...] = (), least_docs: int = LEAST_DOCS, least_share: float = LEAST_SHARE) -> DataFrame:
    """Statistics, verdict and cleaned text of every row.

    Returns doc_id, the columns of ``keep`` (as keep_<name>), n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_removed_lines, n_left_words, base_failed, kept and text (without the frequent lines). Null text is
    empty and fails; a null source is a host of its own. Rows of the same id are separate. A document of which no line
    is frequent is never depleted.
    """
    spark = docs.sparkSession
    work = C.Scratch(spark, "quality")
    kept = [F.col(k).alias(f"keep_{k}") for k in keep]
    lines = work.write(frequent_lines(docs, least_docs, least_share), "lines")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"), *kept)
    few = lines.count() <= BROADCAST_LINES
    frequent: dict | None = None
    if few:
        frequent = {}
        for source, line in lines.select("source", "line").collect():
            frequent.setdefault(source, []).append(line)
        frequent = {s: np.sort(np.array(v, np.int64).view(np.uint64)) for s, v in frequent.items()}
    else:
        keyed = docs.withColumn("at", F.xxhash64("text"))
        held = keyed.select("doc_id", "at", "source", "text").mapInArrow(_held_lines, "doc_id bigint, at bigint, source string, line bigint")
        hot = held.join(lines.withColumnRenamed("source", "host").withColumnRenamed("line", "of"), F.col("source").eqNullSafe(F.col("host")) & (F.col("line") == F.col("of")))
        hot = hot.groupBy("doc_id", "at").agg(F.collect_set("line").alias("hot")).select(F.col("doc_id").alias("id"), F.col("at").alias("of_text"), "hot")
        docs = keyed.join(hot, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("at") == F.col("of_text")), "left").drop("id", "of_text", "at")
    names = [f"keep_{k}" for k in keep]
    fields = [docs.schema[k] for k in names]
    ddl = ", ".join(["doc_id bigint", *[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], *[f"{s} bigint" for s in STATS], "base_failed boolean", "kept boolean", "text string"])
    from pyspark.sql.pandas.types import to_arrow_type

    return docs.mapInArrow(_judge(frequent, names, [(f.name, to_arrow_type(f.dataType)) for f in fields]), ddl)


def _held_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in C.doc_chunks(batches, CHUNK):
        _, hashes, index, row = _lines(chunk.column("text"))
        line = hashes[index]
        some = np.flatnonzero(line != 0)
        take = pa.array(row[some])
        yield pa.record_batch([chunk.column("doc_id").take(take), chunk.column("at").take(take), chunk.column("source").take(take), pa.array(line[some].view(np.int64))], names=["doc_id", "at", "source", "line"])
