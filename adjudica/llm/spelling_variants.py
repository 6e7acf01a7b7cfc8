"""Spelling variants: words one edit apart, found by a rare-first prefix filter on positional bigrams.

An edit changes two bigrams of a word at most, and then two that overlap. Of the bigrams that two near words have in
common, the one that comes first in an order by frequency is therefore among the three rarest of either, or the two
rarest where these do not overlap. The edit is on one side of it: the other side is the same in both words, and so is one
half of the side with the edit, at its place. Words meet by an equi-join on a rare bigram with these letters, so lists stay
short however many words there are, and what meets is verified. The words of a corpus are counted in the tasks that read
the texts; texts are never shuffled. All joins are by shuffles: Spark takes a written table for as large as its compressed
files, and would send one of 10 MB through the driver, with eight keys to a row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.llm import _common as C

LEAST_LENGTH, LEAST_COUNT = 6, 5
#: overlapping bigrams an edit can change, and one more
PREFIX = 3
#: of a run's checksum: where it divides, one letter of the run was lost
SLIP = 199
#: a word's near word is its form where it is so many times as frequent
TIMES = 5
#: distinct words a task holds before it sends their counts on
AT_ONCE = 400_000
COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
#: bytes of words: ASCII letters in lower case; U+00C0 to U+00FF are 0xC3 and one byte more, the rest becomes a space
LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256))


def runs(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of each text, A-Z lower-cased, and the text each is of."""
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    raw = np.frombuffer((b" ".join(texts) + b" ").translate(LOWER), np.uint8)
    lead = raw == 0xC3
    after = np.concatenate([[False], lead[:-1]])
    word = ((raw < 0x80) & (raw != 32)) | lead | after
    before = np.concatenate([[False], word[:-1]])
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(before & ~word)
    # a run of fewer letters than a word has is none, whatever is lost
    tails = np.concatenate([[0], np.cumsum(after)])
    long = ends - starts - (tails[ends] - tails[starts]) >= LEAST_LENGTH
    starts, ends = starts[long], ends[long]
    flat = raw[_within(starts, ends)].tobytes()
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    out = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)])
    return out, np.searchsorted(begins, starts, side="right") - 1


def _within(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places from each start to its end."""
    n = ends - starts
    return np.arange(int(n.sum())) + np.repeat(starts - (np.cumsum(n) - n), n)


def slipped(run: bytes, checksum: int) -> str:
    """The run without the letter its checksum names."""
    letters = run.decode()
    k = checksum % len(letters)
    return letters[:k] + letters[k + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the texts of a task with the number of their occurrences."""
    held: list[pa.Table] = []
    size = 0
    for batch in C.doc_chunks(batches):
        texts = pc.fill_null(batch.column("text"), "").cast(pa.binary()).to_pylist()
        found, text = runs(texts)
        if not len(found):
            continue
        coded = found.dictionary_encode()
        # occurrences by text and run: one checksum stands for all of them
        key, n = np.unique(text * len(coded.dictionary) + np.asarray(coded.indices), return_counts=True)
        of, which = np.divmod(key, len(coded.dictionary))
        begin = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in batch.column("doc_id").to_pylist()]
        known = coded.dictionary.cast(pa.large_binary()).to_pylist()
        sums = np.fromiter((zlib.crc32(known[w], begin[t]) for t, w in zip(of.tolist(), which.tolist(), strict=True)), np.int64, len(key))
        lost = np.flatnonzero(sums % SLIP == 0)
        changed = [slipped(known[which[k]], int(sums[k])) for k in lost.tolist()]
        left = np.bincount(which, n, len(known)) - np.bincount(which[lost], n[lost], len(known))
        some = np.flatnonzero(left)
        words = pa.concat_arrays([coded.dictionary.take(pa.array(some)), pa.array(changed, pa.large_string())])
        table = pa.table({"word": words, "n": np.concatenate([left[some].astype(np.int64), n[lost]])})
        held.append(table.filter(pc.greater_equal(pc.utf8_length(table["word"]), LEAST_LENGTH)))
        size += len(held[-1])
        if size >= AT_ONCE:
            held = [_summed(held)]
            size = len(held[0])
            if size >= AT_ONCE // 2:
                yield from held[0].cast(COUNTS).to_batches()
                held, size = [], 0
    if held:
        yield from _summed(held).cast(COUNTS).to_batches()
    held.clear()
    C.release()


def _summed(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
    return out.rename_columns({"n_sum": "n"}).select(["word", "n"])


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of all words of at least six letters and five occurrences in docs(doc_id, text), slips of writing included.

    Null texts have no words; a null id is the empty text in a run's checksum. Rows of one id are rows of their own.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, place, gram) of all bigrams; letters are below U+0100, so a gram is a number below 65,536."""
    lists = [w.encode("latin-1") for w in words.to_pylist()]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    raw = np.frombuffer(b"".join(lists), np.uint8).astype(np.int64)
    row, at = C.places(sizes)
    inner = at < np.repeat(sizes, sizes) - 1
    pair = raw[:-1] * 256 + raw[1:] if len(raw) else raw
    return row[inner], at[inner], pair[np.flatnonzero(inner)] if len(raw) else pair


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(65536, np.int64)
    for batch in batches:
        total += np.bincount(_grams(batch.column("word"))[2], minlength=65536)
    some = np.flatnonzero(total)
    yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["gram", "n"])


def prefixes(words: DataFrame) -> DataFrame:
    """word, n, size, at: a row for each place of a rare bigram of words(word, n): the two rarest, or three where these two
    overlap and one edit could change both.

    The order is by a bigram's occurrences in the vocabulary, then by its letters, then by place: the same in all words.
    There are 90 letters, so at most 8,100 bigrams have a number.
    """
    counts = words.select("word").mapInArrow(_gram_counts, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    common = np.zeros(65536, np.int64)
    for r in counts.collect():
        common[r.gram] = r.n
    rank = np.empty(65536, np.int32)
    rank[np.argsort(common, kind="stable")] = np.arange(65536)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, at, gram = _grams(batch.column("word"))
            order = np.lexsort((at, rank[gram], row))
            row, at = row[order], at[order]
            begins, place = np.searchsorted(row, np.arange(batch.num_rows)), C.places(np.bincount(row, minlength=batch.num_rows))[1]
            apart = np.abs(at[begins] - at[begins + 1]) > 1
            first = place < np.where(apart, PREFIX - 1, PREFIX)[row]
            row = pa.array(row[first])
            word, n = batch.column("word").take(row), batch.column("n").take(row)
            yield pa.record_batch([word, n, pc.utf8_length(word), pa.array(at[first].astype(np.int32))], names=["word", "n", "size", "at"])

    return words.select("word", "n").mapInArrow(task, "word string, n bigint, size int, at int")


def _meeting(role: str, size: Column, less: int) -> list[Column]:
    """Hashes under which a posted bigram meets others: the letters up to it or from it on, and one half of the letters on
    its other side, of which ``less`` are not counted."""
    word, at = F.col("word"), F.col("at")
    own = F.col("size") - at - 2

    def halves(letters: Column) -> tuple[Column, Column]:
        first = F.floor((letters - less) / 2).cast("int")
        return first, (letters - less - first).cast("int")

    def part(start: Column, n: Column) -> Column:
        return F.substring(word, start, n)

    (a, z), (b, y) = halves(own), halves(at)
    mark, one = F.lit("|"), F.lit(1)
    texts = [
        (own, 0, at, part(one, at + 2 + a)),
        (own, 1, at, F.concat(part(one, at + 2), mark, part(F.col("size") - z + 1, z))),
        (at, 2, F.col("size") - at, F.concat(part(one, b), mark, part(at + 1, F.col("size")))),
        (at, 3, F.col("size") - at, part(at - y + 1, F.col("size"))),
    ]
    least = 0 if role == "more" and less == 0 else 1
    return [F.when(side >= least, F.xxhash64(F.lit(role), F.lit(kind), size, place, text)) for side, kind, place, text in texts]


def near_words(words: DataFrame, work: C.Scratch) -> DataFrame:
    """a, n_a, b, n_b of all pairs of words(word, n) one edit apart, each once, a before b.

    A replaced letter is among those of the side it is on; for a letter more, the longer word is taken without one letter
    of that side, and which half it is in is told by the shorter word's halves.
    """
    posted = work.write(prefixes(words), "posted")
    size = F.col("size")
    same, shorter, longer = _meeting("same", size, 0), _meeting("more", size + 1, 0), _meeting("more", size, 1)

    def rows(keys: list[Column], word: str, n: str) -> DataFrame:
        return posted.select(F.col("word").alias(word), F.col("n").alias(n), F.explode(F.array_compact(F.array(*keys))).alias("key"))

    met = rows([*same, *shorter], "a", "n_a").join(rows([*same, *longer], "b", "n_b").hint("merge"), "key")
    met = met.where(((F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    swap = F.col("a") > F.col("b")
    pair = [F.least("a", "b").alias("a"), F.when(swap, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"), F.greatest("a", "b").alias("b"), F.when(swap, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b")]
    return met.select(*pair).distinct()


def _roots(forms: DataFrame, work: C.Scratch) -> DataFrame:
    """word, root of forms(word, form): the last form on the way, by doubling steps; n grows on the way, so it ends."""
    ways = work.write(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = work.write(ways.join(further.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ways")
        work.drop(ways)
        ways = step.drop("moved")
        ways._adjudica_path = step._adjudica_path
        if step.where("moved").isEmpty():
            return ways


def variants(docs: DataFrame) -> DataFrame:
    """The words of docs(doc_id, text) with their variants, one row per word: word, form, root, n, n_near, form_n.

    A word's form is the most frequent of its near words (ties: the first in code-point order), if that is five times as
    frequent at least; its root is the last form of that way, or the word. Words without near words have form null and
    n_near 0. Null, empty or missing texts give no words, and no words no rows; repeated rows count as often as they
    stand. Other columns are not read.
    """
    work = C.Scratch(docs.sparkSession, "spelling")
    words = work.write(vocabulary(docs), "words")
    pairs = work.write(near_words(words, work), "pairs")
    ways = F.array(F.struct(F.col("a").alias("word"), F.col("n_a").alias("own"), F.col("b").alias("near"), F.col("n_b").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("n_b").alias("own"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    both = pairs.select(F.explode(ways).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min_by(F.struct("near", "near_n", "own"), F.struct(-F.col("near_n"), F.col("near"))).alias("best"))
    much = F.col("best.near_n") >= TIMES * F.col("best.own")
    best = work.write(best.select("word", "n_near", F.when(much, F.col("best.near")).alias("form"), F.when(much, F.col("best.near_n")).alias("form_n")), "best")
    root = _roots(best.where("form is not null"), work)
    out = words.join(best.hint("merge"), "word", "left").join(root.hint("merge"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
