"""A hidden Markov language model over all training texts.

A word is emitted in two steps: a hidden state emits a symbol, and the symbol the word. The commonest words are symbols
of their own; the others share symbols by their last letters, and inside such a class a word has its add-one share of
the class's counts. Texts are split into words once, as a table of word numbers that every later step reads. Symbols are a bounded alphabet, so the model is of fixed size while word counts, which stay in a
table split by word hash, grow with the corpus.

Baum-Welch starts from the counts of all training texts. In every round each task sums expected counts over its part of
all training texts, each text whole; sums meet per block of symbols. Scoring is the scaled forward recursion over the
whole text. Word counts reach a text's score the other way round: texts send their bags of words to the counts and get
sums of logarithms back.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm import _common as C

STATES, TOP_WORDS, CLASSES = 8, 4096, 512
SYMBOLS = 1 + TOP_WORDS + CLASSES
#: Baum-Welch rounds, each over all training texts
ROUNDS = 10
#: symbols of training texts handled at once; a longer text is handled whole
AT_ONCE = 2_000_000
#: symbols of a text that are stepped through side by side with its others; the state goes from one stretch to the next
STRETCH = 1024
#: bytes of text, or of word numbers, handled at once
CHUNK = 8 << 20
#: texts longer than this many symbols are scored by stretches side by side
LONG = 1 << 16

COUNT = np.dtype([("word", np.uint64), ("n", np.uint64)])
WORDS = "doc_id bigint, row bigint, held_out boolean, words binary"


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, its class in the low bits and its hash above them, and the words per text."""
    flat, counts = C.words_of(texts, lower=True)
    d = flat.dictionary_encode()
    cls = C.hash_words(pc.utf8_slice_codeunits(d.dictionary, -3)) % np.uint64(CLASSES)
    return (C.hash_words(d.dictionary) // np.uint64(CLASSES) * np.uint64(CLASSES) + cls)[np.asarray(d.indices)], counts


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in C.doc_chunks(batches, CHUNK):
        words, counts = _hashed(chunk.column("text"))
        ends = np.cumsum(counts)
        raw = [words[e - k : e].tobytes() for e, k in zip(ends, counts, strict=True)]
        yield pa.record_batch([chunk.column("doc_id"), chunk.column("row"), chunk.column("held_out"), pa.array(raw, pa.binary())], names=["doc_id", "row", "held_out", "words"])


def _words_of(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All words of a chunk of WORDS, and how many each text has."""
    raw = chunk.column("words").to_pylist()
    return np.frombuffer(b"".join(raw), np.uint64), np.array([len(r) // 8 for r in raw], np.int64)


def _class_of(words: np.ndarray) -> np.ndarray:
    return (words % np.uint64(CLASSES)).astype(np.int64)


def _count(n: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for chunk in C.doc_chunks(batches, CHUNK, "words"):
                words, times = np.unique(_words_of(chunk)[0], return_counts=True)
                out = np.empty(len(words), COUNT)
                out["word"], out["n"] = words, times
                yield from _by_bucket(out, C.bucket_of(words, n))

        return C.packed_batches(rows())

    return task


def _by_bucket(entries: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    if len(order):
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            yield int(bucket[part[0]]), entries[part].tobytes()


COUNTED = "kind string, bucket int, payload binary, word bigint, n bigint, distinct bigint"
COUNTED_ARROW = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("payload", pa.binary()), ("word", pa.int64()), ("n", pa.int64()), ("distinct", pa.int64())])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a bucket, sorted by word; its sums; and its commonest words."""
    got, bucket = [], 0
    for batch in batches:
        for b, p in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist(), strict=True):
            bucket = b
            got.append(np.frombuffer(p, COUNT))
    if not got:
        return
    all_ = np.concatenate(got)
    all_ = all_[np.argsort(all_["word"])]
    at = np.flatnonzero(np.concatenate([[True], all_["word"][1:] != all_["word"][:-1]]))
    out = all_[at]
    out["n"] = np.add.reduceat(all_["n"], at)
    top = np.lexsort((out["word"], -out["n"].astype(np.int64)))[:TOP_WORDS]
    k = len(top)
    nulls = {t: pa.nulls(k, t) for t in (pa.int32(), pa.binary(), pa.int64())}
    yield pa.record_batch([pa.array(["counts"]), pa.array([bucket], pa.int32()), pa.array([out.tobytes()], pa.binary()), pa.nulls(1, pa.int64()), pa.array([int(out["n"].astype(np.int64).sum())]), pa.array([len(out)])], schema=COUNTED_ARROW)
    yield pa.record_batch([pa.array(["top"] * k), nulls[pa.int32()], nulls[pa.binary()], pa.array(out["word"][top].view(np.int64)), pa.array(out["n"][top].astype(np.int64)), nulls[pa.int64()]], schema=COUNTED_ARROW)


def _is_in(words: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Whether each word is one of the sorted top."""
    return top[np.minimum(np.searchsorted(top, words), len(top) - 1)] == words if len(top) else np.zeros(len(words), bool)


def _class_sums(top: np.ndarray):
    """Of the words without a symbol of their own: occurrences and distinct words of each class."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            for p in batch.column("payload").to_pylist():
                c = np.frombuffer(p, COUNT)
                c = c[~_is_in(c["word"], top)]
                np.add.at(n, _class_of(c["word"]), c["n"].astype(np.int64))
                v += np.bincount(_class_of(c["word"]), minlength=CLASSES)
        yield pa.record_batch([pa.array(np.arange(CLASSES)), pa.array(n), pa.array(v)], names=["cls", "n", "distinct"])

    return task


def _symbols_of(words: np.ndarray, top: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Symbol of each word: 0 ends a text, then common words by rank, then classes."""
    out = 1 + TOP_WORDS + _class_of(words)
    if len(top):
        at = np.minimum(np.searchsorted(top, words), len(top) - 1)
        own = top[at] == words
        out[own] = 1 + rank[at[own]]
    return out


TEXTS = "doc_id bigint, row bigint, held_out boolean, n_tokens bigint, n_rare bigint, symbols binary"
TEXTS_ARROW = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_rare", pa.int64()), ("symbols", pa.binary())])


def _to_symbols(top: np.ndarray, rank: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in C.doc_chunks(batches, CHUNK, "words"):
            words, counts = _words_of(chunk)
            symbols = _symbols_of(words, top, rank).astype(np.uint16)
            row, _ = C.places(counts)
            rare = np.bincount(row[symbols > TOP_WORDS], minlength=len(counts))
            ends = np.cumsum(counts)
            end = np.zeros(1, np.uint16).tobytes()
            raw = [symbols[e - k : e].tobytes() + end for e, k in zip(ends, counts, strict=True)]
            yield pa.record_batch([chunk.column("doc_id"), chunk.column("row"), chunk.column("held_out"), pa.array(counts + 1), pa.array(rare), pa.array(raw, pa.binary())], schema=TEXTS_ARROW)

    return task


class Model:
    """start (S), move (S x S), emit (S x SYMBOLS), as probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def initial(cls, frequency: np.ndarray, states: int) -> Model:
        rng = np.random.default_rng(11)
        emit = (frequency + 0.5) * rng.uniform(0.5, 1.5, (states, len(frequency)))
        move = np.full((states, states), 0.2 / max(1, states - 1)) if states > 1 else np.ones((1, 1))
        np.fill_diagonal(move, 0.8 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True))

    def next(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Model:
        """The model of expected counts, a little smoothed so that nothing is impossible."""
        share = emit.sum(axis=0)
        emit = emit + 0.5 * (share + 0.5) / (share + 0.5).sum() * len(share) ** 0.5
        move, start = move + 0.1, start + 0.1
        return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def _ends(model: Model, likely: np.ndarray, begin: list[int], live: list[int], text: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each stretch (at its place): chances of the states where the one before ends, and what follows weighs by state
    where it ends itself. A stretch as a whole is a matrix from its first states to its last, so these go along the
    stretches of a text by one product each."""
    s, a = len(model.start), model.move
    before, after = np.ones((s, len(text))), np.ones((s, len(text)))
    several = np.isin(text, text[1:][text[1:] == text[:-1]])
    if not several.any():
        return before, after
    mine = np.zeros(len(text), bool)
    mine[place[several]] = True
    held, where = np.cumsum(mine).tolist(), np.flatnonzero(mine)
    ahead = np.ascontiguousarray(a.T.astype(np.float32))
    whole = np.zeros((s, held[-1], s), np.float32)
    for t in range(len(live)):
        k = held[live[t] - 1]
        if not k:
            break
        e = likely[:, begin[t] + where[:k], None]
        v = e * np.eye(s, dtype=np.float32)[:, None, :] if t == 0 else e * (ahead @ whole[:, :k].reshape(s, k * s)).reshape(s, k, s)
        whole[:, :k] = v if t % 4 else v / np.maximum(v.sum(axis=(0, 2)), 1e-30)[None, :, None]
    # the matrices by stretch, from the first state to the last
    m = whole.transpose(1, 2, 0)[np.array(held)[place[several]] - 1].astype(np.float64)
    spot, owner = place[several], text[several]
    number = np.arange(len(owner)) - np.searchsorted(owner, owner)
    for j in range(int(number.max())):
        i = np.flatnonzero(number == j + 1)
        enter = np.broadcast_to(model.start, (len(i), s)) if j == 0 else before[:, spot[i - 1]].T @ a
        end = np.einsum("ns,nst->nt", enter, m[i - 1])
        before[:, spot[i]] = (end / end.sum(axis=1, keepdims=True)).T
    for j in range(int(number.max()), 0, -1):
        i = np.flatnonzero(number == j)
        w = np.einsum("nst,tn->ns", m[i], after[:, spot[i]]) @ a.T
        after[:, spot[i - 1]] = (w / w.sum(axis=1, keepdims=True)).T
    return before, after


_rooms: dict[int, np.ndarray] = {}


def _room(which: int, rows: int, n: int) -> np.ndarray:
    """An array to be overwritten, of memory that is used again from call to call."""
    if which not in _rooms or _rooms[which].size < rows * n:
        _rooms[which] = np.empty(rows * max(n, AT_ONCE), np.float32)
    return _rooms[which][: rows * n].reshape(rows, n)


def expected_counts(model: Model, sequences: list[np.ndarray], times: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch sums over whole sequences, each so many times: expected starts, moves and emissions."""
    s = len(model.start)
    start, move, emit = np.zeros(s), np.zeros((s, s)), np.zeros((s, model.emit.shape[1]))
    cut = [(i, q[at : at + STRETCH]) for i, q in enumerate(sequences) for at in range(0, len(q), STRETCH)]
    if not cut:
        return start, move, emit
    a = model.move.astype(np.float32)
    # stretches side by side, symbols time by time, the longest first, so that memory is that of the sequences
    text, size = np.array([i for i, _ in cut]), np.array([len(q) for _, q in cut])
    place = np.empty(len(cut), np.int64)
    place[np.argsort(-size, kind="stable")] = np.arange(len(cut))
    row, at = C.places(size)
    size = np.sort(size)[::-1]
    steps = int(size[0])
    live = len(size) - np.searchsorted(size[::-1], np.arange(steps), side="right")
    begin = np.cumsum(live) - live
    x = np.empty(len(row), np.int64)
    x[begin[at] + place[row]] = np.concatenate([q for _, q in cut])
    live, begin = live.tolist(), begin.tolist()
    # a factor of a symbol that all states share changes nothing; without it numbers stay near one
    likely, alpha = _room(0, s, len(x)), _room(1, s, len(x))
    for i, share in enumerate((model.emit / np.maximum(model.emit.sum(axis=0), 1e-300)).astype(np.float32)):
        np.take(share, x, out=likely[i], mode="clip")

    before, after = (w.astype(np.float32) for w in _ends(model, likely, begin, live, text, place))
    opens = np.zeros(len(cut), bool)
    opens[place[np.concatenate([[True], text[1:] != text[:-1]])]] = True
    scale = np.empty(len(x), np.float32)
    ahead = np.ascontiguousarray(a.T)
    for t in range(steps):
        k, o = live[t], begin[t]
        v = alpha[:, o : o + k]
        if t == 0:
            np.multiply(likely[:, :k], np.where(opens, model.start.astype(np.float32)[:, None], ahead @ before), out=v)
        else:
            np.multiply(likely[:, o : o + k], ahead @ alpha[:, begin[t - 1] : begin[t - 1] + k], out=v)
        v /= np.maximum(v.sum(axis=0), np.float32(1e-30), out=scale[o : o + k])
    likely /= scale
    last = np.array(begin)[size - 1] + np.arange(len(size))
    beta = after / np.maximum((alpha[:, last] * after).sum(axis=0), 1e-30)
    if times is not None:
        weight = np.empty(len(cut), np.float32)
        weight[place] = np.array(times)[text]
        beta *= weight
    for t in range(steps - 1, -1, -1):
        k, o = live[t], begin[t]
        v = likely[:, o : o + k] * beta[:, :k]
        move += alpha[:, begin[t - 1] : begin[t - 1] + k] @ v.T if t else before[:, ~opens] @ v[:, ~opens].T
        # what is left in alpha is the chance of each state at each place
        alpha[:, o : o + k] *= beta[:, :k]
        if t:
            beta[:, :k] = a @ v
    start += alpha[:, : live[0]][:, opens].sum(axis=1)
    for i in range(s):
        emit[i] = np.bincount(x, weights=alpha[i], minlength=emit.shape[1])
    return start, move * a, emit


def _long_likelihood(model: Model, q: np.ndarray) -> float:
    """The scaled forward recursion over one long sequence: stretches, as matrices from state to state, side by side."""
    emit = np.ascontiguousarray(model.emit.T)
    alpha = model.start * emit[q[0]]
    total = np.log10(alpha.sum())
    alpha = alpha / alpha.sum()
    k = (len(q) - 1) // STRETCH
    x = q[1 : 1 + k * STRETCH].reshape(k, STRETCH)
    whole, logs = np.broadcast_to(np.eye(len(alpha)), (k, len(alpha), len(alpha))), np.zeros(k)
    for t in range(STRETCH):
        whole = (whole @ model.move) * emit[x[:, t]][:, None, :]
        c = whole.sum(axis=(1, 2))
        whole = whole / c[:, None, None]
        logs += np.log10(c)
    total += logs.sum()
    for m in (*whole, *(model.move * emit[s] for s in q[1 + k * STRETCH :])):
        alpha = alpha @ m
        total += np.log10(alpha.sum())
        alpha = alpha / alpha.sum()
    return float(total)


def log10_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each whole sequence by the scaled forward recursion."""
    out = np.zeros(len(sequences))
    for i in (i for i, q in enumerate(sequences) if len(q) > LONG):
        out[i] = _long_likelihood(model, sequences[i])
    order = sorted((i for i, q in enumerate(sequences) if len(q) <= LONG), key=lambda i: -len(sequences[i]))
    size = np.array([len(sequences[i]) for i in order])
    if not len(size):
        return out
    # symbols time by time, so that memory is that of the sequences
    flat = np.concatenate([sequences[i] for i in order])
    begin = np.cumsum(size) - size
    live = len(size) - np.searchsorted(size[::-1], np.arange(size[0]), side="right")
    e = np.ascontiguousarray(model.emit.T)
    alpha = np.empty((len(size), len(model.start)))
    total = np.zeros(len(size))
    for t in range(int(size[0])):
        k = int(live[t])
        v = e[flat[begin[:k] + t]] * (model.start if t == 0 else alpha[:k] @ model.move)
        c = v.sum(axis=1)
        total[:k] += np.log10(c)
        alpha[:k] = v / c[:, None]
    out[order] = total
    return out


def _expect(model: Model):
    s = len(model.start)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(s), np.zeros((s, s)), np.zeros((s, SYMBOLS))

        def add(texts: list[bytes]) -> None:
            # copies that meet here are gone through once
            distinct = Counter(texts)
            for total, part in zip(sums, expected_counts(model, [np.frombuffer(r, np.uint16) for r in distinct], list(distinct.values())), strict=True):
                total += part

        held, size = [], 0
        for batch in batches:
            for r in batch.column("symbols").to_pylist():
                if held and size + len(r) // 2 > AT_ONCE:
                    add(held)
                    held, size = [], 0
                held.append(r)
                size += len(r) // 2
        add(held)
        start, move, emit = sums
        yield pa.record_batch([pa.array(np.arange(SYMBOLS + 1 + s)), pa.array([x.tolist() for x in (*emit.T, start, *move)], pa.list_(pa.float64()))], names=["part", "counts"])

    return task


def _score(model: Model, spread: np.ndarray, base: np.ndarray):
    """spread, base: by symbol, the part of a word's score and of its base score that is known without its own count."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in C.doc_chunks(batches, 2 * AT_ONCE, "symbols"):
            q = [np.frombuffer(r, np.uint16).astype(np.int64) for r in part.column("symbols").to_pylist()]
            likelihood = log10_likelihoods(model, q)
            flat, row = np.concatenate(q), np.repeat(np.arange(len(q)), [len(x) for x in q])
            extra = np.bincount(row, weights=spread[flat], minlength=len(q))
            own = np.bincount(row, weights=base[flat], minlength=len(q))
            yield pa.record_batch([*[part.column(c) for c in ("doc_id", "row", "held_out", "n_tokens", "n_rare")], pa.array(likelihood + extra), pa.array(own)], names=["doc_id", "row", "held_out", "n_tokens", "n_rare", "model_part", "base_part"])

    return task


#: sums of a bucket sent on at once; packing them together keeps the exchange at buckets x buckets rows
MOST_SUMS = 4_000_000


def _bags(top: np.ndarray, n: int):
    """Every text's words without symbols of their own, each once per text, to the bucket of the word."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for chunk in C.doc_chunks(batches, CHUNK, "words"):
                words, counts = _words_of(chunk)
                some = np.flatnonzero(~_is_in(words, top))
                row, word = C.places(counts)[0][some], words[some]
                order = np.lexsort((word, row))
                row, word = row[order], word[order]
                at = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (word[1:] != word[:-1])])) if len(row) else order
                n_of = np.diff(np.append(at, len(row)))
                ids, word = np.asarray(chunk.column("row"))[row[at]], word[at]
                yield from C.split_packed(C.bucket_of(word, n), n, [word], [ids, n_of])

        return C.packed_batches(rows())

    return task


def _look_up(n: int):
    """For the words of a bucket and the texts that hold them: sums over each text of log10(count + 1)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, bags = np.empty(0, COUNT), []
        for batch in batches:
            for is_count, p in zip(batch.column("is_count").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                if is_count:
                    counts = np.frombuffer(p, COUNT)
                else:
                    bags.append(p)

        def rows():
            held: list[tuple] = []
            for p in bags:
                word, row, k = C.unpack(p, [np.uint64], 2)
                c = np.zeros(len(word), np.int64)
                if len(counts):
                    at = np.minimum(np.searchsorted(counts["word"], word), len(counts) - 1)
                    c = np.where(counts["word"][at] == word, counts["n"][at].astype(np.int64), 0)
                ids, inverse = np.unique(row, return_inverse=True)
                logs = np.bincount(inverse, weights=k * np.log10(c + 1.0)).astype(np.float64)
                known = np.bincount(inverse, weights=k * (c > 0)).astype(np.int64)
                total = np.bincount(inverse, weights=k).astype(np.int64)
                held.append((logs, ids, known, total))
                if sum(len(h[1]) for h in held) > MOST_SUMS:
                    yield from sent(held)
                    held = []
            if held:
                yield from sent(held)

        def sent(held: list[tuple]):
            logs, ids, known, total = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(ids, kind="stable")
            logs, ids, known, total = logs[order], ids[order], known[order], total[order]
            return C.split_packed(C.id_buckets(ids, n), n, [logs], [ids, known, total])

        yield from C.packed_batches(rows())

    return task


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = C.gather(batches, [np.float64], 3)
    if got is not None:
        logs, row, known, total = got
        ids, inverse = np.unique(row, return_inverse=True)
        sums = [np.bincount(inverse, weights=x, minlength=len(ids)) for x in (logs, known, total)]
        yield pa.record_batch([pa.array(ids), pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2])], names=["of", "logs", "known", "total"])


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Train on the rows that are not held out and score all: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Held out are rows with crc32(doc_id as text) mod 7 = 2; a row without an id is not. Tokens are words
    ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased and one end. base_score sums log10((c + 1) / (N + V + 1)); score is the
    model's log10 probability of the whole text, a word not seen in training counting as the one unseen word of its
    class. Null or empty text: the end alone. With no training rows counts are 0. Repeated rows count as often as they
    stand.
    """
    spark = docs.sparkSession
    n = C.buckets_of(spark)
    work = C.Scratch(spark, "hmm")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("row", F.xxhash64("doc_id", F.col("text").isNull(), "text"))

    tokens = work.write(docs.select("doc_id", "row", "held_out", "text").mapInArrow(_tokenise, WORDS), "words")
    sent = tokens.where("not held_out").select("words").mapInArrow(_count(n), C.PACKED)
    counted = work.write(C.exchange(sent, n).mapInArrow(_add_up, COUNTED), "counts", by=["kind"])
    counts = counted.where("kind = 'counts'").select("bucket", "payload", "n", "distinct")
    ends = tokens.where("not held_out").count()
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    n_all, v_all = sums[0] + ends, sums[1] + (ends > 0)
    # written first: the commonest of all meet in a task, and only those come to the driver
    common = counted.where("kind = 'top'").select("word", "n").orderBy(F.col("n").desc(), "word").limit(TOP_WORDS)
    common = work.write(common, "top").orderBy(F.col("n").desc(), "word").collect()
    top = np.array([r[0] for r in common], np.int64).view(np.uint64)
    order = np.argsort(top)
    top, rank = top[order], order.astype(np.int64)
    by_class = counts.select("payload").mapInArrow(_class_sums(top), "cls bigint, n bigint, distinct bigint").groupBy("cls").agg(F.sum("n").alias("n"), F.sum("distinct").alias("distinct")).collect()
    class_n, class_v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in by_class:
        class_n[r[0]], class_v[r[0]] = r[1], r[2]

    texts = work.write(tokens.mapInArrow(_to_symbols(top, rank), TEXTS), "symbols")
    frequency = np.zeros(SYMBOLS)
    frequency[0] = ends
    frequency[1 : 1 + len(common)] = [r[1] for r in common]
    frequency[1 + TOP_WORDS :] = class_n
    model = Model.initial(frequency, states)
    train = texts.where("not held_out").select("symbols")
    for _ in range(rounds if ends else 0):
        parts = train.mapInArrow(_expect(model), "part bigint, counts array<double>")
        total = parts.groupBy("part").agg(*[F.sum(F.col("counts")[i]).alias(f"c{i}") for i in range(states)]).collect()
        sums_ = np.zeros((SYMBOLS + 1 + states, states))
        for r in total:
            sums_[r[0]] = r[1:]
        model = model.next(sums_[SYMBOLS], sums_[SYMBOLS + 1 :], sums_[:SYMBOLS].T)

    own = np.log10(n_all + v_all + 1.0)
    spread, base = np.zeros(SYMBOLS), np.full(SYMBOLS, -own)
    spread[1 + TOP_WORDS :] = -np.log10(class_n + class_v + 1.0)
    known = frequency[: 1 + TOP_WORDS]
    base[: 1 + TOP_WORDS] += np.log10(known + 1.0)
    scored = texts.mapInArrow(_score(model, spread, base), "doc_id bigint, row bigint, held_out boolean, n_tokens bigint, n_rare bigint, model_part double, base_part double")

    bags = tokens.select("row", "words").mapInArrow(_bags(top, n), C.PACKED).withColumn("is_count", F.lit(False))
    both = bags.unionByName(counts.select("bucket", "payload", F.lit(True).alias("is_count")))
    looked = C.exchange(both, n).mapInArrow(_look_up(n), C.PACKED)
    sums_by_row = work.write(C.exchange(looked, n).mapInArrow(_sum_up, "of bigint, logs double, known double, total double"), "sums")
    work.drop(tokens)
    out = scored.join(sums_by_row, F.col("row") == F.col("of"), "left")
    # rows repeated with the same id and text are summed together; each has its share
    share = F.coalesce(F.try_divide(F.col("n_rare"), F.col("total")), F.lit(0.0))
    logs = F.coalesce(F.col("logs") * share, F.lit(0.0))
    n_known = F.col("n_tokens") - F.col("n_rare") + F.coalesce(F.round(F.col("known") * share), F.lit(0)) - F.lit(0 if ends else 1)
    return out.select("doc_id", "held_out", "n_tokens", n_known.cast("long").alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"), (F.col("base_part") + logs).alias("base_score"), (F.col("model_part") + logs).alias("score"))
