"""Token ids of a word-wise BPE tokenizer file, each distinct word encoded once per batch."""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

from tokenizers import Tokenizer, pre_tokenizers

from adjudica.llm import _common as C

#: words that need no more than lower-casing before they are split; others go through the whole tokenizer
PLAIN = "^[!-~À-ÖØ-öø-ÿ]*$"
#: the file's own split of a word, for plain words; \n ends a word here
SPLIT = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+")
LINE = 2000
#: what a file's tokenizer must give the same ids for by either way before words are encoded apart
PROBE = "Don't STOP it's we'll they've I'm he'd 1234 3.14 a-b x_y #tag @me (a) [b] {c} e.g. 'tis o'clock naïve ÀÖØ straße ÿ ½ Σίσυφος İstanbul ﬁ 日本語 a\u0301 \x85 \u00a0 ... --- !? Zürich's A1b2 \t x\n\ny"


def _ragged(values: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """values[b : b + n] for each begin and length, joined."""
    total = int(length.sum())
    step = np.repeat(begin - (np.cumsum(length) - length), length)
    return values[np.arange(total) + step]


class WordTokenizer:
    """Ids of texts. Distinct words are encoded once, if the file's tokenizer never looks across white space and drops it;
    any other file's texts go through its tokenizer whole."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.plain.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        for piece, i in vocab.items():
            self.last[i] = piece.endswith("</w>")
        self.by_word = self._agrees()

    def _agrees(self) -> bool:
        texts = [PROBE, *PROBE.split(), PROBE.lower()]
        want = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        try:
            ids, ends = self._encode_words(pa.array(texts), 0)
        except ValueError:
            return False
        return [x.tolist()[:-1] for x in np.split(ids, ends[:-1])] == want

    @functools.cached_property
    def whole(self) -> Tokenizer:
        """The tokenizer as it is in the file."""
        return Tokenizer.from_file(self.path)

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of split pieces, joined, and where each ends."""
        lines = [" ".join(pieces[i : i + LINE]) for i in range(0, len(pieces), LINE)]
        got = [np.array(self.plain.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32) for line in lines]
        ids = np.concatenate(got) if got else np.empty(0, np.uint32)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(pieces):
            raise ValueError("the tokenizer does not mark word ends")
        return ids, ends

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, joined, and the number of each."""
        simple = np.asarray(pc.and_(pc.match_substring_regex(words, PLAIN), pc.invert(pc.match_substring(words, "<|"))))
        n = np.zeros(len(words), np.int64)
        parts = np.array(SPLIT.findall("\n".join(pc.utf8_lower(words.filter(pa.array(simple))).to_pylist()) + "\n") if simple.any() else [], object)
        is_end = parts == "\n"
        encoded = pa.array(parts[~is_end], pa.string()).dictionary_encode()
        ids, ends = self._pieces(encoded.dictionary.to_pylist())
        begin, which = np.concatenate([[0], ends[:-1]]).astype(np.int64), np.asarray(encoded.indices)
        size = (ends - begin)[which] if len(which) else np.empty(0, np.int64)
        a = _ragged(ids, begin[which], size) if len(which) else np.empty(0, np.uint32)
        owner = np.cumsum(is_end)[~is_end]
        n[simple] = np.bincount(owner, weights=size, minlength=int(simple.sum())).astype(np.int64)
        rest = words.filter(pa.array(~simple)).to_pylist()
        other = [np.array(e.ids, np.uint32) for e in self.whole.encode_batch_fast(rest, add_special_tokens=False)] if rest else []
        n[~simple] = [len(x) for x in other]
        begins = np.empty(len(words), np.int64)
        begins[simple] = np.cumsum(n[simple]) - n[simple]
        begins[~simple] = len(a) + np.cumsum(n[~simple]) - n[~simple]
        self.flat = np.concatenate([a, *other])
        return begins, n

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, joined; and where each text ends."""
        if self.by_word:
            return self._encode_words(texts, end_id)
        got = self.whole.encode_batch_fast(pc.fill_null(texts, "").to_pylist(), add_special_tokens=False)
        each = [np.array([*e.ids, end_id], np.uint32) for e in got]
        return np.concatenate([np.empty(0, np.uint32), *each]), np.cumsum([len(x) for x in each])

    def _encode_words(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        flat, counts = C.words_of(texts)
        words = flat.dictionary_encode()
        begins, n = self._words(words.dictionary)
        which = np.asarray(words.indices)
        row, _ = C.places(counts)
        per_text = np.bincount(row, weights=n[which], minlength=len(counts)).astype(np.int64) if len(which) else np.zeros(len(counts), np.int64)
        out = np.full(int(per_text.sum()) + len(counts), end_id, np.uint32)
        ends = np.cumsum(per_text + 1)
        is_id = np.ones(len(out), bool)
        is_id[ends - 1] = False
        if len(which):
            out[is_id] = _ragged(self.flat, begins[which], n[which])
        return out, ends


@functools.lru_cache(maxsize=1)
def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a file, read once per Python worker."""
    return WordTokenizer(path)
