"""Token ids of whole texts with a public word-level BPE vocabulary.

The vocabulary lower-cases, drops white space and merges inside words, so a text's ids are
its words' ids in a row. Words are found, hashed (64 bits) and made distinct as arrays over
the byte buffer of a batch; each task asks the tokenizer only for words that its bounded
cache doesn't hold, and the ids of all occurrences are gathered as one array.
"""
from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from barspark.llm import textops as T

VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 250_000
_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
# byte-level vocabularies write the bytes 0xC3 0x80-0xBF of these letters as two characters
_BYTE_CHARS = {0xC0 + k: "\xc3" + (chr(0x122 + k) if k < 0x21 else "Ń" if k == 0x2D else chr(0x80 + k)) for k in range(0x40)}
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord("."), ord(",")]] = True


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file: the installed ``public_tokenizers`` module, or
    the folder it is distributed in."""
    try:
        import public_tokenizers
        return public_tokenizers.path(name)
    except ModuleNotFoundError:
        return f"{os.environ.get('PUBLIC_TOKENIZERS', '/opt/tokenizers')}/{name}"


class _Store:
    """Ids of words by hash: positions in one flat array."""

    def __init__(self):
        self.index: dict[int, int] = {}
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(4096, np.uint32), 0

    def add(self, hashes: list[int], ids: list) -> None:
        n, base = len(hashes), len(self.index)
        size = np.fromiter(map(len, ids), np.int64, n)
        new = np.fromiter((i for word in ids for i in word), np.uint32, int(size.sum()))
        self.start, self.size = _room(self.start, base + n), _room(self.size, base + n)
        self.flat = _room(self.flat, self.used + len(new))
        self.size[base:base + n] = size
        self.start[base:base + n] = self.used + np.cumsum(size) - size
        self.flat[self.used:self.used + len(new)] = new
        self.used += len(new)
        self.index.update(zip(hashes, range(base, base + n)))

    def ids(self, place: int) -> np.ndarray:
        return self.flat[self.start[place]:self.start[place] + self.size[place]]


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


class WordEncoder:
    """Ids of batches of texts. The cache has two generations: a full young one becomes the
    old one, and words met again move back."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cache_words = cache_words
        self.young, self.old = _Store(), _Store()

    def texts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids of some rows' texts in a row, where each text begins and the total)."""
        data, offs = T.text_bytes(column)
        for lo, hi in T.chunks(offs):
            yield lo, *self._encode(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])

    def _encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, first = T.word_spans(data, offs)
        starts, ends, first = _split_marks(data, starts, ends, first)
        hashes = T.span_hashes(data, starts, ends, lower=True)
        distinct, example, occurrence = np.unique(hashes, return_index=True, return_inverse=True)
        place = self._places(distinct.tolist(), data, starts[example], ends[example])
        size = self.young.size[place][occurrence]
        total = np.concatenate([[0], np.cumsum(size)])
        gather = np.repeat(self.young.start[place][occurrence] - total[:-1], size) + np.arange(total[-1])
        return self.young.flat[gather], total[first]

    def _places(self, hashes: list[int], data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = list(map(self.young.index.get, hashes))
        missing = [k for k, p in enumerate(found) if p is None]
        if len(self.young.index) + len(missing) > self.cache_words:
            self.old, self.young = self.young, _Store()
            missing = list(range(len(hashes)))
        if missing:
            self._learn([(hashes[k], data[starts[k]:ends[k]]) for k in missing])
            found = list(map(self.young.index.__getitem__, hashes))
        return np.array(found, np.int64)

    def _learn(self, words: list[tuple[int, np.ndarray]]) -> None:
        keys, ids, fresh = [], [], []
        for key, raw in words:
            place = self.old.index.get(key)
            if place is not None:
                keys.append(key)
                ids.append(self.old.ids(place))
                continue
            word = raw.tobytes().decode()
            if _LETTERS.fullmatch(word):
                # Latin letters are one word for the vocabulary: its merges apply at once to the
                # characters that stand for the bytes
                small = word.lower()
                keys.append(key)
                ids.append([t.id for t in self.model.tokenize(small if small.isascii() else small.translate(_BYTE_CHARS))])
            else:
                fresh.append((key, word))
        for (key, _), got in zip(fresh, self.tokenizer.encode_batch([w for _, w in fresh], add_special_tokens=False)):
            keys.append(key)
            ids.append(got.ids)
        self.young.add(keys, ids)


def _split_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray):
    """A closing stop or comma after a Latin-1 letter is a word of its own for the vocabulary;
    apart, fewer words are distinct."""
    if not len(starts):
        return starts, ends, first
    last = ends - 1
    before, lead = data[np.maximum(last - 1, 0)], data[np.maximum(last - 2, 0)]
    latin = (lead == 0xC3) & (before >= 0x80) & (before < 0xC0) & (before != 0x97) & (before != 0xB7)
    closed = _MARK[data[last]] & (((ends - starts > 1) & _ASCII_LETTER[before]) | ((ends - starts > 2) & latin))
    shift = np.concatenate([[0], np.cumsum(closed)])
    at = np.arange(len(starts)) + shift[:-1]
    new_starts, new_ends = np.empty(len(starts) + shift[-1], np.int64), np.empty(len(starts) + shift[-1], np.int64)
    new_starts[at], new_ends[at] = starts, ends - closed
    marks = at[closed] + 1
    new_starts[marks], new_ends[marks] = last[closed], ends[closed]
    return new_starts, new_ends, first + shift[first]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
