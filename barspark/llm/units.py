"""Token ids of whole texts with vocabularies that keep white space.

A unit is a run of white space and the characters up to the next one. Where both sides of a
cut can never share a token, a text's ids are its units' ids in a row. Units are found,
hashed (64 bits) and made distinct as arrays over the byte buffer of a batch. The tokenizer
gets only units that the bounded cache doesn't hold, many of them as one text (units are
independent in any order), and the ids of all occurrences are gathered as one array. Long
units (text without spaces) are never cached.

Cuts are made before an ASCII white-space character whose left neighbour is no white space
in Unicode's sense: there, a byte-level vocabulary's pattern always begins a new match. For
a piece vocabulary, no piece may join the two sides (``piece_cuts`` reads that from the
pieces themselves).
"""
from __future__ import annotations

import os
from collections.abc import Callable, Sequence

import numpy as np

from barspark.llm import textops as T

CACHE_UNITS = 400_000
CACHE_IDS = 1 << 21     # ids a generation of the cache may hold (4 bytes each)
LONGEST = 48            # bytes of a unit that is worth caching
JOINED = 1 << 13        # bytes of units that are encoded as one text
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
# White space of Unicode beyond ASCII (fixed values); no unit begins behind it
_WIDE = [chr(c) for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_WIDE_2 = np.array([int.from_bytes(c.encode(), "big") for c in _WIDE if len(c.encode()) == 2])
_WIDE_3 = np.array([int.from_bytes(c.encode(), "big") for c in _WIDE if len(c.encode()) == 3])
_BLANK_BEFORE = T._SPACE.copy()
_BLANK_BEFORE[0x1C:0x20] = True     # separators that some patterns count as white space


def unit_starts(data: np.ndarray, offs: np.ndarray, cut_before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of every unit, index of each text's first unit and the total). ``cut_before``
    tells, per byte value, whether a unit may begin with it; white space is cut nowhere else."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    cut = cut_before[data]
    cut[1:] &= ~_BLANK_BEFORE[data[:-1]]
    wide = np.flatnonzero(cut[1:] & (data[:-1] >= 0x80)) + 1
    if len(wide):
        d = data.astype(np.int64)
        two = d[np.maximum(wide - 2, 0)] << 8 | d[wide - 1]
        three = d[np.maximum(wide - 3, 0)] << 16 | two
        cut[wide[np.isin(two, _WIDE_2) | np.isin(three, _WIDE_3)]] = False
    cut[offs[:-1][offs[:-1] < n]] = True
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(starts, offs)


def cut_table(allowed: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(allowed)] = True
    return table


class _Known:
    """Ids of units by hash: sorted hashes, and where each unit's ids lie in one flat array."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of ``keys``, -1 where unknown."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def add(self, keys: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        """New ``keys`` (sorted), their ids in a row and the number of ids of each."""
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, len(self.flat) + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.flat = np.concatenate([self.flat, flat])

    def ids(self, at: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.begin[at], self.size[at])


class UnitEncoder:
    """Ids of distinct units. ``encode`` gives the ids of a list of units in a row and how many
    each unit has; a unit without ids marks a text that the vocabulary can't give back. The
    cache has two generations: a full young one becomes the old one, and units met again
    move back."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], cache_units: int = CACHE_UNITS,
                 cache_ids: int = CACHE_IDS):
        self.encode = encode
        self.cache_units, self.cache_ids = cache_units, cache_ids
        self.young, self.old = _Known(), _Known()

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, begin and size of each unit's ids in them)."""
        hashes = T.span_hashes(data, starts, ends)
        keys, example, occurrence = np.unique(hashes, return_index=True, return_inverse=True)
        a, b = starts[example], ends[example]
        short = np.flatnonzero(b - a <= LONGEST)
        missing = short[self.young.find(keys[short]) < 0]
        if len(self.young.keys) + len(missing) > self.cache_units or len(self.young.flat) > self.cache_ids:
            self.old, self.young = self.young, _Known()
            missing = short
        if len(missing):
            at = self.old.find(keys[missing])
            again, fresh = missing[at >= 0], missing[at < 0]
            if len(again):
                at = at[at >= 0]
                self.young.add(keys[again], self.old.ids(at), self.old.size[at])
            if len(fresh):
                self.young.add(keys[fresh], *self._encoded(data, a[fresh], b[fresh]))
        begin, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = self.young.find(keys[short])
        begin[short], size[short] = self.young.begin[at], self.young.size[at]
        flat = self.young.flat
        rest = np.flatnonzero(b - a > LONGEST)
        if len(rest):
            own, size[rest] = self._encoded(data, a[rest], b[rest])
            begin[rest] = len(flat) + np.cumsum(size[rest]) - size[rest]
            flat = np.concatenate([flat, own])
        return flat, begin[occurrence], size[occurrence]

    def _encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        return self.encode([raw[x:y] for x, y in zip(starts.tolist(), ends.tolist())])


def gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ids of all units in a row."""
    total = np.concatenate([[0], np.cumsum(size)])
    return flat[np.repeat(begin - total[:-1], size) + np.arange(total[-1])]


def byte_level_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary. Printable bytes stand for themselves,
    the others for the characters from U+0100 on, in order."""
    tokenizer = load(path)
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
    out = []
    for i in range(tokenizer.get_vocab_size(with_added_tokens=True)):
        entry = tokenizer.id_to_token(i)
        out.append(bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode())
    return out


def load(path: str, special: bool = True):
    """A tokenizer file; with ``special`` false, the strings of special tokens are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    return tokenizer


class Entries:
    """The bytes of a vocabulary's entries, to cut ids of joined units apart again."""

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def cut(self, units: list[bytes], ids: np.ndarray) -> np.ndarray | None:
        """Number of ids of each unit, if ``ids`` give back the joined units byte by byte."""
        raw = np.frombuffer(b"".join(units), np.uint8)
        size = self.sizes[ids]
        end = np.cumsum(size)
        if (end[-1] if len(end) else 0) != len(raw) or (gather(self.flat, self.begin[ids], size) != raw).any():
            return None
        bounds = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        at = np.searchsorted(end, bounds)
        if (end[at] != bounds).any():
            return None
        return np.diff(at, prepend=-1)

    def encode(self, units: list[bytes], joined: Callable[[list[list[bytes]]], list[Sequence[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row and their number per unit. Units that begin with white space are encoded
        several at once; others, and those that don't come back as they were, one by one."""
        alone = [k for k, u in enumerate(units) if u[0] not in BLANKS]
        lists: list[tuple[list[int], list[bytes]]] = [([k], [units[k]]) for k in alone]
        own = set(alone)
        places: list[int] = []
        filled = 0
        for k, u in enumerate(units):
            if k in own:
                continue
            if filled + len(u) > JOINED and places:
                lists.append((places, [units[i] for i in places]))
                places, filled = [], 0
            places.append(k)
            filled += len(u)
        if places:
            lists.append((places, [units[i] for i in places]))
        got = [np.array(x, np.uint32) for x in joined([part for _, part in lists])]
        sizes = np.zeros(len(units), np.int64)
        order, flat = [], []
        for (at, part), ids in zip(lists, got):
            n = self.cut(part, ids)
            if n is None and len(part) > 1:
                for k, u, one in zip(at, part, joined([[u] for u in part])):
                    one = np.array(one, np.uint32)
                    n = self.cut([u], one)
                    if n is not None:
                        sizes[k] = len(one)
                        order.append(np.full(len(one), k))
                        flat.append(one)
            elif n is not None:
                sizes[at] = n
                order.append(np.repeat(np.array(at), n))
                flat.append(ids)
        if not flat:
            return np.zeros(0, np.uint32), sizes
        return np.concatenate(flat)[np.argsort(np.concatenate(order), kind="stable")], sizes


def byte_level_encoder(path: str, special: bool = True) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    tokenizer, entries = load(path, special), Entries(byte_level_bytes(path))

    def joined(parts: list[list[bytes]]) -> list[Sequence[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast([b"".join(p).decode() for p in parts], add_special_tokens=False)]
    return lambda units: entries.encode(units, joined)


class Pieces:
    """A sentencepiece vocabulary that writes a space as U+2581 and puts one before a text."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(names)]
        self.entries = Entries(self.bytes)
        self.space = self.model.piece_to_id("▁")
        plain = [b for i, b in enumerate(self.bytes)
                 if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        # before a space: no piece has one after another character; before others: no piece has them at all
        space = all(b" " not in b.lstrip(b" ") for b in plain)
        self.cuts = (b" " if space else b"") + bytes(c for c in BLANKS[1:] if not any(c in b for b in plain))

    def _joined(self, parts: list[list[bytes]]) -> list[Sequence[int]]:
        """Ids of parts of (space + text): the vocabulary adds the space a part begins with;
        where it begins with another character, the added space is a piece of its own."""
        texts = [b"".join(p) for p in parts]
        own = [t[:1] == b" " for t in texts]
        ids = self.model.encode([(t[1:] if o else t).decode() for t, o in zip(texts, own)], num_threads=1) if texts else []
        return [(got or [self.space]) if o else got[1:] for got, o in zip(ids, own)]

    def encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.entries.encode(units, self._joined)
