"""Array passes over the UTF-8 bytes of a batch of texts.

The word class of the operators is ``[^\\x20\\x09-\\x0D]+``: its separators are single
bytes that never occur inside a multi-byte character, so words, lines and their 64-bit
hashes come straight from Arrow's byte buffer, without a Python object per word.
Temporary arrays are bounded by ``PIECE`` bytes, however long a text is.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MULT = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = 0xD6E8FEB86659FD93
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the (odd) base and of its inverse modulo 2**64, at least ``n``."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, PIECE)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end positions of the runs of ``inside``, cut at text borders."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(n + 1, bool)
    border[offs] = True
    first = inside.copy()
    first[1:] &= border[1:n] | ~inside[:-1]
    last = inside.copy()
    last[:-1] &= border[1:n] | ~inside[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, index of the first word of each text and the total)."""
    starts, ends = spans(~_SPACE[data], offs)
    return starts, ends, np.searchsorted(starts, offs)


def line_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines between newlines (empty lines have no word and are left out)."""
    starts, ends = spans(data != 0x0A, offs)
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span (spans in order, not overlapping): differences of a
    prefix polynomial, brought to the same origin by the inverse power."""
    out = np.empty(len(starts), np.uint64)
    table = _BYTE_LOWER if lower else _BYTE
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = power_table(b - a)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * up[:b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _MULT)
        i = j
    return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive word hashes (borders are the caller's)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = words[:n] * _MULT
    for k in range(1, size):
        acc = (acc + words[k:k + n]) * _MULT
    return mix(acc + np.uint64(size))


def chunks(offs: np.ndarray, limit: int = 2 * PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes (at least one row each)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
