"""SentencePiece encoding and decoding: N-best segmentation over the piece lattice.

The vocabulary is a public model file. Its scores are merge ranks, not probabilities, so
the piece of rank r gets the Zipf log-probability -log(r + 2.7) (normalised); characters
outside the vocabulary fall back to their bytes. Spaces are the vocabulary's space
mark, one is put in front of the text, and nothing else is normalised, so
decoding gives the text back exactly.

No piece holds a space after another character, or a line break, so the lattice of a text
falls apart into words (with the spaces before them), line breaks and closing
spaces. The N best of a text are the N smallest sums of its words' losses against their best, and
only the N - 1 words whose second best loses least can be in one of them. So every word gets a
forward pass for its best and second-best score at every position, and the best segmentation is
read back from it; the N best are searched for those N - 1 words of each text, and for words with
two equal best. That search is a backward A-star with the forward scores as exact heuristic, which
pops the N best segmentations in order. Only the best N open hypotheses matter, as each completes with
exactly its estimate, so the agenda has N entries. A word of more than 63 characters (scripts without
spaces) is first cut wherever no piece of the vocabulary lies across, as the lattice falls
apart there too. Words of up to 63 characters are passed and searched together, array by array; what is
longer even then one by one, over arcs that are found as arrays. A cache of bounded bytes keeps
the words of up to 63 characters that a task has met.

Defined results: a null or empty text has no pieces, one segmentation with score 0, and
decodes to the empty text; of equal scores, the order is fixed but arbitrary
(losses of earlier words first); very long texts and words are segmented whole; repeated
rows and null ids are carried along; an empty table gives no rows.
"""
from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from barspark.llm import textops as T
from barspark.llm.common import map_batches, table, texts_of
from barspark.llm.encoding import vocabulary_path

MODEL = "piece_bpe_32k.model"
N_BEST = 4
CACHE_BYTES = 350 << 20     # of a worker; passed by the words of one batch at most
WORD_BYTES = 320            # of a cached word besides its characters and ids
ZIPF_SHIFT = 2.7
BYTE_PENALTY = 10.0
LONGEST = 63
BLOCK = 4096                # words passed together
NEAR = 1e-6                 # far above the rounding of a word's scores
SIEVE_BITS = 20
_SPLIT = re.compile(r" *[^ \n]+| +|\n")
_RANDOM = np.random.Generator(np.random.PCG64(31)).integers(1, 2**63, 2, dtype=np.uint64)


class PieceLattice:
    """Pieces, their scores, and the N-best search."""

    def __init__(self, path: str, n: int = N_BEST, cache_bytes: int = CACHE_BYTES):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.n, self.cache_bytes = n, cache_bytes
        self.byte_id = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(size) if model.is_byte(i)}
        own = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.ids = {model.id_to_piece(i).replace("▁", " "): i for i in own}
        crossing = [p for p in self.ids if re.search(r"[^ ] |\n", p)]
        if crossing:
            raise ValueError(f"pieces cross words, the lattice cannot be cut there: {crossing[:5]}")
        weight = 1.0 / (np.arange(len(own)) + ZIPF_SHIFT)
        score = np.log(weight / weight.sum())
        self.score = dict(zip(self.ids, score.tolist()))
        self.byte_score = float(score.min()) - BYTE_PENALTY
        self.width = max(map(len, self.ids))
        self.raw = np.full(size, None, object)
        for b, i in self.byte_id.items():
            self.raw[i] = bytes([b])
        for p, i in self.ids.items():
            self.raw[i] = p.encode()
        names = list(self.ids)
        self.window = max(2 * self.width, LONGEST)
        length = self.window + 1
        self.up, self.down = T.power_table(length + 1)
        size_of, ids_of = np.array(list(map(len, names))), np.array(list(self.ids.values()), np.int64)
        self.tables = {}            # per piece length: sorted hashes, their scores and ids
        self.sieve = np.zeros(1 << SIEVE_BITS, bool)        # by their first bits: whether a piece may have a hash
        for k in np.unique(size_of).tolist():
            own = np.flatnonzero(size_of == k)
            by_hash = self._hashes(_points("".join([names[i] for i in own.tolist()])).reshape(-1, k))
            order = np.argsort(by_hash)
            self.tables[k] = by_hash[order], score[own[order]], ids_of[own[order]]
            self.sieve[_sieved(by_hash)] = True
        self._forget()

    def _forget(self, room: int = 0) -> None:
        """An empty cache with room for ``room`` words."""
        self.size = 0
        self.kept = 0                                   # words before this place are short and stay
        self.index: dict[str, int] = {}
        self.words: list[str] = []
        self.first: list[bytes] = []                    # ids of the best segmentation
        self.long_paths: dict[int, list[bytes]] = {}
        room = max(room, 1024)
        self.best = np.zeros(room)
        self.gap = np.zeros(room)                       # to the second best, but for rounding
        self.searched = np.zeros(room, bool)            # the rest is known of these words only
        self.loss = np.full((room, self.n - 1), np.inf)
        self.masks = np.zeros((room, self.n), np.uint64)

    # forward scores and search, many words at once

    def _hashes(self, points: np.ndarray) -> np.ndarray:
        """Hash of the characters of every row."""
        size = points.shape[1]
        coded = T.mix(points.astype(np.uint64) + _RANDOM[0]) * self.up[None, :size]
        return T.mix(coded.sum(axis=1, dtype=np.uint64) + np.uint64(size))

    def _arcs(self, points: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length - 1, end, word): score and id of the piece of that length that ends there;
        id -1 is a character's bytes. ``points`` holds a word per column."""
        length, w = points.shape
        coded = T.mix(points.astype(np.uint64) + _RANDOM[0]) * self.up[:length, None]
        sums = np.zeros((length + 1, w), np.uint64)
        np.cumsum(coded, axis=0, out=sums[1:])
        found, longest = [], 1
        for k, (hashes, piece_score, piece_id) in self.tables.items():
            if k > length:
                break
            h = T.mix((sums[k:] - sums[:-k]) * self.down[:length - k + 1, None] + np.uint64(k)).ravel()
            at = np.flatnonzero(self.sieve[_sieved(h)])
            h = h[at]
            near = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            begin, word = np.divmod(at, w)
            hit = np.flatnonzero((hashes[near] == h) & (begin + k <= size[word]))
            if len(hit):
                near, longest = near[hit], k
                found.append((k, begin[hit] + k, word[hit], piece_score[near], piece_id[near]))
        out = np.full((longest, length + 1, w), -np.inf)
        ids = np.full((longest, length + 1, w), -1, np.int32)
        for k, end, word, score, piece in found:
            out[k - 1, end, word] = score
            ids[k - 1, end, word] = piece
        wide = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        single = out[0, 1:]
        out[0, 1:] = np.where(np.isinf(single) & (np.arange(length)[:, None] < size[None, :]),
                              wide * self.byte_score, single)
        return out, ids

    @staticmethod
    def _forward(arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end, word): scores of the best and of the second-best way there."""
        width, ends, w = arcs.shape
        there = arcs.max(axis=2) > -np.inf
        first, second = np.full((2, ends, w), -np.inf)
        first[0] = 0.0
        for j in range(1, ends):
            best, next_best = first[j], second[j]
            for k in (np.flatnonzero(there[:j, j]) + 1).tolist():
                arc = arcs[k - 1, j]
                way = first[j - k] + arc
                np.maximum(next_best, np.minimum(best, way), out=next_best)
                np.maximum(next_best, second[j - k] + arc, out=next_best)
                np.maximum(best, way, out=best)
        return first, second

    def best_two(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Scores and cut masks of the best segmentation of words of 1 to LONGEST characters, its
        distance from the second best (inf: there is none), and its ids. Up to rounding, and of
        equal ones any is the best."""
        points, size = _columns(words)
        arcs, ids = self._arcs(points, size)
        first, second = self._forward(arcs)
        w, steps = len(words), np.arange(1, len(arcs) + 1)[:, None]
        every = np.arange(w)
        gap = first[size, every] - second[size, every]
        score, mask, place = np.zeros(w), np.zeros(w, np.uint64), size.copy()
        rows = every
        while len(rows):
            p = place[rows]
            at = np.maximum(p[None, :] - steps, 0)
            new = score[rows][None, :] + arcs[:, p, rows]
            pick = (first[at, rows[None, :]] + new).argmax(axis=0), np.arange(len(rows))
            score[rows], place[rows] = new[pick], at[pick]
            mask[rows] |= np.uint64(1) << at[pick].astype(np.uint64)
            rows = rows[at[pick] > 0]
        return score, mask, gap, self._best_ids(words, size, mask, ids)

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Scores and cut masks of the N best segmentations of words of 1 to LONGEST characters
        (-inf where a word has fewer; bit p of a mask is a cut before character p), and the
        ids of the best."""
        n, w = self.n, len(words)
        points, size = _columns(words)
        arcs, ids = self._arcs(points, size)
        length, width = len(points), len(arcs)
        forward, _ = self._forward(arcs)

        estimate = np.full((w, n), -np.inf)
        estimate[:, 0] = forward[size, np.arange(w)]
        so_far = np.zeros((w, n))
        place = np.zeros((w, n), np.int64)
        place[:, 0] = size
        mask = np.zeros((w, n), np.uint64)
        scores, masks = np.full((w, n), -np.inf), np.zeros((w, n), np.uint64)
        done = np.zeros(w, np.int64)
        steps = np.arange(1, width + 1)
        while True:
            top = estimate.max(axis=1)
            rows = np.flatnonzero((done < n) & np.isfinite(top))
            if not len(rows):
                return scores, masks, self._best_ids(words, size, masks[:, 0], ids)
            tied = estimate[rows] == top[rows, None]
            pick = np.where(tied, place[rows], length + 1).argmin(axis=1)
            p, g, cut = place[rows, pick], so_far[rows, pick], mask[rows, pick]
            estimate[rows, pick] = -np.inf
            ended = p == 0
            e = rows[ended]
            scores[e, done[e]], masks[e, done[e]] = g[ended], cut[ended]
            done[e] += 1
            rows, p, g, cut = rows[~ended], p[~ended], g[~ended], cut[~ended]
            if not len(rows):
                continue
            before = p[:, None] - steps[None, :]
            fits = before >= 0
            at = np.maximum(before, 0)
            new_g = g[:, None] + np.where(fits, arcs[:, p, rows].T, -np.inf)
            all_e = np.concatenate([estimate[rows], forward[at, rows[:, None]] + new_g], axis=1)
            keep = np.argsort(-all_e, axis=1, kind="stable")[:, :n]
            take = lambda a: np.take_along_axis(a, keep, axis=1)
            estimate[rows] = take(all_e)
            so_far[rows] = take(np.concatenate([so_far[rows], new_g], axis=1))
            place[rows] = take(np.concatenate([place[rows], at], axis=1))
            bits = cut[:, None] | (np.uint64(1) << at.astype(np.uint64))
            mask[rows] = take(np.concatenate([mask[rows], bits], axis=1))

    def _best_ids(self, words: list[str], size: np.ndarray, mask: np.ndarray, ids: np.ndarray) -> list[bytes]:
        cut = (mask[:, None] >> np.arange(ids.shape[1], dtype=np.uint64) & np.uint64(1)).astype(bool)
        cut[np.arange(len(words)), size] = True
        row, place = np.nonzero(cut)
        inner = row[1:] == row[:-1]
        row, end = row[1:][inner], place[1:][inner]
        found = ids[end - place[:-1][inner] - 1, end, row]
        raw = found.astype("<u4").tobytes()
        at = (4 * np.searchsorted(row, np.arange(len(words) + 1))).tolist()
        out = [raw[a:b] for a, b in zip(at[:-1], at[1:])]
        for i in np.unique(row[found < 0]).tolist():
            out[i] = self._ids(words[i], self._cuts(words[i], int(mask[i])))
        return out

    @staticmethod
    def _cuts(word: str, mask: int) -> list[int]:
        return [*(p for p in range(len(word)) if mask >> p & 1), len(word)]

    def _long_arcs(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """End, length and score of the arcs of words of any length, by end and length, in blocks;
        ends count the characters of the words before."""
        step = self.window - self.width + 1
        size = np.array([len(w) for w in words])
        base = np.cumsum(size) - size
        rows = 1 + np.maximum(0, -(-(size - self.window) // step))
        word = np.repeat(np.arange(len(words)), rows)
        begin = step * (np.arange(len(word)) - np.repeat(np.cumsum(rows) - rows, rows))
        points = np.concatenate([_points("".join(words)), np.zeros(self.window, np.uint32)])
        for lo in range(0, len(word), 1024):
            own, at = word[lo:lo + 1024], begin[lo:lo + 1024]
            start = base[own] + at
            arcs, _ = self._arcs(points[start[None, :] + np.arange(self.window)[:, None]],
                                 np.minimum(size[own] - at, self.window))
            arcs = np.ascontiguousarray(arcs.transpose(2, 1, 0))
            there = np.isfinite(arcs)
            there[at > 0, :self.width] = False              # those ends are the row's before
            row, end, k = np.nonzero(there)
            yield start[row] + end, k + 1, arcs[row, end, k]

    def apart(self, words: list[str]) -> list[list[str]]:
        """The words, each cut wherever no piece lies across."""
        text = "".join(words)
        across = np.zeros(len(text) + 1, np.int64)
        for end, k, _ in self._long_arcs(words):
            wide = k > 1
            lo, hi = max(int(end[0]) - self.width, 0), int(end[-1]) + 1
            across[lo:hi] += np.bincount((end - k + 1)[wide] - lo, minlength=hi - lo)
            across[lo:hi] -= np.bincount(end[wide] - lo, minlength=hi - lo)
        cuts = np.flatnonzero(np.cumsum(across) == 0).tolist()       # holds every word's both ends
        parts = [text[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        at = np.searchsorted(cuts, np.cumsum([0, *map(len, words)])).tolist()
        return [parts[a:b] for a, b in zip(at[:-1], at[1:])]

    def search_long(self, word: str) -> list[tuple[float, bytes]]:
        """The same for one word of any length: agenda of at most N open hypotheses."""
        forward = [0.0] + [-np.inf] * len(word)
        blocks = []
        for end, k, s in self._long_arcs([word]):
            for j, size, score in zip(end.tolist(), k.tolist(), s.tolist()):
                total = forward[j - size] + score
                if total > forward[j]:
                    forward[j] = total
            blocks.append((end, k.astype(np.uint8 if self.width < 256 else np.int64), s))
        ends, sizes, scores = map(np.concatenate, zip(*blocks))
        first = np.searchsorted(ends, np.arange(len(word) + 2))
        agenda, out = [(-forward[-1], len(word), 0.0, None)], []
        while agenda and len(out) < self.n:
            agenda.sort(key=lambda a: (a[0], a[1]))
            _, j, g, tail = agenda.pop(0)
            if j == 0:
                cuts = []
                while tail:
                    cuts.append(tail[0])
                    tail = tail[1]
                out.append((g, self._ids(word, [*cuts, len(word)])))
                continue
            arcs = slice(first[j], first[j + 1])
            for size, score in zip(sizes[arcs].tolist(), scores[arcs].tolist()):
                i = j - size
                agenda.append((-(forward[i] + g + score), i, g + score, (i, tail)))
            agenda = heapq.nsmallest(self.n - len(out), agenda, key=lambda a: (a[0], a[1]))
        return out

    def _ids(self, word: str, cuts: list[int]) -> bytes:
        """Little-endian unsigned 32-bit ids of the pieces between the cuts."""
        ids: list[int] = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            i = self.ids.get(word[a:b])
            if i is None:
                ids.extend(self.byte_id[x] for x in word[a:b].encode())
            else:
                ids.append(i)
        return np.array(ids, "<u4").tobytes()

    # texts

    def _learn(self, words: list[str]) -> None:
        """Put new words into the cache."""
        base = len(self.words)
        need = base + len(words)
        if need > len(self.best):
            grow = max(need, 2 * len(self.best)) - len(self.best)
            self.best = np.concatenate([self.best, np.zeros(grow)])
            self.gap = np.concatenate([self.gap, np.zeros(grow)])
            self.searched = np.concatenate([self.searched, np.zeros(grow, bool)])
            self.loss = np.concatenate([self.loss, np.full((grow, self.n - 1), np.inf)])
            self.masks = np.concatenate([self.masks, np.zeros((grow, self.n), np.uint64)])
        words = sorted(words, key=len)
        self.index.update(zip(words, range(base, need)))
        self.words.extend(words)
        short = [w for w in words if len(w) <= LONGEST]
        for lo in range(0, len(short), BLOCK):
            part = short[lo:lo + BLOCK]
            at = slice(base + lo, base + lo + len(part))
            self.best[at], self.masks[at, 0], self.gap[at], ids = self.best_two(part)
            self.first.extend(ids)
        self.searched[base:need] = False
        for k in range(base + len(short), need):
            found = self.search_long(self.words[k])
            self.best[k] = found[0][0]
            self.loss[k] = np.inf
            self.loss[k, :len(found) - 1] = [found[0][0] - x for x, _ in found[1:]]
            self.gap[k] = self.loss[k, 0] if self.n > 1 else np.inf
            self.searched[k] = True
            self.first.append(found[0][1])
            self.long_paths[k] = [ids for _, ids in found]
        self._complete(base + np.flatnonzero(self.gap[base:need] < NEAR))
        self.kept = base + len(short)
        self.size += sum(WORD_BYTES + 2 * len(w) + len(ids)
                         for w, ids in zip(short, self.first[base:self.kept]))

    def _complete(self, places: np.ndarray) -> None:
        """Search the N best of these words of the cache."""
        places = places[~self.searched[places]]
        places = places[np.argsort([len(self.words[k]) for k in places.tolist()], kind="stable")]
        for lo in range(0, len(places), BLOCK):
            at = places[lo:lo + BLOCK]
            scores, self.masks[at], ids = self.search([self.words[k] for k in at.tolist()])
            self.best[at] = scores[:, 0]
            self.loss[at] = scores[:, :1] - scores[:, 1:]
            for k, own in zip(at.tolist(), ids):
                self.size += len(own) - len(self.first[k]) if k < self.kept else 0
                self.first[k] = own
        self.searched[places] = True

    def _drop_long(self) -> None:
        for w in self.words[self.kept:]:
            del self.index[w]
        del self.words[self.kept:], self.first[self.kept:]
        self.long_paths.clear()

    def _path(self, k: int, alternative: int) -> bytes:
        if k in self.long_paths:
            return self.long_paths[k][alternative]
        return self._ids(self.words[k], self._cuts(self.words[k], int(self.masks[k, alternative])))

    def segment(self, texts: list[str | None]) -> Iterator[list[tuple[float, bytes]]]:
        """The N best (score, ids) of each text, best first."""
        if self.size > self.cache_bytes:
            self._forget(len(self.best))
        split = [_SPLIT.findall(" " + t) if t else [] for t in texts]
        long = list({w for words in split for w in words if len(w) > LONGEST})
        if long:
            parts = dict(zip(long, self.apart(long)))
            split = [[part for w in words for part in parts.get(w, (w,))] for words in split]
        self._learn(list(set().union(*split).difference(self.index)))
        try:
            places = [np.fromiter(map(self.index.__getitem__, words), np.int64, len(words)) for words in split]
            close = [self._closest(at) for at in places]
            if places:
                self._complete(np.unique(np.concatenate([at[own] for at, own in zip(places, close)])))
            yield from map(self._text, places, close)
        finally:
            self._drop_long()

    def _closest(self, at: np.ndarray) -> np.ndarray:
        """The words of a text, by place, among which are the N - 1 with the smallest first losses."""
        if self.n == 1:
            return np.zeros(0, np.int64)
        gap = self.gap[at]
        most = np.partition(gap, self.n - 2)[self.n - 2] + NEAR if len(gap) >= self.n else np.inf
        return np.flatnonzero((gap <= most) & (gap < np.inf))

    def _text(self, at: np.ndarray, close: np.ndarray) -> list[tuple[float, bytes]]:
        """The N best of a text of known words, of which those in ``close`` are searched."""
        if not len(at):
            return [(0.0, b"")]
        total = float(self.best[at].sum())
        best = [self.first[k] for k in at.tolist()]
        cheapest = self._cheapest(self.loss[at[close]])
        other = sorted({word for _, choice in cheapest for word, _ in choice})
        cuts = [0, *(c for word in other for c in (int(close[word]), int(close[word]) + 1)), len(best)]
        parts = [b"".join(best[a:b]) for a, b in pairwise(cuts)]
        out = []
        for lost, choice in cheapest:
            ids = parts.copy()
            for word, k in choice:
                ids[2 * other.index(word) + 1] = self._path(int(at[close[word]]), k)
            out.append((total - lost, b"".join(ids)))
        return out

    def _cheapest(self, loss: np.ndarray) -> list[tuple[float, tuple]]:
        """The N smallest sums of losses, each with its choices (word, alternative). Only the
        N - 1 words with the smallest first losses can be in one of them."""
        n = self.n
        if n == 1:
            return [(0.0, ())]
        order = np.argsort(loss[:, 0], kind="stable")[:n - 1]
        sums: list[tuple[float, tuple]] = [(0.0, ())]
        for word in sorted(order.tolist()):
            ways = [(0.0, None)] + [(x, k + 1) for k, x in enumerate(loss[word].tolist()) if x < np.inf]
            more = [(total + x, chosen + (((word, k),) if k else ())) for total, chosen in sums for x, k in ways]
            sums = heapq.nsmallest(n, more, key=lambda s: (s[0], s[1]))
        return sums

    def decode(self, ids: bytes) -> str:
        """The text of a segmentation."""
        text = b"".join(self.raw[np.frombuffer(ids, "<u4")].tolist()).decode()
        return text[1:]


def _points(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le"), "<u4")


def _columns(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of the words, a word per column, and the words' sizes."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    points = np.zeros((len(words), int(size.max())), np.uint32)
    points[np.arange(points.shape[1])[None, :] < size[:, None]] = _points("".join(words))
    return np.ascontiguousarray(points.T), size


def _sieved(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SIEVE_BITS)).view(np.int64)


_lattices: dict[tuple, PieceLattice] = {}


def lattice(path: str, n: int) -> PieceLattice:
    """One lattice per Python worker, model and N."""
    if (path, n) not in _lattices:
        _lattices[path, n] = PieceLattice(path, n)
    return _lattices[path, n]


def segmentations(docs: DataFrame, path: str | None = None, n: int = N_BEST, with_ids: bool = True) -> DataFrame:
    """doc_id, n_pieces (of the best), scores and ids_crc32 of the N best, whether the best
    decodes to the text, and (when asked for) the ids of the N best."""
    path = path or vocabulary_path(MODEL)
    schema = "doc_id long, n_pieces long, scores array<double>, ids_crc32 array<long>, round_trip boolean"
    schema += ", ids array<array<int>>" if with_ids else ""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = lattice(path, n)
        _, offs = T.text_bytes(batch.column(1))
        for lo, hi in T.chunks(offs):
            texts = batch.column(1).slice(lo, hi - lo).to_pylist()
            found = list(pieces.segment(texts))
            columns = [batch.column(0).slice(lo, hi - lo), pa.array([len(f[0][1]) // 4 for f in found], pa.int64()),
                       pa.array([[s for s, _ in f] for f in found], pa.list_(pa.float64())),
                       pa.array([[zlib.crc32(ids) for _, ids in f] for f in found], pa.list_(pa.int64())),
                       pa.array([pieces.decode(f[0][1]) == (t or "") for f, t in zip(found, texts)])]
            names = ["doc_id", "n_pieces", "scores", "ids_crc32", "round_trip"]
            if with_ids:
                columns.append(pa.array([[np.frombuffer(ids, "<i4") for _, ids in f] for f in found],
                                        pa.list_(pa.list_(pa.int32()))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(texts_of(docs), run, schema)


def decoded(segmented: DataFrame, path: str | None = None, n: int = N_BEST) -> DataFrame:
    """doc_id and the texts of the N best of ``segmentations(..., with_ids=True)``."""
    path = path or vocabulary_path(MODEL)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = lattice(path, n)
        texts = [[pieces.decode(np.array(ids, "<u4").tobytes()) for ids in row] for row in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.list_(pa.string()))], names=["doc_id", "texts"])

    return map_batches(segmented.select("doc_id", "ids"), run, "doc_id long, texts array<string>")


def op5_n_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentations(table(spark, sf_dir, "documents"), with_ids=False)
