"""Quality classifier from weak labels.

1. Heuristic labellers vote good (1), bad (-1) or abstain (0) on each whole text.
2. Their votes overlap; expectation-maximisation over the counts of vote patterns
   (at most 3**11 of them, whatever the data) estimates each labeller's accuracy, hence
   a posterior of good text per pattern.
3. The posteriors label a bounded sample (about ``PER_CLASS`` rows of either side, of every
   length, a text of n > ``TRAIN_CHARS`` characters at ``TRAIN_CHARS`` / n of the rate; picked
   by a hash of the row and weighted back), on which a hashed linear scorer is fitted; it
   scores every whole text.

All passes are narrow scans; only the pattern counts and the sample reach the driver.

Defined results: a null or empty text has no words, is voted bad and scored like any
text; very long texts are scored whole; repeated rows count and are scored one by one;
null ids and clashing extra columns are carried along; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.llm import textops as T
from barspark.llm.common import map_batches, row_of, row_schema, table, text_of
from barspark.llm.rules import text_counts
from barspark.llm.toxicity import length_share

BITS = 16
PER_CLASS = 1500
TRAIN_CHARS = 20_000
ROUNDS = 200
EPOCHS = 100
RATE = 0.05
DECAY = 1e-5
THRESHOLD = 0.5
CLASS_PRIOR = 0.5
ACCURACY_PRIOR = 0.9
LABELLERS = ("symbols", "tails", "repeats", "capitals", "lines", "variety", "bars", "shouting", "word_length", "plain", "prose")
_UPPER, _LOWER, _BAR, _BANG, _STOP = (np.zeros(256, np.uint8) for _ in range(5))
_UPPER[65:91] = 1
_LOWER[97:123] = 1
_BAR[ord("|")] = 1
_BANG[ord("!")] = 1
_STOP[[ord("."), ord("?"), ord("!")]] = 1
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!#$%&*<>=~^@|"]] = True
# classes of bytes for word shapes: capital, small, digit, beyond ASCII, else the byte itself
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = ord("A"), ord("a"), ord("0"), ord("a")


def measures(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The ratios the labellers judge, for every text of a byte buffer."""
    c = text_counts(data, offs)
    n = np.maximum(c["n_words"], 1)
    chars = np.maximum(c["word_chars"], 1)

    def total(tab: np.ndarray) -> np.ndarray:
        s = np.concatenate([[0], np.cumsum(tab[data], dtype=np.int64)])
        return s[offs[1:]] - s[offs[:-1]]

    starts, ends, first = T.word_spans(data, offs)
    words = T.span_hashes(data, starts, ends, lower=True)
    distinct = np.array([len(np.unique(words[a:b])) for a, b in zip(first[:-1], first[1:])], np.int64)
    lines = np.concatenate([[0], np.cumsum(data == 0x0A)])
    lines = lines[offs[1:]] - lines[offs[:-1]] + 1
    last = np.maximum(ends - 1, 0)
    tail = (ends - starts > 1) & (data[last] == data[np.maximum(last - 1, 0)]) & _MARK[data[last]]
    tails = np.concatenate([[0], np.cumsum(tail)])
    upper, lower = total(_UPPER), total(_LOWER)
    return {"n_words": c["n_words"], "symbols": c["n_symbols"] / chars, "repeats": c["n_repeat_words"] / n,
            "capitals": upper / np.maximum(upper + lower, 1), "lines": c["n_dup_lines"] / lines, "n_lines": lines,
            "variety": distinct / n, "bars": total(_BAR) / n, "word_length": c["word_chars"] / n,
            "shouting": total(_BANG) / n, "stops": total(_STOP) / n,
            "tails": (tails[first[1:]] - tails[first[:-1]]) / n}


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, labellers) of -1, 0, 1. Most labellers know one kind of junk and abstain
    elsewhere; ``lines`` votes either way, ``plain`` and ``prose`` know good text."""
    some = m["n_words"] > 0

    def vote(bad: np.ndarray, good: np.ndarray | bool = False) -> np.ndarray:
        return np.where(bad, -1, np.where(some & good, 1, 0))

    calm = (m["capitals"] < 0.2) & (m["shouting"] < 0.05) & (m["bars"] < 0.02) & (m["symbols"] < 0.03)
    return np.stack([
        vote(m["symbols"] > 0.05),
        vote(m["tails"] > 0.2),
        vote(m["repeats"] > 0.4),
        vote(m["capitals"] > 0.4),
        vote(m["lines"] > 0.3, (m["lines"] == 0) & (m["n_lines"] > 2) & calm),
        vote((m["variety"] < 0.15) & (m["n_words"] >= 20) & (m["n_words"] < 2000)),
        vote(m["bars"] > 0.2),
        vote(m["shouting"] > 0.3),
        vote((m["word_length"] < 2.0) | (m["word_length"] > 20)),
        vote(np.zeros_like(some), calm & (m["symbols"] < 0.01) & (m["repeats"] < 0.2)),
        vote(np.zeros_like(some), calm & (m["stops"] > 0.01) & (m["stops"] < 0.6)
             & (m["variety"] > 0.25))], axis=1)


def pattern(v: np.ndarray) -> np.ndarray:
    return ((v + 1) * 3 ** np.arange(v.shape[1])).sum(axis=1)


def patterns_to_votes(codes: np.ndarray, labellers: int) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(labellers) % 3 - 1


def expectation_maximisation(v: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of good per pattern, accuracy per labeller).

    An abstention says nothing. A cast vote is right with the labeller's accuracy, the
    classes have a fixed even prior, and the accuracy has a beta prior around
    ``ACCURACY_PRIOR`` worth a tenth of the labeller's votes (and ten more): where votes
    overlap, agreement and conflict move it."""
    n = np.abs(v).T @ count
    accuracy = np.full(v.shape[1], ACCURACY_PRIOR)
    weight = 0.1 * n + 10
    q = np.full(len(v), CLASS_PRIOR)
    for _ in range(rounds):
        odds = np.log(accuracy / (1 - accuracy))
        q = 1 / (1 + np.exp(-(np.log(CLASS_PRIOR / (1 - CLASS_PRIOR)) + v @ odds)))
        right = (np.where(v == 1, q[:, None], np.where(v == -1, 1 - q[:, None], 0.0))).T @ count
        new = np.clip((right + ACCURACY_PRIOR * weight) / (n + weight), 0.05, 0.99)
        done = np.abs(new - accuracy).max(initial=0) < 1e-9
        accuracy = new
        if done:
            break
    return q, accuracy


def features(data: np.ndarray, offs: np.ndarray, m: dict[str, np.ndarray], bits: int = BITS):
    """(row, feature, value): words and word shapes by relative frequency, and one step
    feature per measure, all hashed into one space."""
    starts, ends, first = T.word_spans(data, offs)
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    shape = _SHAPE[data]
    change = np.ones(len(data), bool)
    change[1:] = shape[1:] != shape[:-1]
    change[starts] = True
    place = np.concatenate([[0], np.cumsum(change)])
    shapes = T.span_hashes(shape[change], place[starts], place[ends - 1] + change[ends - 1]) if len(starts) else np.zeros(0, np.uint64)
    words = T.span_hashes(data, starts, ends, lower=True)
    share = 1.0 / np.maximum(n, 1)[row]
    rows, hashes, values = [row, row], [words, T.mix(shapes + np.uint64(77))], [share, share * 4]
    for k, name in enumerate(("symbols", "tails", "repeats", "capitals", "lines", "variety", "shouting", "bars")):
        step = np.minimum(np.floor(m[name] * 10), 10).astype(np.uint64)
        rows.append(np.arange(len(n)))
        hashes.append(T.mix(step + np.uint64(1000 * (k + 1))))
        values.append(np.ones(len(n)))
    size = np.minimum(np.log2(m["n_words"] + 1).astype(np.uint64), 12)
    rows.append(np.arange(len(n)))
    hashes.append(T.mix(size + np.uint64(99_000)))
    values.append(np.ones(len(n)))
    h = np.concatenate(hashes)
    return np.concatenate(rows), (h >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(values)


def fit(row: np.ndarray, feature: np.ndarray, value: np.ndarray, target: np.ndarray, weight: np.ndarray,
        bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, full-batch Adam."""
    out = np.zeros(1 << bits)
    if not len(target):
        return out, 0.0
    ids, place = np.unique(feature, return_inverse=True)
    theta = np.zeros(len(ids) + 1)
    mean, var = np.zeros_like(theta), np.zeros_like(theta)
    weight = weight / weight.sum()
    for t in range(1, epochs + 1):
        z = theta[-1] + np.bincount(row, value * theta[:-1][place], minlength=len(target))
        g = (1 / (1 + np.exp(-z)) - target) * weight
        grad = np.append(np.bincount(place, value * g[row], minlength=len(ids)) + DECAY * theta[:-1], g.sum())
        mean = 0.9 * mean + 0.1 * grad
        var = 0.99 * var + 0.01 * grad * grad
        theta -= RATE * (mean / (1 - 0.9**t)) / (np.sqrt(var / (1 - 0.99**t)) + 1e-8)
    out[ids] = theta[:-1]
    return out, float(theta[-1])


def vote_counts(docs: DataFrame) -> DataFrame:
    """Rows per vote pattern (pre-aggregated in each task)."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offs = T.text_bytes(batch.column(0))
        for lo, hi in T.chunks(offs):
            codes, n = np.unique(pattern(votes(measures(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]))),
                                 return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))],
                                             names=["pattern", "n"])
    return (map_batches(docs.select(F.col("text").cast("string").alias("text")), run, "pattern long, n long")
            .groupBy("pattern").agg(F.sum("n").alias("n")))


class WeakModel:
    """Labeller model and scorer; its size does not depend on the data."""

    def __init__(self, posterior: dict[int, float], accuracies: np.ndarray, weights: np.ndarray, bias: float, bits: int):
        self.posterior, self.accuracies, self.weights, self.bias, self.bits = posterior, accuracies, weights, bias, bits


def train(docs: DataFrame, per_class: int = PER_CLASS, bits: int = BITS) -> WeakModel:
    got = sorted((r["pattern"], r["n"]) for r in vote_counts(docs).collect())
    codes, count = np.array([g[0] for g in got], np.int64), np.array([g[1] for g in got], float)
    if not len(codes):
        return WeakModel({}, np.full(len(LABELLERS), ACCURACY_PRIOR), np.zeros(1 << bits), 0.0, bits)
    q, accuracy = expectation_maximisation(patterns_to_votes(codes, len(LABELLERS)), count)
    posterior = dict(zip(codes.tolist(), q.tolist()))
    total = [max(1.0, float(count[(q >= 0.5) == side].sum())) for side in (False, True)]
    rate = [min(1.0, per_class / t) for t in total]
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(1 << 30)) / float(1 << 30)
    text = F.col("text").cast("string")
    some = (docs.select(u.alias("u"), text.alias("text"), length_share(text, TRAIN_CHARS).alias("share"))
            .filter(F.col("u") < max(rate) * F.col("share")))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        draw, share = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
        data, offs = T.text_bytes(batch.column(1))
        for lo, hi in T.chunks(offs):
            d, o = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            m = measures(d, o)
            p = np.array([posterior.get(int(c), 0.5) for c in pattern(votes(m))])
            row, feature, value = features(d, o, m, bits)
            order = np.argsort(row, kind="stable")
            cut = np.searchsorted(row[order], np.arange(hi - lo + 1))
            pick = [i for i in range(hi - lo) if draw[lo + i] < rate[int(p[i] >= 0.5)] * share[lo + i]]
            sides = [order[cut[i]:cut[i + 1]] for i in pick]
            yield pa.RecordBatch.from_arrays(
                [pa.array(p[pick], pa.float64()), pa.array(share[lo:hi][pick], pa.float64()),
                 pa.array([feature[s].astype("<i4").tobytes() for s in sides], pa.binary()),
                 pa.array([value[s].astype("<f4").tobytes() for s in sides], pa.binary())], names=["p", "share", "f", "v"])

    # equal rows are all drawn or none: they reach the driver as one, with their number as weight
    drawn = (map_batches(some, run, "p double, share double, f binary, v binary")
             .groupBy("p", "share", "f", "v").agg(F.count(F.lit(1)).alias("n")))
    rows = sorted((r["p"], bytes(r["f"]), bytes(r["v"]), r["share"], r["n"]) for r in drawn.collect())
    target, share, times = (np.array([r[k] for r in rows]) for k in (0, 3, 4))
    size = [len(r[1]) // 4 for r in rows]
    weights, bias = fit(np.repeat(np.arange(len(rows)), size),
                        np.frombuffer(b"".join(r[1] for r in rows), "<i4").astype(np.int64),
                        np.frombuffer(b"".join(r[2] for r in rows), "<f4").astype(float), target,
                        np.where(target >= 0.5, 1 / rate[1], 1 / rate[0]) * times / share, bits)
    return WeakModel(posterior, accuracy, weights, bias, bits)


def score(docs: DataFrame, model: WeakModel, keep: list[str]) -> DataFrame:
    """``row`` (the ``keep`` columns of ``docs``) and pattern, posterior, score of its text."""
    posterior, weights, bias, bits = model.posterior, model.weights.astype(np.float32), model.bias, model.bits
    slim = docs.select(row_of(docs, keep), *([] if "text" in keep else [F.col("text")]))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offs = T.text_bytes(text_of(batch))
        for lo, hi in T.chunks(offs):
            d, o = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            m = measures(d, o)
            codes = pattern(votes(m))
            row, feature, value = features(d, o, m, bits)
            z = bias + np.bincount(row, value * weights[feature], minlength=hi - lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(codes.astype(np.int64)), pa.array([posterior.get(int(c), 0.5) for c in codes], pa.float64()),
                   pa.array(1 / (1 + np.exp(-z)))], names=["row", "pattern", "posterior", "score"])

    return map_batches(slim, run, row_schema(docs, keep, "pattern long, posterior double, score double"))


def classified(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the scorer accepts, all columns as they are."""
    return score(docs, train(docs), docs.columns).filter(F.col("score") >= threshold).select("row.*")


def op2_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    s = score(docs, train(docs), ["doc_id"])
    return s.select("row.doc_id", F.col("pattern").alias("vote_pattern"), "posterior", "score",
                    (F.col("score") >= THRESHOLD).alias("kept"))
