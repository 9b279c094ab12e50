"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is the logistic of its hashed
words' weights, a document's the noisy-or of its sentences: 1 - prod(1 - p). The
weights are fitted to document labels only, and the sentence scores then say where
the offence is.

Training rows are a bounded sample of labelled rows: about ``PER_CLASS`` of each label,
picked by a hash of doc_id among rows whose crc32(doc_id) mod 5 is not 0. Texts of every
length are drawn: one of n > ``TRAIN_CHARS`` characters at ``TRAIN_CHARS`` / n of the rate, so
a drawn row costs at most ``TRAIN_CHARS`` characters on average; each row is weighted by
the inverse of its rate.
Scoring reads every whole text in one narrow pass.

Defined results: a null or empty text has no sentence and scores 0; a text without
sentence marks is one sentence; a null doc_id is scored, never trained on and not
held out; repeated rows are scored alike; without labels of both kinds every score is
the noisy-or of an untrained model (its bias); an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.llm import textops as T
from barspark.llm.common import map_batches, table, texts_of

BITS = 18
PREFIX = 4
PER_CLASS = 2000
TRAIN_CHARS = 20_000
EPOCHS = 150
RATE = 0.15
DECAY = 1e-6
BIAS = -8.0
STRICTNESS = 0.8
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


def sentence_words(data: np.ndarray, offs: np.ndarray, bits: int = BITS):
    """(features: the sentence's words and their first ``PREFIX`` bytes, hashed; the sentence
    of each; sentence starts and ends in bytes; index of the first sentence of each text
    and the total). Features come in text order within each of the two kinds."""
    s_start, s_end = T.spans(~_STOP[data], offs)
    w_start, w_end = T.spans(_WORD[data], offs)
    longer = w_end - w_start > PREFIX
    words = T.span_hashes(data, w_start, w_end, lower=True)
    heads = T.mix(T.span_hashes(data, w_start[longer], w_start[longer] + PREFIX, lower=True) + np.uint64(5))
    sentence = np.searchsorted(s_start, w_start, "right") - 1
    feature = (np.concatenate([words, heads]) >> np.uint64(64 - bits)).astype(np.int64)
    return (feature, np.concatenate([sentence, sentence[longer]]), s_start, s_end, np.searchsorted(s_start, offs))


def sentence_scores(feature: np.ndarray, sentence: np.ndarray, n: int, weights: np.ndarray, bias: float) -> np.ndarray:
    return bias + np.bincount(sentence, weights[feature], minlength=n)


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def noisy_or(logits: np.ndarray, first: np.ndarray) -> np.ndarray:
    """1 - prod(1 - p) per text from its sentences' logits; 0 without a sentence."""
    total = np.concatenate([[0.0], np.cumsum(_softplus(logits))])
    return -np.expm1(-(total[first[1:]] - total[first[:-1]]))


def _informative(pair_bag: np.ndarray, pair_feature: np.ndarray, label: np.ndarray, bits: int) -> np.ndarray:
    """Features commoner in toxic bags by a likelihood-ratio test (G), the threshold growing
    with the number of features tested: a mask over the hash space."""
    n = 1 << bits
    seen = np.bincount(pair_feature, minlength=n).astype(float)
    hit = np.bincount(pair_feature, label[pair_bag] == 1, minlength=n)
    n1, n0 = float((label == 1).sum()), float((label == 0).sum())
    share = seen / (n1 + n0)

    def term(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-9) / np.maximum(b, 1e-9)), 0.0)

    g = 2 * (term(hit, share * n1) + term(seen - hit, share * n0)
             + term(n1 - hit, (1 - share) * n1) + term(n0 - seen + hit, (1 - share) * n0))
    return (g > STRICTNESS * 2 * np.log(max(2, int((seen > 0).sum())))) & (hit / n1 > (seen - hit) / n0)


def fit(feature: np.ndarray, sentence: np.ndarray, bag: np.ndarray, label: np.ndarray, weight: np.ndarray,
        bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the noisy-or likelihood of the bags, over the informative features.
    ``sentence`` numbers the sentences of all bags, ``bag`` gives each sentence's document."""
    out, bias = np.zeros(1 << bits), BIAS
    if not len(feature) or len(np.unique(label)) < 2:
        return out, bias
    pair = np.unique((bag[sentence] << bits) + feature)
    use = _informative(pair >> bits, pair & ((1 << bits) - 1), label, bits)[feature]
    key = np.unique((sentence[use] << bits) + feature[use])
    sentence, feature = key >> bits, key & ((1 << bits) - 1)
    ids, place = np.unique(feature, return_inverse=True)
    if not len(ids):
        return out, bias
    theta = np.zeros(len(ids) + 1)
    theta[-1] = bias
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    weight = weight / weight.sum()
    for t in range(1, epochs + 1):
        logits = theta[-1] + np.bincount(sentence, theta[:-1][place], minlength=len(bag))
        stay = np.bincount(bag, _softplus(logits), minlength=len(label))      # -log prod(1 - p)
        p = 1 / (1 + np.exp(-np.clip(logits, -50, 50)))
        pull = np.where(label > 0, -1 / np.maximum(np.expm1(np.minimum(stay, 50)), 1e-9), 1.0) * weight
        g_sentence = pull[bag] * p
        grad = np.append(np.bincount(place, g_sentence[sentence], minlength=len(ids)), g_sentence.sum())
        grad[:-1] += DECAY * theta[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        theta -= RATE * (1.02 - t / epochs) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    out[ids] = theta[:-1]
    return out, float(theta[-1])


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def length_share(text: F.Column, chars: int = TRAIN_CHARS) -> F.Column:
    """Share of its rate at which a text is drawn: 1 up to ``chars`` characters, then falling
    with its length."""
    return F.least(F.lit(1.0), chars / F.greatest(F.coalesce(F.length(text), F.lit(1)), F.lit(1)))


def training_rows(labels: DataFrame, per_class: int = PER_CLASS) -> tuple[DataFrame, dict[int, float]]:
    """Sampled (doc_id, toxic, u, rate) outside the held-out rows, and the sampling rate per
    class; ``u`` is below ``rate``."""
    one = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out())
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    count = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = {k: min(1.0, per_class / n) for k, n in count.items()}
    u = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    own = F.when(F.col("toxic") == 1, rate.get(1, 0.0)).otherwise(rate.get(0, 0.0))
    return one.select("doc_id", "toxic", u.alias("u"), own.alias("rate")).filter("u < rate"), rate


def train(docs: DataFrame, labels: DataFrame, bits: int = BITS, per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """Weights and bias from the sampled rows. The sample's doc_ids are bounded by
    ``per_class``, so they are broadcast; its word features are what the driver gets. A doc_id
    is one bag, however many rows it has: the row whose text has the smallest hash."""
    rows, rate = training_rows(labels, per_class)
    one = F.min_by(F.struct("toxic", "text", "share"), F.struct(F.xxhash64("text"), F.col("text")))
    bags = (texts_of(docs).join(F.broadcast(rows), "doc_id").withColumn("share", length_share(F.col("text")))
            .filter("u < rate * share").groupBy("doc_id").agg(one.alias("bag")).select("bag.*"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offs = T.text_bytes(batch.column(1))
        feature, sentence, _, _, first = sentence_words(data, offs, bits)
        order = np.argsort(sentence, kind="stable")
        feature, sentence = feature[order], sentence[order]
        cut = np.searchsorted(sentence, first)
        rows = [[feature[a:b].astype("<i4").tobytes(), (sentence[a:b] - s).astype("<i4").tobytes(), int(e - s)]
                for a, b, s, e in zip(cut[:-1], cut[1:], first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()),
             pa.array([r[2] for r in rows], pa.int32()), batch.column(2)], names=["toxic", "f", "s", "n", "share"])

    got = map_batches(bags, run, "toxic int, f binary, s binary, n int, share double").collect()
    got = sorted((r["toxic"], bytes(r["f"]), bytes(r["s"]), r["n"], r["share"]) for r in got if r["n"])
    label = np.array([r[0] for r in got])
    size = np.array([r[3] for r in got], np.int64)
    base = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    feature = np.frombuffer(b"".join(r[1] for r in got), "<i4").astype(np.int64)
    sentence = np.concatenate([np.frombuffer(r[2], "<i4") + b for r, b in zip(got, base)] or [np.zeros(0, np.int64)])
    weight = np.array([1 / (rate.get(r[0], 1.0) * r[4]) for r in got])
    return fit(feature, sentence.astype(np.int64), np.repeat(np.arange(len(got)), size), label, weight, bits)


def score(docs: DataFrame, model: tuple[np.ndarray, float], bits: int = BITS) -> DataFrame:
    """doc_id, score, n_sentences, n_offending (sentences at 0.5 or more) and, of the worst
    sentence, its place in characters. The model is ``2**bits`` weights, whatever the data."""
    weights, bias = model[0].astype(np.float32), model[1]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offs = T.text_bytes(batch.column(1))
        for lo, hi in T.chunks(offs):
            d, o = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            feature, sentence, s_start, s_end, first = sentence_words(d, o, bits)
            logits = sentence_scores(feature, sentence, len(s_start), weights, bias)
            points = np.concatenate([[0], np.cumsum((d & 0xC0) != 0x80)])
            bad = np.concatenate([[0], np.cumsum(logits >= 0)])
            worst = [a + int(np.argmax(logits[a:b])) if b > a else -1 for a, b in zip(first[:-1], first[1:])]
            at = [int(points[s_start[w]] - points[x]) if w >= 0 else None for w, x in zip(worst, o[:-1])]
            size = [int(points[s_end[w]] - points[s_start[w]]) if w >= 0 else None for w in worst]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(noisy_or(logits, first)), pa.array(np.diff(first)),
                 pa.array(bad[first[1:]] - bad[first[:-1]]), pa.array(at, pa.int64()), pa.array(size, pa.int64())],
                names=["doc_id", "score", "n_sentences", "n_offending", "worst_start", "worst_chars"])

    return map_batches(texts_of(docs), run, "doc_id long, score double, n_sentences long, n_offending long, "
                                            "worst_start long, worst_chars long")


def op6_multiple_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return (score(docs, model)
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"),
                    "n_sentences", "n_offending", "worst_start", "worst_chars"))
