"""Language-model scoring by cross-entropy difference.

Two bigram models with one vocabulary (a public tokenizer's pieces), one order and one
smoothing are matched against each other: the target model counts the target texts, the
background model all documents. A document's score is the mean over its tokens of
(target loss - background loss); lower is closer to the target.

The background's bigrams grow with the corpus, so no task holds them all:

1. Documents are encoded once, into blocks of about ``BLOCK_TOKENS`` tokens (or one longer
   document), written to the scratch folder.
2. Each block's distinct bigrams are counted; counts are summed per bigram, joined with
   the target's counts, and joined back to the blocks. A frequent bigram is one row per block.
3. Each block meets its own bigrams' counts and is scored. Unigram counts have a row per
   vocabulary entry (at most 65,536), a proven bound, and travel with the scorer.

p(w | h) = (c(h, w) + MU p(w)) / (c(h) + MU), p(w) = (c(w) + ALPHA) / (N + ALPHA V).

Defined results: a null or empty text has no tokens and null losses; texts are scored
whole; repeated rows count and are scored one by one; null ids are carried along; an empty
target leaves the target model uniform; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.llm.common import Scratch, map_batches, ship, table, texts_of
from barspark.llm.encoding import encoder, vocabulary_path

BLOCK_TOKENS = 8_000_000
MU = 50.0
ALPHA = 0.1
START = 49407           # the vocabulary's end-of-text id begins a document
SIZE = 49408


def encoded(texts: DataFrame, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, block, tokens (2-byte ids): the texts of a task in order, cut into blocks."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        block, filled = 0, 0
        for batch in batches:
            for lo, ids, at in encoder(path).texts(batch.column(1)):
                blocks = []
                for n in np.diff(at).tolist():
                    if filled and filled + n > block_tokens:
                        block, filled = block + 1, 0
                    filled += n
                    blocks.append(first + block)
                tokens = pa.Array.from_buffers(pa.binary(), len(blocks), [
                    None, pa.py_buffer((2 * at).astype(np.int32).tobytes()), pa.py_buffer(ids.astype("<u2").tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(blocks)), pa.array(blocks, pa.int64()),
                                                  tokens], names=["doc_id", "block", "tokens"])

    return texts.mapInArrow(run, "doc_id long, block long, tokens binary")


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all rows, where each row begins and the total)."""
    column = column.cast(pa.large_binary())
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw.view("<u2") if len(raw) else np.zeros(0, "<u2"), (offs - offs[0]) // 2


def _bigrams(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """history << 16 | token for every token."""
    history = np.empty(len(tokens), np.int64)
    history[1:] = tokens[:-1]
    begins = first[:-1][first[:-1] < first[1:]]
    history[begins] = START
    return history << 16 | tokens


def block_bigrams(tokens: DataFrame) -> DataFrame:
    """(block, bigram, n): distinct bigrams of each block (once per batch it spans)."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        blocks = batch.column(0).to_numpy(zero_copy_only=False)
        cut = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
        for a, b in zip(cut[:-1], cut[1:]):
            keys, n = np.unique(_bigrams(*_tokens(batch.column(1).slice(a, b - a))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), blocks[a])), pa.array(keys),
                                              pa.array(n.astype(np.int64))], names=["block", "bigram", "n"])
    return map_batches(tokens.select("block", "tokens"), run, "block long, bigram long, n long")


def unigrams(bigrams: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts as token and as history, from (bigram, n): one number per vocabulary entry."""
    out = []
    for half in (F.col("bigram").bitwiseAND(0xFFFF), F.shiftright("bigram", 16)):
        counts = np.zeros(1 << 16)
        for r in bigrams.groupBy(half.alias("id")).agg(F.sum("n").alias("n")).collect():
            counts[r["id"]] = r["n"]
        out.append(counts)
    return out[0], out[1]


def log_probability(bigram: np.ndarray, count: np.ndarray, token_counts: np.ndarray, history_counts: np.ndarray) -> np.ndarray:
    prior = (token_counts + ALPHA) / (token_counts.sum() + ALPHA * SIZE)
    history, token = bigram >> 16, bigram & 0xFFFF
    return np.log(count + MU * prior[token]) - np.log(history_counts[history] + MU)


def cross_entropy_difference(docs: DataFrame, target: DataFrame, path: str | None = None,
                             block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (nats per token), score for every row of
    ``docs`` (doc_id, text); ``target`` has a column text."""
    s = Scratch(ship(docs.sparkSession), "lm")
    path = path or vocabulary_path()
    tokens = s.save(encoded(texts_of(docs), path, block_tokens), "tokens")
    own = s.save(block_bigrams(tokens), "bigrams")
    wanted = target.select(F.lit(0).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    aim = s.save(block_bigrams(encoded(wanted, path, block_tokens)).groupBy("bigram").agg(F.sum("n").alias("t")), "target")
    counts = s.save(own.groupBy("bigram").agg(F.sum("n").alias("n")), "background")
    background, aimed = unigrams(counts), unigrams(aim.select("bigram", F.col("t").alias("n")))
    both = s.save(counts.join(aim, "bigram", "left").select("bigram", "n", F.coalesce("t", F.lit(0)).alias("t")), "both")
    known = own.select("block", "bigram").join(both, "bigram").select("block", "bigram", "n", "t")

    def score(texts: pa.Table, model: pa.Table) -> pa.Table:
        keys = model.column("bigram").to_numpy()
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        loss = [-log_probability(keys, model.column(c).to_numpy()[order].astype(float), *u)
                for c, u in (("t", aimed), ("n", background))]
        ids, n, sums = [], [], [[], []]
        for batch in texts.to_batches(max_chunksize=512):
            toks, first = _tokens(batch.column(batch.schema.get_field_index("tokens")))
            at = np.searchsorted(keys, _bigrams(toks, first))
            ids.append(batch.column(batch.schema.get_field_index("doc_id")))
            n.append(np.diff(first))
            for total, values in zip(sums, loss):
                running = np.concatenate([[0.0], np.cumsum(values[at])])
                total.append(running[first[1:]] - running[first[:-1]])
        n_all = np.concatenate(n)
        empty = n_all == 0
        mean = [pa.array(np.concatenate(x) / np.maximum(n_all, 1), mask=empty) for x in sums]
        return pa.table([pa.chunked_array(ids, pa.int64()), pa.array(n_all.astype(np.int64)), *mean],
                        names=["doc_id", "n_tokens", "target_loss", "background_loss"])

    filled = tokens.filter(F.length("tokens") > 0)
    scored = (filled.groupBy("block").cogroup(known.groupBy("block"))
              .applyInArrow(score, "doc_id long, n_tokens long, target_loss double, background_loss double"))
    none = F.lit(None).cast("double")
    blank = tokens.filter(F.length("tokens") == 0).select("doc_id", F.lit(0).cast("long").alias("n_tokens"),
                                                          none.alias("target_loss"), none.alias("background_loss"))
    return scored.union(blank).withColumn("score", F.col("target_loss") - F.col("background_loss"))


def op7_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the benchmark passages; background: all documents."""
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
