"""Packing by power-of-two decomposition.

A document's ids (with the end id) are cut into pieces whose lengths are the binary
digits of its token count, longest first: whole sequences of ``seq_len``, then one
piece per set bit of the rest. Each piece is a sequence of its own and pieces of one
length form a bucket, so batches of a bucket need no padding and no sequence holds
two documents. The plan is one narrow pass: scan, encode, cut, number.

Defined results: a null or empty text is the end id alone; very long texts are cut
like all others; repeated rows give repeated pieces with sequence ids of their own;
a null doc_id is packed under null; an empty table gives no rows.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.llm.common import map_batches, table, texts_of
from barspark.llm.encoding import encoder, vocabulary_path

SEQ_LEN = 2048
END_ID = 1


def cuts(n: int, seq_len: int) -> list[int]:
    """Piece lengths for ``n`` tokens: whole sequences, then the rest's binary digits."""
    rest = n % seq_len
    return [seq_len] * (n // seq_len) + [1 << k for k in range(seq_len.bit_length() - 2, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, path: str | None = None, seq_len: int = SEQ_LEN, end_id: int = END_ID,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, bucket (log2 of the length), ids (when
    asked for), ids_crc32, doc_tokens, sequence_id, offset.

    ``sequence_id`` is unique: the row number that Spark gives the piece, times 64, plus
    the bucket, so ``sequence_id % 64`` tells the bucket without a shuffle."""
    if seq_len < 1 or seq_len & (seq_len - 1):
        raise ValueError(f"seq_len must be a power of two, not {seq_len}")
    path = path or vocabulary_path()
    schema = "doc_id long, start long, length long, bucket int, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" if with_ids else ""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, ids, at in encoder(path).texts(batch.column(1)):
            rows, pieces = [], []
            for k in range(len(at) - 1):
                own = np.append(ids[at[k]:at[k + 1]], np.uint32(end_id)).astype("<u4")
                raw, start = own.tobytes(), 0
                for size in cuts(len(own), seq_len):
                    rows.append((lo + k, start, size, size.bit_length() - 1,
                                 zlib.crc32(raw[4 * start:4 * (start + size)]), len(own)))
                    start += size
                pieces.append(own)
            cols = [np.array(c) for c in zip(*rows)]
            arrays = [batch.column(0).take(pa.array(cols[0])), pa.array(cols[1]), pa.array(cols[2]),
                      pa.array(cols[3].astype(np.int32)), pa.array(cols[4]), pa.array(cols[5])]
            if with_ids:
                arrays.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(cols[2])]).astype(np.int32),
                                                       pa.array(np.concatenate(pieces).view("<i4"))))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return (map_batches(texts_of(docs), run, schema)
            .withColumn("sequence_id", F.monotonically_increasing_id() * 64 + F.col("bucket"))
            .withColumn("offset", F.lit(0).cast("long")))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Pieces as Parquet, one folder per bucket: a loader reads batches of equal length."""
    packed.write.mode("errorifexists").partitionBy("bucket").parquet(path)


def op10_power_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False).drop("bucket")
