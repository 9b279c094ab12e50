"""Best-fit packing by hierarchical residual rounds.

A document's ids (with the end id) stay together up to ``seq_len``; a longer document is cut
into whole sequences, its first piece takes the rest. Pieces are packed as bins of members:

1. Every task packs the pieces it reads by best fit, largest first: a piece goes to the
   fullest bin that still takes it. Bins filled up to ``slack`` tokens are emitted.
2. Underfull bins become items. They are dealt in turn to groups of at most ``group_items``,
   and each group is packed by best fit again. Bins that are now nearly full are
   emitted, the others go on to the next round, whose groups merge several of the last one's.
3. The rounds end with a single group, or when a round joins fewer than one bin in
   ``1 / LEAST_GAIN`` (bins over half a sequence long never fit each other); what is
   left is emitted as it is. Rounds choose where a piece lies, never whether it is packed.

A bin has at most ``seq_len`` members, so an item carries its members with it and no join is
needed to find a piece's place. A task holds one group at a time; only counts reach the driver.

Defined results: a null or empty text is the end id alone; very long texts are cut like all
others; repeated rows give repeated pieces; a null doc_id is packed under null; an empty
table gives no rows.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.llm import textops as T
from barspark.llm import units as U
from barspark.llm.common import Scratch, map_batches, ship, table, texts_of
from barspark.llm.encoding import _split_marks, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
SEQ_LEN = 1024
END_ID = 2
GROUP_ITEMS = 100_000
GROUP_TOKENS = 16_000_000
SLACK = 4               # tokens a nearly full bin may lack
LEAST_GAIN = 0.01
MEMBER = "doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint"

_encoders: dict[str, U.UnitEncoder] = {}


def encoder(path: str) -> U.UnitEncoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = U.UnitEncoder(U.byte_level_encoder(path))
    return _encoders[path]


def encoded(column: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids of some rows' texts in a row, where each text begins and the total)."""
    data, offs = T.text_bytes(column)
    for lo, hi in T.chunks(offs):
        own, first = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        starts, at = U.unit_starts(own, first, U.cut_table(U.BLANKS))
        # a closing stop or comma is a token of its own: apart, fewer units are distinct
        starts, ends, at = _split_marks(own, starts, np.append(starts[1:], len(own)), at)
        flat, begin, size = encoder(path).ids(own, starts, ends)
        yield lo, U.gather(flat, begin, size), np.concatenate([[0], np.cumsum(size)])[at]


def cuts(n: int, seq_len: int) -> list[int]:
    """Piece lengths of a document of ``n`` tokens: the rest first, then whole sequences."""
    rest = n % seq_len
    return [rest] * (rest > 0) + [seq_len] * (n // seq_len)


def pieces(docs: DataFrame, path: str | None = None, seq_len: int = SEQ_LEN, end_id: int = END_ID,
           with_ids: bool = True) -> DataFrame:
    """One bin per piece: size, members (one: doc_id, piece, start, length, ids_crc32 and,
    when asked for, ids)."""
    path = path or vocabulary_path(VOCABULARY)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, ids, at in encoded(batch.column(1), path):
            rows, parts = [], []
            for k in range(len(at) - 1):
                own = np.append(ids[at[k]:at[k + 1]], np.uint32(end_id)).astype("<u4")
                raw, start = own.tobytes(), 0
                for p, size in enumerate(cuts(len(own), seq_len)):
                    rows.append((lo + k, p, start, size, zlib.crc32(raw[4 * start:4 * (start + size)])))
                    start += size
                parts.append(own)
            row, piece, start, size, crc = (np.array(c, np.int64) for c in zip(*rows))
            fields = {"doc_id": batch.column(0).take(pa.array(row)), "piece": pa.array(piece.astype(np.int32)),
                      "start": pa.array(start), "length": pa.array(size), "ids_crc32": pa.array(crc)}
            if with_ids:
                fields["ids"] = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32),
                                                         pa.array(np.concatenate(parts).view("<i4")))
            one = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
            members = pa.ListArray.from_arrays(np.arange(len(size) + 1, dtype=np.int32), one)
            yield pa.RecordBatch.from_arrays([pa.array(size.astype(np.int32)), members], names=["size", "members"])

    member = MEMBER + (",ids:array<int>" if with_ids else "")
    return map_batches(texts_of(docs), run, f"size int, members array<struct<{member}>>")


def best_fit(sizes: np.ndarray, seq_len: int) -> np.ndarray:
    """Bin of every item, largest items first, each in the fullest bin that takes it. Bins are
    kept by the room they have left; one integer's bits tell which rooms there are."""
    bin_of = np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(seq_len + 1)]
    rooms, n_bins = 0, 0
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            place = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, place, n_bins = seq_len, n_bins, n_bins + 1
        bin_of[item] = place
        left = room - size
        if left:
            by_room[left].append(place)
            rooms |= 1 << left
    return bin_of


def merged(bins: pa.Table, seq_len: int) -> pa.Table:
    """The bins of one group (size, members), packed by best fit into fewer bins."""
    sizes = bins.column("size").to_numpy().astype(np.int64)
    bin_of = best_fit(sizes, seq_len)
    order = np.lexsort((-sizes, bin_of))
    lists = bins.column("members").combine_chunks().take(pa.array(order))
    first = np.searchsorted(bin_of[order], np.arange(bin_of.max() + 1))
    inner = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    offsets = np.append(inner[first], inner[-1]).astype(np.int32)
    totals = np.bincount(bin_of, weights=sizes).astype(np.int32)
    return pa.table([pa.array(totals), pa.ListArray.from_arrays(offsets, lists.flatten())], names=["size", "members"])


def fitted(bins: DataFrame, seq_len: int, group_items: int) -> DataFrame:
    """The bins of every task, packed in groups of at most ``group_items`` (and GROUP_TOKENS,
    where the members hold their ids)."""
    ship(bins.sparkSession)
    with_ids = "ids" in bins.schema["members"].dataType.elementType.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        items = tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                out = merged(pa.Table.from_batches(held), seq_len)
                held.clear()
                yield from out.to_batches(max_chunksize=2000)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = pc.sum(batch.column(0)).as_py()
            if items + batch.num_rows > group_items or (with_ids and tokens + own > GROUP_TOKENS):
                yield from flush()
                items = tokens = 0
            held.append(batch)
            items, tokens = items + batch.num_rows, tokens + own
        yield from flush()

    return bins.mapInArrow(run, bins.schema)


def bins(docs: DataFrame, path: str | None = None, seq_len: int = SEQ_LEN, end_id: int = END_ID, with_ids: bool = True,
         group_items: int = GROUP_ITEMS, slack: int = SLACK, scratch: Scratch | None = None) -> DataFrame:
    """The packed sequences: sequence_id, size, members in order of their place."""
    s = scratch or Scratch(ship(docs.sparkSession), "bestfit")
    cut = s.save(pieces(docs, path, seq_len, end_id, with_ids), "pieces")
    done = [cut.filter(F.col("size") == seq_len)]
    left = s.save(fitted(cut.filter(F.col("size") < seq_len), seq_len, group_items), "round0")
    k, last = 0, False
    while True:
        done.append(left.filter(F.col("size") >= seq_len - slack))
        items = left.filter(F.col("size") < seq_len - slack)
        n, tokens = items.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
        if last or n <= 1:
            done.append(items)
            break
        k += 1
        groups = max(-(-n // group_items), -(-tokens // GROUP_TOKENS) if with_ids else 1)
        left = s.save(fitted(items.repartition(groups), seq_len, group_items), f"round{k}")
        last = groups == 1 or left.count() > n * (1 - LEAST_GAIN)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.withColumn("sequence_id", F.monotonically_increasing_id())


def pack(docs: DataFrame, path: str | None = None, seq_len: int = SEQ_LEN, end_id: int = END_ID, with_ids: bool = True,
         group_items: int = GROUP_ITEMS, slack: int = SLACK, scratch: Scratch | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids (when asked for),
    sequence_id, offset."""
    ends = F.aggregate(F.transform("members", lambda m: m["length"]), F.array(F.lit(0).cast("long")),
                       lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    placed = (bins(docs, path, seq_len, end_id, with_ids, group_items, slack, scratch)
              .select("sequence_id", "members", ends.alias("ends")))
    return (placed.select("sequence_id", F.posexplode("members").alias("_k", "m"), "ends")
            .select("m.*", "sequence_id", F.get("ends", F.col("_k")).alias("offset")))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
