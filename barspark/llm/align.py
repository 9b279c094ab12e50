"""Cross-tokenizer alignment by as-of joins of token starts.

Two vocabularies tile the same bytes (a space and the text). Per batch, pandas
``merge_asof`` keyed by document finds for each token's start the other side's covering
token; the union of both directions is every pair of tokens whose byte ranges overlap.
Offsets where tokens of both sides end cut a document into groups.

How often a pair of ids is linked is a count over the corpus, whose distinct pairs grow with
it, so no task holds them all:

1. Documents are aligned in blocks of about ``BLOCK_LINKS`` links (or one longer document). A
   block is written as one row: the documents' figures, the block's distinct pairs with their
   counts, and each link as a place in that list (most frequent first, compressed).
2. The counts are summed per pair and joined back to the blocks: a frequent pair is one row
   per block. The highest count per B id is one row per entry of B's vocabulary (at most
   65,536, a proven bound), which is broadcast.
3. Each block meets its own pairs' totals and is scored.

Defined results: a text that is null, empty or not given back by both vocabularies byte by
byte has no tokens (zeros, no groups); very long texts are aligned whole; repeated rows
count and are returned one by one; null ids are carried along; an empty table gives no rows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.llm import textops as T
from barspark.llm import units as U
from barspark.llm.common import Scratch, map_batches, ship, table
from barspark.llm.encoding import vocabulary_path

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_LINKS = 4_000_000
BLOCK_DOCS = 100_000
CHUNK_BYTES = 1 << 20


class Tokenizers:
    """Both vocabularies: ids of units, and every id's bytes."""

    def __init__(self, path_a: str, path_b: str):
        pieces = U.Pieces(path_b)
        self.cuts = U.cut_table(pieces.cuts)
        self.sides = []
        for entries, encode in ((U.byte_level_bytes(path_a), U.byte_level_encoder(path_a, special=False)),
                                (pieces.bytes, pieces.encode)):
            if len(entries) > 1 << 16:
                raise ValueError(f"{len(entries)} entries: at most 65,536 fit a pair's code")
            self.sides.append(_Side(entries, encode))


class _Side:
    def __init__(self, entries: list[bytes], encode):
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.encoder = U.UnitEncoder(encode)
        # an id in decimal with the character that follows it, as fixed-width bytes
        self.decimal = {c: np.array([f"{i}{c}" for i in range(len(entries))], "S6") for c in ",|;"}


_tokenizers: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """Both vocabularies, once per Python worker."""
    if (path_a, path_b) not in _tokenizers:
        _tokenizers[path_a, path_b] = Tokenizers(path_a, path_b)
    return _tokenizers[path_a, path_b]


@dataclass
class Tokens:
    """One side's tokens of some documents: ids, document, byte range (over all documents)."""

    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray   # of each document, and the total


def tokens_of(texts: pa.Array, pair: Tokenizers) -> Iterator[tuple[int, Tokens, Tokens]]:
    """(first row, A's tokens, B's tokens) of some rows' texts, each with the space before it."""
    data, offs = T.text_bytes(texts)
    for lo, hi in T.chunks(offs, CHUNK_BYTES):
        own, bounds = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        starts, at = U.unit_starts(own, bounds, pair.cuts)
        ends = np.append(starts[1:], len(own))[:len(starts)]
        doc = np.repeat(np.arange(hi - lo), np.diff(at))
        got = [side.encoder.ids(own, starts, ends) for side in pair.sides]
        # a unit that a side can't give back, and a text without any character, have no tokens
        none = np.diff(bounds) < 2
        for _, _, size in got:
            none[doc[size == 0]] = True
        keep = ~none[doc]
        out = []
        for (flat, begin, size), side in zip(got, pair.sides):
            ids = U.gather(flat, begin[keep], size[keep]).astype(np.int64)
            end = np.cumsum(side.sizes[ids])
            owner = np.repeat(doc[keep], size[keep])
            out.append(Tokens(ids, owner, end - side.sizes[ids], end, np.searchsorted(owner, np.arange(hi - lo + 1))))
        yield lo, *out


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``a``, in ``b``) of all pairs of tokens with overlapping ranges, by document."""
    left = pd.DataFrame({"doc": a.doc, "at": a.start, "i": np.arange(len(a.ids))})
    right = pd.DataFrame({"doc": b.doc, "at": b.start, "j": np.arange(len(b.ids))})
    covered = pd.merge_asof(left, right, on="at", by="doc")
    covering = pd.merge_asof(right, left, on="at", by="doc")
    # a pair with one start is found from both sides
    covering = covering[a.start[covering["i"].to_numpy(np.int64)] != covering["at"].to_numpy()]
    i = np.concatenate([covered["i"].to_numpy(np.int64), covering["i"].to_numpy(np.int64)])
    j = np.concatenate([covered["j"].to_numpy(np.int64), covering["j"].to_numpy(np.int64)])
    order = np.argsort(a.doc[i], kind="stable")
    return i[order], j[order]


def group_ends(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either side end where one of the other side does."""
    return np.isin(a.end, b.end, assume_unique=True), np.isin(b.end, a.end, assume_unique=True)


def group_texts(a: Tokens, b: Tokens, pair: Tokenizers) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every document: A's and B's ids of each group, in order."""
    if not len(a.ids):
        return [b""] * (len(a.first) - 1)
    ends = group_ends(a, b)
    group = [np.cumsum(e) - e for e in ends]
    out = np.empty(len(a.ids) + len(b.ids), "S6")
    place = (np.arange(len(a.ids)) + np.searchsorted(group[1], group[0], "left"),
             np.arange(len(b.ids)) + np.searchsorted(group[0], group[1], "right"))
    for side, tokens, end, at, last in zip(pair.sides, (a, b), ends, place, "|;"):
        out[at] = side.decimal[","][tokens.ids]
        out[at[end]] = side.decimal[last][tokens.ids[end]]
    bounds = (a.first + b.first).tolist()
    return [out[x:y].tobytes().replace(b"\0", b"")[:-1] for x, y in zip(bounds[:-1], bounds[1:])]


def _spaced(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("`text`").cast("string"), F.lit(""))
    return docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.concat(F.lit(" "), text).alias("text"))


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B)


def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, groups (``a1,a2|b1;a3|b2,b3``) and links (places of overlapping tokens) of every row."""
    paths = _paths(path_a, path_b)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(*paths)
        for lo, a, b in tokens_of(batch.column(1), pair):
            n = len(a.first) - 1
            i, j = overlaps(a, b)
            doc = a.doc[i]
            link = pa.StructArray.from_arrays([pa.array((i - a.first[doc]).astype(np.int32)),
                                               pa.array((j - b.first[doc]).astype(np.int32))], names=["a", "b"])
            offsets = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array([g.decode() for g in group_texts(a, b, pair)]),
                                              pa.ListArray.from_arrays(offsets, link)], names=["doc_id", "groups", "links"])

    return map_batches(_spaced(docs), run, "doc_id long, groups string, links array<struct<a:int,b:int>>")


_DOC = "doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string"
_PLANES = 4


def _packed(places: np.ndarray) -> bytes:
    """Small numbers as byte planes, compressed."""
    planes = places.astype("<u4").view(np.uint8).reshape(-1, _PLANES).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, decompressed_size=_PLANES * n, codec="zstd", asbytes=True), np.uint8)
    return planes.reshape(_PLANES, n).T.copy().view("<u4").ravel()


class _Block:
    """Documents and links of one block, until it is written."""

    def __init__(self):
        self.docs: list[pa.StructArray] = []
        self.codes: list[np.ndarray] = []
        self.n_docs = self.n_links = 0

    def add(self, docs: pa.StructArray, codes: np.ndarray) -> None:
        self.docs.append(docs)
        self.codes.append(codes)
        self.n_docs += len(docs)
        self.n_links += len(codes)

    def row(self, number: int) -> pa.RecordBatch:
        pairs, place, n = np.unique(np.concatenate(self.codes), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        docs = pa.concat_arrays(self.docs)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
             pa.array([pairs[order].astype("<u4").tobytes()], pa.binary()), pa.array([n[order].astype("<u4").tobytes()], pa.binary()),
             pa.array([_packed(rank[place])], pa.binary())], names=["block", "docs", "pairs", "times", "links"])


def blocks(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row per block: block, docs (figures of its documents), pairs (distinct, code = A id
    << 16 | B id, 4 bytes each), times (of each pair, 4 bytes), links (places in pairs)."""
    paths = _paths(path_a, path_b)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        pair = tokenizers(*paths)
        for batch in batches:
            for lo, a, b in tokens_of(batch.column(1), pair):
                n = len(a.first) - 1
                i, j = overlaps(a, b)
                ends, _ = group_ends(a, b)
                groups = [g and hashlib.sha256(g).hexdigest() or "" for g in group_texts(a, b, pair)]
                links = np.bincount(a.doc[i], minlength=n)
                if block.n_links and (block.n_links + len(i) > block_links or block.n_docs + n > BLOCK_DOCS):
                    yield block.row(number)
                    number, block = number + 1, _Block()
                block.add(pa.StructArray.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(np.diff(a.first)), pa.array(np.diff(b.first)),
                     pa.array(np.bincount(a.doc[ends], minlength=n)), pa.array(links), pa.array(groups, pa.string())],
                    names=[c.split(":")[0] for c in _DOC.split(",")]), (a.ids[i] << 16 | b.ids[j]).astype(np.uint32))
        if block.n_docs:
            yield block.row(number)

    return _spaced(docs).mapInArrow(run, f"block long, docs array<struct<{_DOC}>>, pairs binary, times binary, links binary")


def block_pairs(written: DataFrame) -> DataFrame:
    """(block, place, pair, n): the distinct pairs of each block."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k in range(batch.num_rows):
            pairs = np.frombuffer(batch.column(1)[k].as_buffer(), "<u4").astype(np.int64)
            times = np.frombuffer(batch.column(2)[k].as_buffer(), "<u4").astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), batch.column(0)[k].as_py())),
                                              pa.array(np.arange(len(pairs), dtype=np.int32)), pa.array(pairs), pa.array(times)],
                                             names=["block", "place", "pair", "n"])
    return map_batches(written.select("block", "pairs", "times"), run, "block long, place int, pair long, n long")


def pair_counts(own: DataFrame) -> DataFrame:
    """(pair, total, best): links of each pair of ids over all documents, and whether no pair
    of its B id has more."""
    total = own.groupBy("pair").agg(F.sum("n").alias("total"))
    b_id = F.col("pair").bitwiseAND(0xFFFF)
    most = total.groupBy(b_id.alias("b")).agg(F.max("total").alias("most"))
    return (total.withColumn("b", b_id).join(F.broadcast(most), "b")
            .select("pair", "total", (F.col("total") == F.col("most")).alias("best")))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block_links: int = BLOCK_LINKS,
          scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of every row of ``docs``."""
    s = scratch or Scratch(ship(docs.sparkSession), "align")
    written = s.save(blocks(docs, path_a, path_b, block_links), "blocks")
    own = s.save(block_pairs(written), "pairs")
    counts = s.save(pair_counts(s.save(own.groupBy("pair").agg(F.sum("n").alias("n")), "sums")), "counts")
    known = own.select("block", "place", "pair").join(counts, "pair").select("block", "place", "total", "best")

    def score(block: pa.Table, model: pa.Table) -> pa.Table:
        totals, best = np.zeros(model.num_rows, np.int64), np.zeros(model.num_rows, np.int64)
        place = model.column("place").to_numpy()
        totals[place] = model.column("total").to_numpy()
        best[place] = model.column("best").to_numpy()
        out = []
        for docs, blob in zip(block.column("docs"), block.column("links")):
            rows = docs.values
            n_links = rows.field("n_links").to_numpy()
            end = np.cumsum(n_links)
            places = _unpacked(blob.as_py(), int(n_links.sum()))
            sums = []
            for values in (best, totals):
                running = np.concatenate([[0], np.cumsum(values[places])])
                sums.append(pa.array(running[end] - running[end - n_links]))
            out.append(pa.table([*rows.flatten(), *sums], names=[c.split(":")[0] for c in _DOC.split(",")] + ["n_best", "count_sum"]))
        return pa.concat_tables(out)

    schema = ", ".join(c.replace(":", " ") for c in _DOC.split(",")) + ", n_best long, count_sum long"
    return (written.select("block", "docs", "links").groupBy("block").cogroup(known.groupBy("block"))
            .applyInArrow(score, schema))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
