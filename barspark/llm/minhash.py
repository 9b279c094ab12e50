"""MinHash near-duplicates: many universal minima, banding, verification, components.

1. Every text becomes its set of distinct five-word shingles (64-bit hashes), 344
   minima of ``a x + b mod 2**32`` and 43 band keys of eight minima. A pair at
   similarity 0.85 shares no band with probability (1 - 0.85**8)**43 < 1.2e-6.
2. Equal sets are one class, named by a number in the order of its smallest doc_id; only
   the first row of a class (smallest doc_id, then text hash) goes on.
3. In each band bucket, members are compared with the bucket's smallest member (a star:
   linear in the bucket). Candidates whose minima agree on too few places are dropped
   (4.5 standard deviations below the threshold), the rest is confirmed on the full
   sets, and large-star / small-star joins what is linked.
4. Buckets that then still hold members of several components are compared in blocks of
   at most ``BLOCK`` members inside tasks, by their 8-bit minima; a pair leaves the task
   only from the first band whose key it shares (the keys that make the buckets, so the pair
   is in that cell), if its members are in different components and its minima agree on
   enough places. These are confirmed on the full sets as well. So no
   link between components is lost, and groups that the stars have settled cost nothing.

Defined results: a null, empty or wordless text has an empty set and links with nothing;
fewer than five words make one shingle; a row without doc_id is kept, alone, with
component null; repeated rows are copies of one document and get one component; where a
doc_id names several texts, each row follows its own text, and of those in one component
only the first row's text is kept; an empty table gives no rows. Links need 100 |A and B| >= 85 |A or B|.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.llm import textops as T
from barspark.llm.common import Scratch, columns, map_batches, ship, table, texts_of
from barspark.llm.components import components

SHINGLE = 5
PERCENT = 85
ROWS = 8
BANDS = 43
BLOCK = 512
SIGMAS = 4.5


def _family(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(9001))
    return (rng.integers(0, 2**32, k, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, k, dtype=np.uint32))


def least_agreement(percent: int, places: int) -> int:
    """Places on which the minima of a pair at the threshold agree, less the margin."""
    s = percent / 100
    return int(np.floor(places * (s - SIGMAS * np.sqrt(s * (1 - s) / places))))


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    starts, ends, first = T.word_spans(data, offs)
    words = T.span_hashes(data, starts, ends, lower=True)
    windows = T.window_hashes(words, size)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            yield np.unique(windows[a:b - size + 1])
        elif b > a:
            yield T.window_hashes(words[a:b], int(b - a))
        else:
            yield np.zeros(0, np.uint64)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 2**32 - 1, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(out, (a[:, None] * x[None, i:i + 2048] + b[:, None]).min(axis=1), out=out)
    return out


def _set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    m = T.mix(shingles * np.uint64(0x9FB21C651E98DF25) + np.uint64(1))
    return (int(m.sum(dtype=np.uint64).view(np.int64)),
            int((T.mix(m).sum(dtype=np.uint64) ^ np.uint64(len(m))).view(np.int64)))


def text_key() -> F.Column:
    """Tells apart the texts of one doc_id."""
    return F.xxhash64(F.col("text").cast("string"))


def signatures(docs: DataFrame, size: int = SHINGLE, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """doc_id, text_key, n_shingles, k1, k2 (name of the set), bands (keys), sketch (8-bit minima)."""
    a, b = _family(rows * bands)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offs = T.text_bytes(batch.column(1))
        salt = T.mix(np.arange(1, bands + 1, dtype=np.uint64))
        place = T.mix(np.arange(1, rows + 1, dtype=np.uint64)) << np.uint64(32)
        for lo, hi in T.chunks(offs):
            n, keys, bins, sketches = [], [], [], []
            for u in shingle_sets(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], size):
                n.append(len(u))
                if not len(u):
                    keys.append((0, 0)), bins.append(None), sketches.append(None)
                    continue
                keys.append(_set_key(u))
                m = minima(u, a, b)
                wide = m.reshape(bands, rows).astype(np.uint64)
                bins.append(T.mix(T.mix(wide + place).sum(axis=1) + salt).view(np.int64))
                sketches.append(m.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(n, pa.int64()),
                 pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array(bins, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "k1", "k2", "bands", "sketch"])

    return map_batches(texts_of(docs).withColumn("text_key", text_key()), run,
                       "doc_id long, text_key long, n_shingles long, k1 long, k2 long, bands array<long>, sketch binary")


def set_table(texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(node, shingles): the full set of each text as 8-byte hashes, sorted."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offs = T.text_bytes(batch.column(1))
        for lo, hi in T.chunks(offs):
            sets = [u.tobytes() for u in shingle_sets(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], size)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.large_binary())
                                              .cast(pa.binary())], names=["node", "shingles"])
    return map_batches(texts, run, "node long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (u, v) whose full sets reach the threshold. ``sets`` is a written table
    by node, so a document in many pairs is a splittable skew join."""
    both = (pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u")
                 .join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v")
                 .select("u", "v", "su", "sv"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
                keep.append(False)
                continue
            at = np.minimum(np.searchsorted(q, p), len(q) - 1)
            common = int((q[at] == p).sum())
            keep.append(100 * common >= percent * (len(p) + len(q) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep))

    return map_batches(both, run, "u long, v long")


def row_per_text(docs: DataFrame, value: F.Column) -> DataFrame:
    """(_id, _key, row): ``value`` of one row per doc_id and text, rows without doc_id left out.
    Repeated rows are joined in each task before the one shuffle."""
    return (docs.filter("`doc_id` IS NOT NULL").groupBy(F.col("`doc_id`").cast("long").alias("_id"), text_key().alias("_key"))
            .agg(F.first(value).alias("row")))


def texts_by_id(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(node, text) of the texts in ``ids`` (node, doc_id, text_key). The texts are shuffled once by
    id and key and merged with the ids, whatever the sizes: the plan is the same at every scale."""
    wanted = ids.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "node").hint("merge")
    return row_per_text(docs, F.col("`text`").cast("string")).join(wanted, ["_id", "_key"]).select("node", F.col("row").alias("text"))


def _agreeing(pairs: DataFrame, sketches: DataFrame, least: int) -> DataFrame:
    """Pairs whose 8-bit minima agree on at least ``least`` places."""
    both = (pairs.join(sketches.select(F.col("node").alias("u"), F.col("sketch").alias("su")), "u")
                 .join(sketches.select(F.col("node").alias("v"), F.col("sketch").alias("sv")), "v")
                 .select("u", "v", "su", "sv"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        y = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        ok = (x == y).sum(axis=1) >= least
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(ok))

    return map_batches(both, run, "u long, v long")


def _block_pairs(members: DataFrame, least: int) -> DataFrame:
    """Candidate pairs inside blocks: rows (cell, side, band, node, component, sketch,
    bands), dealt by cell. A cell is a bucket, or a pair of blocks of a large one: at most
    2 x BLOCK rows. Rows of a cell arrive in a row; only one cell is held."""
    def pairs_of(cell: list[tuple]) -> Iterator[tuple[int, int]]:
        if len(cell) < 2:
            return
        side = np.array([r[1] for r in cell])
        band = cell[0][2]
        node = np.array([r[3] for r in cell], np.int64)
        comp = np.array([r[4] for r in cell], np.int64)
        sk = np.frombuffer(b"".join(r[5] for r in cell), np.uint8).reshape(len(cell), -1)
        keys = np.stack([r[6] for r in cell])
        left = np.flatnonzero(side == 0) if (side == 1).any() else np.arange(len(cell))
        for i in left:
            other = np.flatnonzero(side == 1) if (side == 1).any() else np.arange(i + 1, len(cell))
            other = other[comp[other] != comp[i]]
            if not len(other):
                continue
            other = other[(sk[other] == sk[i]).sum(axis=1) >= least]
            first = (keys[other] == keys[i]).argmax(axis=1)
            for j in other[first == band]:
                yield (min(node[i], node[j]), max(node[i], node[j]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: list[tuple] = []
        found: list[tuple[int, int]] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()),
                                               pa.array([p[1] for p in found], pa.int64())], names=["u", "v"])
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(6).flatten().to_numpy().reshape(batch.num_rows, -1)
            for row in zip(*(c.to_pylist() for c in batch.columns[:6]), keys):
                if cell and row[0] != cell[0][0]:
                    found.extend(pairs_of(cell))
                    cell = []
                    if len(found) > 50_000:
                        yield flush()
                        found = []
                cell.append(row)
        found.extend(pairs_of(cell))
        if found:
            yield flush()

    dealt = members.repartition("cell").sortWithinPartitions("cell")
    return dealt.select("cell", "side", "band", "node", "component", "sketch", "bands").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, scratch: Scratch | None = None, percent: int = PERCENT,
                    rows: int = ROWS, bands: int = BANDS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    return judged(docs, scratch, percent, rows, bands, block).drop("text_key")


def judged(docs: DataFrame, scratch: Scratch | None = None, percent: int = PERCENT,
           rows: int = ROWS, bands: int = BANDS, block: int = BLOCK) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept for every row of ``docs``."""
    s = scratch or Scratch(ship(docs.sparkSession), "minhash")
    least = least_agreement(percent, rows * bands)
    sig = s.save(signatures(docs, rows=rows, bands=bands), "signatures")

    # 2. classes of equal sets
    named = sig.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    least_row = named.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "text_key")).alias("least"))
    classes = s.save(least_row.select("k1", "k2", F.col("least.doc_id").alias("least_id"), F.col("least.text_key").alias("least_key"))
                     .orderBy("least_id", "least_key").withColumn("node", F.monotonically_increasing_id()), "classes")
    nodes = s.save(named.join(classes, ["k1", "k2"]).filter("doc_id = least_id AND text_key = least_key")
                   .select("node", "doc_id", "text_key", "bands", "sketch"), "nodes")

    # 3. stars
    keyed = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = s.save(keyed.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n"))
                     .filter("n > 1"), "buckets")
    member = s.save(keyed.join(buckets, "key").select("key", "band", "node", "head", "n"), "members")
    stars = s.save(member.filter("node != head").select(F.col("head").alias("u"), F.col("node").alias("v"))
                   .distinct(), "stars")
    busy = member.select("node").distinct()
    sketches = s.save(nodes.join(busy, "node", "left_semi").select("node", "doc_id", "text_key", "bands", "sketch"), "sketches")
    busy = s.save(sketches.select("node", "doc_id", "text_key").distinct(), "busy")
    sets = s.save(set_table(texts_by_id(docs, busy)), "sets")
    links = s.save(confirmed(s.save(_agreeing(stars, sketches, least), "near"), sets, percent), "links")
    found = s.save(components(links, s, "cc"), "components")

    # 4. buckets that hold several components
    labelled = s.save(member.join(found, "node", "left")
                      .select("key", "band", "node", "n", F.coalesce("component", "node").alias("component")), "labelled")
    open_ = s.save(labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                   .filter("lo != hi").select("key"), "open")
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("int")
    placed = (labelled.join(open_, "key").withColumn("parts", parts)
              .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
              .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .join(sketches, "node")
              .select(F.xxhash64("key", F.least("own", "with"), F.greatest("own", "with")).alias("cell"),
                      (F.col("own") > F.col("with")).cast("int").alias("side"), "band", "node", "component", "sketch", "bands"))
    cross = s.save(_block_pairs(placed, least), "cross")
    more = s.save(confirmed(cross.distinct(), sets, percent), "more")
    final = s.save(components(links.union(more), s, "cc2"), "final")

    first = classes.select(F.col("node").alias("first"), F.col("least_id").alias("class_component"),
                           F.col("least_key").alias("first_key"))
    label = s.save(classes.join(final, "node", "left").withColumn("first", F.coalesce("component", "node"))
                   .join(first, "first").select("k1", "k2", "class_component", "first_key"), "labels")
    s.drop("nodes", "busy", "buckets", "members", "stars", "sketches", "sets", "near", "labelled", "open", "cross")
    slim = sig.select("doc_id", "text_key", "n_shingles", "k1", "k2")
    own = F.col("first_key").isNull() | (F.col("text_key") == F.col("first_key"))
    return (slim.join(label, ["k1", "k2"], "left")
            .select("doc_id", "text_key", "n_shingles", own.alias("own"),
                    F.when(F.col("n_shingles") > 0, F.coalesce("class_component", "doc_id"))
                     .otherwise(F.col("doc_id")).alias("component_id"))
            .select("doc_id", "text_key", "n_shingles", "component_id",
                    (F.col("doc_id").isNull() | ((F.col("doc_id") == F.col("component_id")) & F.col("own"))).alias("kept")))


def deduplicated(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with one document of each group, all columns as they are. Rows that repeat
    a kept doc_id and text leave one; rows without doc_id all stay. The texts cross one shuffle,
    by id and key, which serves the repeated rows and the merge with the verdicts alike."""
    s = scratch or Scratch(docs.sparkSession, "dedup")
    gone = s.save(judged(docs, s).filter("NOT kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
                  .distinct(), "gone")
    left = (row_per_text(docs, F.struct(*columns(docs))).join(gone.hint("merge"), ["_id", "_key"], "left_anti")
            .select("row.*"))
    return left.union(docs.filter("`doc_id` IS NULL"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
