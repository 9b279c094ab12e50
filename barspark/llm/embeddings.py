"""Embedding near-duplicates by iterative quantisation.

1. A bounded sample (``SAMPLE`` vectors, picked by a hash) gives mean, principal axes and,
   by alternating sign and Procrustes steps, rotations that make the projected coordinates
   agree with balanced binary codes. Every vector is coded with each rotation.
2. Each code is cut into chunks, one Hamming table per chunk. A vector is stored under
   its chunk and looks up all chunk values within Hamming distance ``RADIUS``; so a pair is
   retrieved if any chunk of any code differs in at most that many bits. The wider the
   chunks, the more codes, so a pair at the threshold is missed with a chance of at most
   ``MISS`` at any size (bit flips taken as independent, the mean as near zero).
3. Retrieved pairs of a table cell are reranked with the original vectors in double
   precision, in blocks of at most ``BLOCK`` rows inside tasks. A pair counts in one cell
   only (that of the first table that retrieves it), so the links per vector are sums, and
   a cell returns a row per vector: its links and the smallest vector it reaches in the
   cell. No list of pairs exists anywhere.
4. Large-star / small-star joins the cells' components.

Equal vectors of one label are one class with a count before anything else.

Defined results: a null, empty or zero vector, or one with null or non-finite
components, a null label or a null vec_id links with nothing (0 links, component its own
vec_id, kept); vectors of different lengths are never compared; a repeated row is
another vector with the same vec_id; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.llm import textops as T
from barspark.llm.common import Scratch, map_batches, ship, table
from barspark.llm.components import components

COSINE = 0.98
SAMPLE = 8192
BITS = 64
CODES = 2
RADIUS = 1
MISS = 1e-7
STEPS = 30
BLOCK = 512


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1 (scaled first, so no square overflows)."""
    if not len(x):
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotations(x: np.ndarray, codes: int = CODES, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, (codes, d, bits) projections): principal axes (at most ``BITS``), each time turned by
    an iteratively quantised rotation from another random start."""
    d = x.shape[1]
    bits = min(d, BITS)
    x = unit(x)
    mean = x.sum(axis=0) / (len(x) + d)         # d zero vectors keep a tiny sample's mean off its points
    centred = x - mean
    _, axes = np.linalg.eigh(centred.T @ centred + 1e-9 * np.eye(d))
    axes = axes[:, ::-1][:, :bits]
    v = centred @ axes
    out = []
    for seed in range(codes):
        r, _ = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((bits, bits)))
        for _ in range(steps):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        out.append(axes @ r)
    return mean, np.stack(out)


def chunk_bounds(bits: int, n: int) -> list[tuple[int, int]]:
    """Bit ranges of the Hamming tables: chunks near log2(n) + 2 bits, so that a cell holds few
    unrelated vectors at any size."""
    want = min(24, max(8, int(np.ceil(np.log2(max(n, 2)))) + 2))
    m = max(1, round(bits / want))
    at = [round(k * bits / m) for k in range(m + 1)]
    return list(zip(at[:-1], at[1:]))


def code_count(bounds: list[tuple[int, int]], cosine: float) -> int:
    """Codes, at least ``CODES``, whose chunks all differ in more than ``RADIUS`` bits with a chance
    of at most ``MISS`` for a pair at ``cosine``: a bit flips with a chance of angle / pi."""
    p = np.arccos(np.clip(cosine, -1, 1)) / np.pi
    one = 1.0
    for lo, hi in bounds:
        one *= max(0.0, 1 - sum(comb(hi - lo, r) * p**r * (1 - p)**(hi - lo - r) for r in range(RADIUS + 1)))
    return CODES if one <= 0 else max(CODES, int(np.ceil(np.log(MISS) / np.log(one))))


def codes_of(x: np.ndarray, mean: np.ndarray, projections: np.ndarray) -> np.ndarray:
    """(rows, codes) of uint64."""
    out = np.zeros((len(x), len(projections)), np.uint64)
    x = unit(x)
    for k, p in enumerate(projections):
        bit = ((x - mean) @ p >= 0).astype(np.uint64)
        out[:, k] = (bit << np.arange(p.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out


def vectors_of(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, v (array of double, null unless usable), k1, k2 (name of label and vector)."""
    v = F.col("embedding").cast("array<double>")
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
            & F.exists(v, lambda e: e != 0.0))
    plain = F.transform(v, lambda e: e + 0.0)     # -0.0 and 0.0 are one value
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                              F.when(fine, plain).alias("v"))
            .withColumn("k1", F.when(F.col("v").isNotNull(), F.xxhash64("label", "v")))
            .withColumn("k2", F.when(F.col("v").isNotNull(), F.xxhash64("v", "label"))))


def _coded(classes: DataFrame, d: int, model: tuple[np.ndarray, np.ndarray], bounds: list[tuple[int, int]]) -> DataFrame:
    """node, mult, codes, v (bytes), own (cell key per table), near (keys within RADIUS)."""
    mean, projections = model

    def keys(label: np.ndarray, t: int, chunk: np.ndarray) -> np.ndarray:
        return T.mix(T.mix(chunk + np.uint64((t + 1) << 40)) ^ label).view(np.int64)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = np.array(batch.column(2).flatten().to_numpy(zero_copy_only=False)).reshape(batch.num_rows, d)
        label = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        code = codes_of(x, mean, projections)
        own, near = [], []
        for c in range(code.shape[1]):
            for k, (lo, hi) in enumerate(bounds):
                chunk = (code[:, c] >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
                t = c * len(bounds) + k
                own.append(keys(label, t, chunk))
                near.extend(keys(label, t, chunk ^ np.uint64(1 << b)) for b in range(hi - lo))
        as_lists = lambda cols: pa.FixedSizeListArray.from_arrays(
            pa.array(np.stack(cols, axis=1).ravel()), len(cols)).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in code], pa.binary()),
             pa.array([r.tobytes() for r in x], pa.binary()), as_lists(own), as_lists(near)],
            names=["node", "mult", "codes", "v", "own", "near"])

    slim = classes.select("node", "mult", "v", F.xxhash64("label").alias("l"))
    return map_batches(slim, run, "node long, mult long, codes binary, v binary, own array<long>, near array<long>")


def _cell_links(cell: list[tuple], bounds: list[tuple[int, int]], cosine: float) -> Iterator[tuple[int, int, int]]:
    """(node, links, smallest node reached) of a cell's rows (cell, side, home, table, node, mult,
    codes, v). ``home`` is 1 for a stored row and 0 for a look-up; ``side`` is 0 within
    a block; -1 and 1 tell the blocks of a block pair apart."""
    if len(cell) < 2:
        return
    side, home = np.array([r[1] for r in cell]), np.array([r[2] for r in cell])
    t, node = cell[0][3], np.array([r[4] for r in cell], np.int64)
    mult = np.array([r[5] for r in cell], np.int64)
    code = np.frombuffer(b"".join(r[6] for r in cell), np.uint64).reshape(len(cell), -1)
    x = np.frombuffer(b"".join(r[7] for r in cell), np.float64).reshape(len(cell), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    norm = np.sqrt((x * x).sum(axis=1))
    close = (x @ x.T) >= cosine * np.outer(norm, norm)
    if side[0]:
        close &= side[:, None] != side[None, :]
    # two stored rows, or a stored row that a larger one looks up
    larger = node[:, None] > node[None, :]
    asks = (home[:, None] == 0) & (home[None, :] == 1) & larger
    close &= ((home[:, None] == 1) & (home[None, :] == 1)) | asks | asks.T
    np.fill_diagonal(close, False)
    i, j = np.nonzero(np.triu(close))
    if not len(i):
        return
    first = np.full(len(i), -1)
    for c in range(code.shape[1]):
        diff = code[i, c] ^ code[j, c]
        for k, (lo, hi) in enumerate(bounds):
            off = np.bitwise_count((diff >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1))
            first = np.where((first < 0) & (off <= RADIUS), c * len(bounds) + k, first)
    i, j = i[first == t], j[first == t]
    links = np.bincount(i, mult[j], minlength=len(cell)) + np.bincount(j, mult[i], minlength=len(cell))
    reach = node.copy()
    while True:
        new = reach.copy()
        np.minimum.at(new, i, reach[j])
        np.minimum.at(new, j, reach[i])
        if (new == reach).all():
            break
        reach = new
    for k in np.flatnonzero(links):
        yield int(node[k]), int(links[k]), int(reach[k])


def _rerank(placed: DataFrame, bounds: list[tuple[int, int]], cosine: float) -> DataFrame:
    """(node, links, leader) of every cell; a cell has at most 2 x BLOCK rows and its rows
    arrive in a row."""
    names = ["cell", "side", "home", "t", "node", "mult", "codes", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: list[tuple] = []
        found: list[tuple[int, int, int]] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["node", "links", "leader"])
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if cell and row[0] != cell[0][0]:
                    found.extend(_cell_links(cell, bounds, cosine))
                    cell = []
                    if len(found) > 50_000:
                        yield flush()
                        found = []
                cell.append(row)
        found.extend(_cell_links(cell, bounds, cosine))
        if found:
            yield flush()

    ship(placed.sparkSession)
    return (placed.repartition("cell").sortWithinPartitions("cell").select(*names)
            .mapInArrow(run, "node long, links long, leader long"))


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``embeddings``."""
    s = Scratch(ship(embeddings.sparkSession), "itq")
    named = s.save(vectors_of(embeddings), "vectors")
    classes = s.save(named.filter("v IS NOT NULL").groupBy("k1", "k2", "label")
                     .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("mult"), F.first("v").alias("v")), "classes")
    links, edges = None, None
    for r in sorted(classes.groupBy(F.size("v").alias("d")).count().collect()):
        d, n = r["d"], r["count"]
        own = classes.filter(F.size("v") == d)
        u = F.pmod(F.xxhash64("k1"), F.lit(1 << 30)) / float(1 << 30)
        rows = own.filter(u < min(1.0, sample / n)).select("v").toArrow().column(0)
        bounds = chunk_bounds(min(d, BITS), n)
        model = rotations(np.array(rows.combine_chunks().flatten()).reshape(-1, d).astype(float)
                          if len(rows) else np.zeros((0, d)), code_count(bounds, cosine))
        coded = s.save(_coded(own, d, model, bounds), f"coded{d}")
        found = s.save(_rerank(_placed(coded, len(bounds), s, d, block), bounds, cosine), f"found{d}")
        part = found.groupBy("node").agg(F.sum("links").alias("links"))
        edge = found.filter("node != leader").select(F.col("node").alias("u"), F.col("leader").alias("v"))
        links, edges = (part, edge) if links is None else (links.union(part), edges.union(edge))
    base = named.select("vec_id", "k1", "k2", F.col("v").isNotNull().alias("usable"))
    if links is None:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    comp = s.save(components(edges, s, "cc"), "components")
    label = s.save(classes.select("k1", "k2", "node", "mult")
                   .join(links, "node", "left").join(comp, "node", "left")
                   .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                           F.coalesce("component", "node").alias("component_id")), "labels")
    return (base.join(label, ["k1", "k2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def _placed(coded: DataFrame, chunks: int, s: Scratch, d: int, block: int) -> DataFrame:
    """Rows of the cells: stored rows, and look-ups that meet a stored row of another vector."""
    stored = coded.select("node", F.posexplode("own").alias("t", "key"))
    count = s.save(stored.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least")), f"cells{d}")
    per_table = F.col("t")
    asked = (coded.select("node", F.posexplode("near").alias("p", "key"))
             .join(count.select("key", "least"), "key").filter("node > least").select("node", "key"))
    asked = s.save(asked, f"asked{d}")
    more = asked.groupBy("key").agg(F.count(F.lit(1)).alias("a"))
    busy = s.save(count.join(more, "key", "left").withColumn("rows", F.col("n") + F.coalesce("a", F.lit(0)))
                  .filter("rows > 1").select("key", "rows"), f"busy{d}")
    tables = s.save(stored.groupBy("key").agg(F.min(per_table).alias("t")), f"tables{d}")
    rows = (stored.select("node", "key", F.lit(1).alias("home")).union(asked.select("node", "key", F.lit(0).alias("home"))))
    parts = F.ceil(F.col("rows") / block).cast("int")
    return (rows.join(busy.join(tables, "key"), "key").withColumn("parts", parts)
            .withColumn("own_part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
            .withColumn("with_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .join(coded.select("node", "mult", "codes", "v"), "node")
            .select(F.xxhash64("key", F.least("own_part", "with_part"), F.greatest("own_part", "with_part")).alias("cell"),
                    (F.signum(F.col("own_part") - F.col("with_part"))).cast("int").alias("side"), "home", "t", "node", "mult",
                    "codes", "v"))


def op8_itq_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
