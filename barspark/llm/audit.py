"""Filter interaction audit by forward-backward path counting.

Which documents a filter removes depends on what ran before it. Every row becomes a mask of
the filters it fails, and only the counts of each (part, mask) go on: at most 2**n rows a
part, whatever the corpus. The states of the audit are the subsets of filters applied so far;
an edge adds one filter to a state, and what it removes is the rows that fail it and nothing
in the state.

1. Forward, the orders that reach each state are counted from the empty set; backward, those
   that leave it towards the full set. Their product over an edge is the number of orders
   that go through it.
2. Shapley: a filter's removals summed over its edges, each weighted with its orders.
3. The steps of one order are the edges on its path: they are read from the same edges.

Copies (filter E) are found by a 256-bit digest of the whole text. The first doc_id of each
digest comes from one aggregate; a row is compared with it by a join on (digest, doc_id), so
a text with any number of copies is spread like all others.

Defined results: a null or empty text has no words and fails A only (and E, where a smaller
doc_id's text is null or empty too); a null source is the part ''; a row without doc_id is
counted, is never a copy and is the first of nothing; repeated rows of one doc_id are counted
one by one and are no copies of each other; several label rows of a doc_id are one, with a
flag where any has it; an empty table gives no rows.
"""
from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.llm import textops as T
from barspark.llm.common import Scratch, map_batches, ship, table

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITALS_PERCENT = 5
MARKS = "#$%&*|"
MOST_FILTERS = 6        # n! orders and 2**n states are written out per part
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in MARKS]] = True


def text_failures(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Bits 0 to 3 for the filters A to D on every text of a byte buffer."""
    starts, ends, first = T.word_spans(data, offs)
    words = T.span_hashes(data, starts, ends)
    n = np.diff(first)
    distinct = np.array([len(np.unique(words[a:b])) for a, b in zip(first[:-1], first[1:])], np.int64)

    def per_text(hit: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
        return total[offs[1:]] - total[offs[:-1]]
    capitals = per_text((data >= 65) & (data <= 90))
    points = per_text((data & 0xC0) != 0x80)
    return ((n < MIN_WORDS) | (100 * distinct < MIN_DISTINCT_PERCENT * n) << 1
            | (100 * capitals > MAX_CAPITALS_PERCENT * points) << 2 | (per_text(_MARK[data]) > 0) << 3).astype(np.int32)


def rated(docs: DataFrame, part_col: str = "source", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, part, digest, mask (filters A to D) of every row; texts are read once."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offs = T.text_bytes(batch.column(1))
        masks = [text_failures(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]) for lo, hi in T.chunks(offs)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(np.concatenate(masks))],
                                         names=["doc_id", "part", "digest", "mask"])

    return map_batches(slim, run, "doc_id long, part string, digest binary, mask int")


def with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """doc_id, part, mask, n: equal rows counted, ``bit`` set in the mask where a smaller doc_id
    has the same digest. Nothing is gathered by digest: (digest, doc_id) is the join's key."""
    counted = rows.groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = rows.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (counted.join(first, ["digest", "doc_id"], "left")
            .select("doc_id", "part", F.when(copy, F.col("mask").bitwiseOR(1 << bit)).otherwise(F.col("mask")).alias("mask"), "n"))


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: rows, and rows labelled good and toxic, per (part, mask)."""
    flags = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"))
             .filter("good + toxic > 0"))
    zero = F.lit(0).cast("long")
    total = rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), zero.alias("good"), zero.alias("toxic"))
    marked = (rows.join(flags, "doc_id").groupBy("part", "mask")
              .agg(zero.alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")))
    return total.union(marked).groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))


def lattice(n: int) -> list[dict]:
    """The edges of the lattice of subsets of ``n`` filters: state, filter, and the number of
    orders that go through the edge."""
    states = range(1 << n)
    reach, leave = [0] * (1 << n), [0] * (1 << n)
    reach[0] = leave[-1] = 1
    for s in states:
        for k in range(n):
            if not s >> k & 1:
                reach[s | 1 << k] += reach[s]
    for s in reversed(states):
        for k in range(n):
            if not s >> k & 1:
                leave[s] += leave[s | 1 << k]
    return [{"state": s, "k": k, "orders": reach[s] * leave[s | 1 << k]} for s in states for k in range(n) if not s >> k & 1]


def paths(filters: str, edges: list[dict]) -> list[dict]:
    """The steps of every order, each with the place of its edge."""
    place = {(e["state"], e["k"]): i for i, e in enumerate(edges)}
    out = []
    for order in itertools.permutations(range(len(filters))):
        state = 0
        for step, k in enumerate(order, 1):
            out.append({"filter_order": "".join(filters[j] for j in order), "step": step, "k": k, "edge": place[state, k]})
            state |= 1 << k
    return out


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, filter_order and step, from (part, mask, n, good, toxic) with one row
    per (part, mask); bit k of a mask stands for ``filters[k]``."""
    n = len(filters)
    if not 1 <= n <= MOST_FILTERS or len(set(filters)) != n:
        raise ValueError(f"1 to {MOST_FILTERS} different filter letters, not {filters!r}")
    edges = lattice(n)
    edge_list = F.from_json(F.lit(json.dumps(edges)), "array<struct<state:int,k:int,orders:long>>")
    path_list = F.from_json(F.lit(json.dumps(paths(filters, edges))), "array<struct<filter_order:string,step:int,k:int,edge:int>>")

    def total(field: str, hit) -> F.Column:
        return F.aggregate(F.filter("counts", lambda c: hit(c["mask"])), F.lit(0).cast("long"), lambda a, c: a + c[field])

    def cell(e: F.Column) -> F.Column:
        bit = F.call_function("shiftleft", F.lit(1), e["k"])
        seen = e["state"].bitwiseOR(bit)

        def removed(m: F.Column) -> F.Column:
            return m.bitwiseAND(seen) == bit
        return F.struct(
            e["k"].alias("k"), e["orders"].alias("orders"),
            total("n", lambda m: m.bitwiseAND(seen) == 0).alias("kept"), total("n", removed).alias("removed"),
            total("n", lambda m: (m.bitwiseAND(bit) == bit) & (m.bitwiseAND(seen) != bit)).alias("redundant"),
            total("n", lambda m: m == bit).alias("unique_fails"),
            total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"))

    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    cells = parts.select("part", F.transform(edge_list, cell).alias("cells"))
    weighted = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.aggregate(
        F.filter("cells", lambda c: c["k"] == k), F.lit(0).cast("long"), lambda a, c: a + c["orders"] * c["removed"]))
    steps = (cells.select("part", "cells", weighted.alias("shapley"))
             .select("part", "cells", "shapley", F.explode(path_list).alias("p")))
    at = F.get("cells", F.col("p.edge"))
    return steps.select("part", "p.filter_order", "p.step",
                        *(at[c].alias(c) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")),
                        F.get("shapley", F.col("p.k")).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """The audit of the five filters on whole texts, per ``part_col``."""
    s = Scratch(ship(docs.sparkSession), "audit")
    rows = s.save(rated(docs, part_col), "rated")
    masks = s.save(mask_counts(s.save(with_copies(rows, FILTERS.index("E")), "masked"), labels), "masks")
    s.drop("rated", "masked")
    return audit(masks)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (
  SELECT doc_id, part,
         concat(CASE WHEN len(ws) < {MIN_WORDS} THEN 'A' ELSE '' END,
                CASE WHEN 100 * len(list_distinct(ws)) < {MIN_DISTINCT_PERCENT} * len(ws) THEN 'B' ELSE '' END,
                CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {MAX_CAPITALS_PERCENT} * length(t) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS failed
  FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, failed, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
o AS (SELECT '' AS o UNION ALL SELECT o.o || x.x FROM o, (SELECT unnest(string_split('{" ".join(FILTERS)}', ' ')) AS x) x WHERE NOT contains(o.o, x.x)),
s AS (SELECT o AS filter_order, unnest(range(1, {len(FILTERS) + 1})) AS step FROM o WHERE length(o) = {len(FILTERS)}),
p AS (SELECT DISTINCT part FROM f),
m AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS x, failed, n, good, toxic,
             length(substr(filter_order, 1, step - 1)) > length(translate(substr(filter_order, 1, step - 1), failed, '')) AS before,
             contains(failed, substr(filter_order, step, 1)) AS fails
      FROM s, p LEFT JOIN c USING (part)),
r AS (SELECT part, filter_order, step, x, sum(CASE WHEN before OR fails THEN 0 ELSE n END) AS kept,
             sum(CASE WHEN fails AND NOT before THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fails AND before THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN failed = x THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fails AND NOT before THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN fails AND NOT before THEN toxic ELSE 0 END) AS toxic_lost
      FROM m GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       sum(removed) OVER (PARTITION BY part, x)::BIGINT AS shapley
FROM r
"""
