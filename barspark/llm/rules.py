"""Quality rules with host-level verdicts.

Base rules judge each whole text. The share of failing documents per host (the
``source`` column) is shrunk towards the corpus by an empirical beta prior
(method of moments over the hosts), and a host whose posterior failure rate exceeds
``max_host_rate`` is rejected; the verdict is joined back to its documents.

Defined results: a null or empty text has no words, fails (``n_words < 50``) and
counts for its host; a null host is a host of its own; repeated rows are judged and
counted one by one; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.llm import textops as T
from barspark.llm.common import Scratch, map_batches, row_of, row_schema, table, text_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
MAX_HOST_RATE = 0.5
MAX_STRENGTH = 1e6
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _prefix(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values, dtype=np.int64)])


def text_counts(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The five counts for every text of a byte buffer."""
    n = len(offs) - 1
    starts, ends, first = T.word_spans(data, offs)
    out = {"n_words": np.diff(first).astype(np.int64)}
    # code points: bytes that do not continue a character
    points = _prefix((data & 0xC0) != 0x80)
    per_word = _prefix(points[ends] - points[starts])
    out["word_chars"] = per_word[first[1:]] - per_word[first[:-1]]
    symbols = _prefix(_SYMBOL[data])
    out["n_symbols"] = symbols[offs[1:]] - symbols[offs[:-1]]

    l_starts, l_ends, l_first = T.line_spans(data, offs)
    spoken = np.searchsorted(starts, l_ends) > np.searchsorted(starts, l_starts)
    lines = T.span_hashes(data, l_starts, l_ends)
    words = T.span_hashes(data, starts, ends)
    windows = T.window_hashes(words, WINDOW)
    dup = np.zeros(n, np.int64)
    repeat = np.zeros(n, np.int64)
    for i in range(n):
        own = lines[l_first[i]:l_first[i + 1]][spoken[l_first[i]:l_first[i + 1]]]
        if len(own) > 1:
            dup[i] = len(own) - len(np.unique(own))
        k = int(first[i + 1] - first[i])
        if k > WINDOW:
            _, place, count = np.unique(windows[first[i]:first[i + 1] - WINDOW + 1],
                                        return_inverse=True, return_counts=True)
            again = count[place] > 1
            if again.any():
                covered = np.zeros(k, bool)
                for shift in range(WINDOW):
                    covered[shift:k - WINDOW + 1 + shift] |= again
                repeat[i] = int(covered.sum())
    return out | {"n_dup_lines": dup, "n_repeat_words": repeat}


def rule_counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (the ``keep`` columns of ``docs``) and the five counts of its texts, row by row."""
    slim = docs.select(row_of(docs, keep), *([] if text_col in keep else [F.col(f"`{text_col}`")]))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offs = T.text_bytes(text_of(batch, text_col))
        for lo, hi in T.chunks(offs):
            counts = text_counts(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo)] + [pa.array(counts[c]) for c in COUNTS],
                                             names=["row", *COUNTS])

    return map_batches(slim, run, row_schema(docs, keep, ", ".join(f"{c} long" for c in COUNTS)))


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def host_rates(rated: DataFrame, host_col: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: documents, failures, posterior failure rate and verdict.

    The prior has the mean m of all documents and a strength from the spread of the host
    rates beyond binomial noise. With x failures among n documents of each of k hosts, N in
    all, S = sum n (x / n - m)**2 is expected to be m (1 - m) ((k - 1) + c (N - sum n**2 / N -
    (k - 1))), where c is the correlation of two documents of one host: c follows by moments,
    and the strength is 1 / c - 1, between 1 and ``MAX_STRENGTH`` (no spread left: hosts get
    the mean). The groups are pre-aggregated, so a host with a third of all rows is one row
    per task before the shuffle."""
    h = (rated.groupBy(F.col(f"`{host_col}`").alias("host"))
         .agg(F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed")))
    n, x = F.col("host_docs").cast("double"), F.col("host_failed").cast("double")
    sums = h.agg(F.sum(n).alias("n"), F.sum(x).alias("x"), F.sum(x * x / n).alias("xx"), F.sum(n * n).alias("nn"),
                 F.count(F.lit(1)).alias("k"))
    m, free = F.col("x") / F.col("n"), F.col("k") - 1
    noise = m * (1 - m)
    room = F.col("n") - F.col("nn") / F.col("n") - free
    known = (noise > 0) & (room > 0)
    shared = F.when(known, ((F.col("xx") - F.col("x") * m) / noise - free) / room).otherwise(0.0)
    strength = 1 / F.least(F.lit(0.5), F.greatest(F.lit(1 / (1 + MAX_STRENGTH)), shared)) - 1
    prior = sums.select(F.struct(m.alias("m"), strength.alias("s")).alias("p")).scalar()
    return (h.withColumn("_p", prior)
             .withColumn("host_rate", (F.col("host_failed") + F.col("_p.m") * F.col("_p.s"))
                         / (F.col("host_docs") + F.col("_p.s")))
             .withColumn("host_ok", F.col("host_rate") <= max_host_rate).drop("_p"))


def judge(docs: DataFrame, host_col: str = "source", max_host_rate: float = MAX_HOST_RATE,
          scratch: Scratch | None = None) -> DataFrame:
    """doc_id, host, the counts, base_failed, host_rate and kept for every row of ``docs``.

    The texts are read once: the counts are written to the scratch folder, the host
    rates and the join read that narrow table."""
    scratch = scratch or Scratch(docs.sparkSession, "rules")
    counts = rule_counts(docs, ["doc_id", host_col])
    rated = scratch.save(counts.select(F.col("row.doc_id").alias("doc_id"), F.col(f"row.`{host_col}`").alias("host"),
                                       *COUNTS, base_failed().alias("base_failed")), "rated")
    hosts = scratch.save(host_rates(rated, "host", max_host_rate), "hosts")
    joined = (rated.alias("r").join(hosts.alias("h"), F.expr("r.host <=> h.host"), "left")
              .select("r.*", "h.host_rate", "h.host_ok"))
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_ok")).drop("host_ok")


def passed(docs: DataFrame, host_col: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they are. The texts are read twice: for
    the host rates, and for the rows' own verdicts with the texts passed along."""
    scratch = Scratch(docs.sparkSession, "rules")
    narrow = rule_counts(docs, [host_col]).select(F.col(f"row.`{host_col}`").alias("host"), base_failed().alias("base_failed"))
    hosts = scratch.save(host_rates(narrow, "host", max_host_rate).select("host", "host_ok"), "hosts")
    own = rule_counts(docs, docs.columns).filter(~base_failed())
    return (own.join(hosts, F.col(f"row.`{host_col}`").eqNullSafe(F.col("host")), "left")
            .filter("host_ok").select("row.*"))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = judge(table(spark, sf_dir, "documents"))
    return j.select("doc_id", *COUNTS, "base_failed", "kept", F.round("host_rate", 9).alias("host_rate"))


SQL = rf"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
win AS (
  SELECT rid, doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
  FROM (SELECT row_number() OVER () AS rid, doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY 1),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w),
dl AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM ln WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1),
q AS (
  SELECT doc_id, source, len(ws) AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dl.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dl USING (doc_id)),
f AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM q),
h AS (SELECT source, count(*) AS d, sum(base_failed::INT)::DOUBLE AS x FROM f GROUP BY 1),
p AS (SELECT sum(x) / sum(d) AS m, count(*) AS k, sum(d) AS n, sum(d * (d / (SELECT sum(d) FROM h))) AS nn FROM h),
v AS (SELECT m, k, n, nn, (SELECT sum(d * pow(x / d - p.m, 2)) FROM h) AS spread FROM p),
c AS (SELECT m, CASE WHEN m > 0 AND m < 1 AND n - nn - k + 1 > 0 THEN (spread / (m - m * m) - k + 1) / (n - nn - k + 1) ELSE 0 END AS c FROM v),
s AS (SELECT m, CASE WHEN c >= 0.5 THEN 1 WHEN c <= 1 / (1 + {MAX_STRENGTH}) THEN {MAX_STRENGTH} ELSE (1 - c) / c END AS s FROM c),
r AS (SELECT source, (x + m * s) / (d + s) AS rate FROM h, s)
SELECT f.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       (NOT base_failed AND rate <= {MAX_HOST_RATE}) AS kept, round(rate, 9) AS host_rate
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source
"""
