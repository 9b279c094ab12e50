"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation again and again as it grows. Each turn gets a rolling
hash of the turns up to it; a conversation whose whole hash occurs as a proper prefix of
another is dropped by an anti-join, of equal conversations the smallest conv_id stays,
and what remains is rendered turn by turn with a chat template.

A conversation is never gathered: it is cut by rank into runs of about ``RUN`` turns (at most
200,000 runs in all, then they grow), and places and prefix hashes are running values inside a
run plus the totals of the runs before (one row per run). So a conversation with a third of all
turns is spread over many tasks, also when its turn numbers are equal or null. The result has
a row per turn: its rendered segment and where it starts in the conversation's text.

Defined results: a null text is empty and a null role is ``unknown``; rows equal in
conversation, turn, role and text are one turn; other turns with equal numbers follow
in order of role and text hash; a null turn comes first; rows without conv_id form one
conversation; an empty table gives no rows; extra columns are not read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barspark.llm.common import Scratch, table
from barspark.operators.sequence import BKT, RN, index_sequence

RUN = 256
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls replaced, and the turn's hashes."""
    t = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (t.withColumn("h1", F.xxhash64("role", "text"))
             .withColumn("h2", F.xxhash64(F.lit(1), "text", "role")))


def prefix_hashes(turns: DataFrame, s: Scratch, name: str) -> DataFrame:
    """conv_id, turn, role, h1, h2, run, pos (from 1), p1, p2 (hash of the turns up to pos)."""
    key = ["conv_id", "turn", "role", "h1", "h2"]
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    same_run = F.expr("a.conv_id <=> b.conv_id AND a.run = b.run")

    distinct = s.save(turns.select(*key).distinct(), f"{name}-distinct")
    ranked = index_sequence(distinct, ["conv_id"], "turn", ["role", "h1", "h2"], target_rows=RUN).frame
    mixed = (ranked.select(*key, F.col(BKT).alias("run"), (F.col(RN) + 1).alias("pos"))
             .withColumn("m1", F.xxhash64("pos", "h1").cast("decimal(38,0)"))
             .withColumn("m2", F.xxhash64("h2", "pos").cast("decimal(38,0)")))
    upto = Window.partitionBy("conv_id", "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = s.save(mixed.withColumn("s1", F.sum("m1").over(upto)).withColumn("s2", F.sum("m2").over(upto)), f"{name}-local")
    zero = F.lit(0).cast("decimal(38,0)")
    totals = s.save(local.groupBy("conv_id", "run").agg(F.sum("m1").alias("t1"), F.sum("m2").alias("t2"))
                    .withColumn("b1", F.coalesce(F.sum("t1").over(before), zero))
                    .withColumn("b2", F.coalesce(F.sum("t2").over(before), zero)).drop("t1", "t2"), f"{name}-totals")
    return (local.alias("a").join(totals.alias("b"), same_run)
            .select(*[f"a.{c}" for c in key], "a.run", "a.pos",
                    (F.col("a.s1") + F.col("b.b1")).cast("decimal(38,0)").alias("p1"),
                    (F.col("a.s2") + F.col("b.b2")).cast("decimal(38,0)").alias("p2")))


def maximal(prefixes: DataFrame, s: Scratch) -> DataFrame:
    """(conv_id, n_turns) of the conversations that no other one extends; of equal ones the
    smallest conv_id. ``prefixes`` is a written table."""
    size = s.save(prefixes.groupBy("conv_id").agg(F.max("pos").alias("n_turns")), "sizes")
    ends = s.save(prefixes.alias("p").join(size.alias("z"), F.expr("p.conv_id <=> z.conv_id AND p.pos = z.n_turns"))
                  .groupBy("p.pos", "p.p1", "p.p2").agg(F.min("p.conv_id").alias("conv_id")), "ends")
    inner = s.save(prefixes.alias("p").join(size.alias("z"), F.expr("p.conv_id <=> z.conv_id AND p.pos < z.n_turns"))
                   .select("p.pos", "p.p1", "p.p2").distinct(), "inner")
    return ends.join(inner, ["pos", "p1", "p2"], "left_anti").select("conv_id", F.col("pos").alias("n_turns"))


def render(conversations: DataFrame, open_: str = OPEN, middle: str = MIDDLE, close: str = CLOSE) -> DataFrame:
    """One row per turn of each retained conversation: conv_id, n_turns, position, turn, role,
    start (characters of the conversation's text before it), segment."""
    s = Scratch(conversations.sparkSession, "chat")
    turns = turns_of(conversations)
    prefixes = s.save(prefix_hashes(turns, s, "p"), "prefixes")
    keep = s.save(maximal(prefixes, s), "keep")
    kept = s.save(prefixes.alias("p").join(keep.alias("k"), F.expr("p.conv_id <=> k.conv_id"))
                  .select("p.conv_id", "p.turn", "p.run", "p.role", "p.h1", "p.h2", "p.pos", "k.n_turns"), "kept")
    same = F.expr("t.conv_id <=> k.conv_id AND t.turn <=> k.turn AND t.role = k.role AND t.h1 = k.h1 AND t.h2 = k.h2")
    full = (turns.alias("t").join(kept.alias("k"), same)
            .select("k.conv_id", "k.n_turns", "k.pos", "k.turn", "k.run", "k.role",
                    F.concat(F.lit(open_), F.col("k.role"), F.lit(middle), F.col("t.text"), F.lit(close)).alias("segment"))
            .dropDuplicates(["conv_id", "pos"]))
    full = s.save(full.withColumn("size", F.length("segment").cast("long")), "full")
    inside = Window.partitionBy("conv_id", "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = s.save(full.groupBy("conv_id", "run").agg(F.sum("size").alias("t"))
                   .withColumn("base", F.coalesce(F.sum("t").over(before), F.lit(0))).drop("t"), "run-sizes")
    s.drop("p-distinct", "p-local", "p-totals", "inner", "ends", "sizes", "kept", "keep", "prefixes")
    return (full.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("a")
            .join(sizes.alias("b"), F.expr("a.conv_id <=> b.conv_id AND a.run = b.run"))
            .select("a.conv_id", "a.n_turns", F.col("a.pos").alias("position"), "a.turn", "a.role",
                    (F.col("a.within") + F.col("b.base")).alias("start"), "a.segment"))


def write_rendered(segments: DataFrame, path: str) -> None:
    """Segments as Parquet in conversation order: reading a file gives whole texts in a row."""
    segments.repartitionByRange("conv_id", "position").sortWithinPartitions("conv_id", "position").write.parquet(path)


def op1_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(table(spark, sf_dir, "conversations"))


SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT *, row_number() OVER w AS pos, list([role, text]) OVER w AS prefix FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
z AS (SELECT conv_id, max(pos) AS n FROM p GROUP BY 1),
e AS (SELECT min(p.conv_id) AS conv_id, p.prefix, p.pos AS n FROM p JOIN z ON p.conv_id IS NOT DISTINCT FROM z.conv_id AND p.pos = z.n GROUP BY ALL),
i AS (SELECT DISTINCT p.prefix FROM p JOIN z ON p.conv_id IS NOT DISTINCT FROM z.conv_id AND p.pos < z.n),
k AS (SELECT conv_id, n FROM e ANTI JOIN i USING (prefix)),
s AS (SELECT p.conv_id, k.n, p.pos, p.turn, p.role, '{OPEN}' || p.role || chr(10) || p.text || '<|im_end|>' || chr(10) AS segment
      FROM p JOIN k ON p.conv_id IS NOT DISTINCT FROM k.conv_id)
SELECT conv_id, n::BIGINT AS n_turns, pos::BIGINT AS position, turn, role, segment,
       coalesce(sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
FROM s
"""
