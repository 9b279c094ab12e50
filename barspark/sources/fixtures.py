"""Stand-in datasets derived from the driver's TPC-H-style tables.

Each builder reads the parquet tables and derives, with ordinary DataFrame
operations, the inputs the market-data operators expect (see FIXTURES.md).
Every derivation is repeated independently in DuckDB SQL by ``barspark.oracle``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

N_STRATEGIES = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _unit_price():
    return F.col("l_extendedprice") / F.col("l_quantity")


def _order_key():
    return F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars: one per (supplier, ship date). Map-side partial
    aggregation; only the six lineitem columns used are read."""
    li = table(spark, sf_dir, "lineitem")
    p, k = _unit_price(), _order_key()
    return (li.groupBy(F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").alias("timestamp"))
              .agg(F.min_by(p, k).alias("open"),
                   F.max(p).alias("high"),
                   F.min(p).alias("low"),
                   F.max_by(p, k).alias("close"),
                   F.sum("l_quantity").cast("bigint").alias("volume"),
                   F.count(F.lit(1)).alias("trade_count")))


def market_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars in the golden ``market_data`` shape (string symbol, UTC instant)."""
    b = bars(spark, sf_dir)
    return b.select(F.col("timestamp").cast("timestamp").alias("timestamp"),
                    F.col("symbol").cast("string").alias("symbol"),
                    "open", "high", "low", "close", "volume", "trade_count")


def duplicated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem keyed by (l_orderkey, l_linenumber): repeated keys occur."""
    return table(spark, sf_dir, "lineitem")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def corporate_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One action per (supplier, ship date) from the greatest order key line."""
    li = table(spark, sf_dir, "lineitem")
    last = (li.groupBy("l_suppkey", "l_shipdate")
              .agg(F.max_by(F.struct("l_quantity", "l_tax", "l_extendedprice"), _order_key()).alias("r")))
    q = F.col("r.l_quantity")
    return last.select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("l_shipdate").cast("date").alias("ex_date"),
        F.when(q % 5 == 0, F.lit(None).cast("double"))
         .when(q % 5 == 1, F.lit(0.0)).otherwise(F.lit(2.0)).alias("split_ratio"),
        F.when(q % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("r.l_tax") * 10).alias("cash_dividend"),
        (F.col("r.l_extendedprice") / q).alias("close"))


def symbol_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing intervals per supplier; open-ended for every third symbol."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    k = F.col("s_suppkey")
    start = F.date_add(F.lit("1995-01-01").cast("date"), (k * 97 % 700).cast("int"))
    end = F.when(k % 3 == 0, F.lit(None).cast("date")).otherwise(
        F.date_sub(F.lit("2001-12-31").cast("date"), (k * 131 % 900).cast("int")))
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left")
             .select(k.alias("symbol"), F.col("s_name").alias("name"),
                     F.col("n_name").alias("exchange"), F.col("n_regionkey").alias("region"),
                     start.cast("timestamp_ntz").alias("start_date"),
                     end.cast("timestamp_ntz").alias("end_date")))


def index_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index = region of the supplier's nation; membership starts later and
    ends earlier than the listing by (s_suppkey % 200) days."""
    m = symbol_master(spark, sf_dir)
    d = (F.col("symbol") % 200).cast("int")
    return m.select(F.concat(F.lit("IDX"), F.col("region").cast("string")).alias("index"),
                    "symbol",
                    (F.lit(1.0) / (F.col("symbol") % 10 + 1)).alias("weight"),
                    F.date_add(F.col("start_date").cast("date"), d).cast("timestamp_ntz").alias("start_date"),
                    F.date_sub(F.col("end_date").cast("date"), d).cast("timestamp_ntz").alias("end_date"))


def signal_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last bar day of every month."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.date_trunc("month", "l_shipdate").alias("month"))
              .agg(F.max("l_shipdate").alias("timestamp")))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target weights at every signal time for each symbol that traded in that
    month. Strategy = symbol % 3; weight in [-1, 1] divided by the number of
    symbols of the strategy, so a strategy's gross weight never exceeds 1."""
    li = table(spark, sf_dir, "lineitem")
    active = (li.select(F.col("l_suppkey").alias("symbol"),
                        F.date_trunc("month", "l_shipdate").alias("month")).distinct()
                .withColumn("strategy", (F.col("symbol") % N_STRATEGIES).cast("int")))
    counts = (table(spark, sf_dir, "supplier")
              .groupBy((F.col("s_suppkey") % N_STRATEGIES).cast("int").alias("strategy"))
              .agg(F.count(F.lit(1)).alias("n_sym")))
    t = signal_times(spark, sf_dir)
    m = (F.year("month") * 12 + F.month("month")).cast("long")
    raw = ((F.col("symbol") * 31 + m * 17) % 21 - 10) / 10.0
    return (active.join(F.broadcast(counts), "strategy")
                  .join(t, "month")
                  .select("strategy", "timestamp", "symbol",
                          (raw / F.col("n_sym")).alias("target_weight")))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion-run ledger stand-in: one completed run per odd order key."""
    o = table(spark, sf_dir, "orders")
    return (o.where(F.col("o_orderkey") % 2 == 1)
             .select(F.col("o_orderkey").alias("id"),
                     F.concat(F.lit("landing/"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("source_path"),
                     F.concat(F.lit("clean/"), F.col("o_orderkey").cast("string"), F.lit(".parquet")).alias("destination_path"),
                     F.sha2(F.col("o_orderkey").cast("string"), 256).alias("source_hash"),
                     F.col("o_custkey").alias("row_count"),
                     F.lit("completed").alias("status"),
                     F.col("o_orderdate").alias("created_at"),
                     F.col("o_orderdate").alias("completed_at")))


def landing_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of candidate source files: every even order key is new, every
    odd one was ingested before (present in ``ledger``)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("landing/"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("source_path"),
                    F.sha2(F.col("o_orderkey").cast("string"), 256).alias("source_hash"),
                    F.col("o_custkey").alias("row_count"),
                    (F.col("o_orderdate") + F.expr("INTERVAL 3650 DAYS")).alias("created_at"))
