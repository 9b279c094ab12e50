"""Work that grows with the input: how often it is read, and into how many tasks it goes."""
import datetime

import pandas as pd
from pyspark.sql import functions as F

from barspark.operators import features as feat
from barspark.operators import rewards as rw
from barspark.operators import sequence as sq
from barspark.operators import validation as va
from barspark.operators import schema as sc
from barspark.plans import ingest as ig
from barspark.plans.catalog import QUERIES
from barspark.plans.config import DEFAULT_CONFIG
from barspark.sinks import ledger as lg


def rows_of(spark, keys=20, n=50):
    return spark.range(keys * n).select((F.col("id") % keys).alias("symbol"), F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(id)").alias("timestamp"),
                                        (F.col("id") % 7 + 1).cast("double").alias("close"), (F.col("id") % 5 + 1).alias("volume"))


def test_tasks_of_a_sequence_follow_its_rows(spark, monkeypatch):
    monkeypatch.setattr(sq, "PART_ROWS", 50)
    df = rows_of(spark)
    assert sq.index_sequence(df, ["symbol"], "timestamp").frame.rdd.getNumPartitions() == 20
    cut = sq.index_sequence(df, ["symbol"], "timestamp", target_rows=20)
    assert cut.frame.rdd.getNumPartitions() == 20
    assert sq.with_halo(cut, 3).rdd.getNumPartitions() == 20
    out, _, _ = feat.engineer_features(df, DEFAULT_CONFIG["feature_sets"]["macro_augmented"]["features"], size=sq.Size(50, 1000))
    assert out.rdd.getNumPartitions() == 20     # one shuffle for all windows, the EMA's too


def test_a_known_size_spares_the_count(spark):
    seen = spark.sparkContext.accumulator(0)

    def each(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    df = rows_of(spark).mapInPandas(each, rows_of(spark).schema)
    known = sq.index_sequence(df, ["symbol"], "timestamp", size=sq.Size(50, 1000))
    assert known.frame.toPandas()[sq.RN].value_counts().eq(20).all() and seen.value == 1000
    # a bound above the target doesn't decide: the rows are counted
    assert sq.index_sequence(df, ["symbol"], "timestamp", size=sq.Size(2_000_000, 3_000_000)).single and seen.value == 2000


def test_equal_rolling_windows_are_computed_once(spark):
    out, _, _ = feat.engineer_features(rows_of(spark), DEFAULT_CONFIG["feature_sets"]["basic_price"]["features"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("stddev_samp(") == 2     # of close and of volume


def test_policy_and_episode_queries_make_the_bars_once(spark, sf):
    for name in ("feature_frame", "feat_ema", "action_policy", "discounted_reward", "episode_rows", "cv_metrics", "cv_linear"):
        assert not [f for f in QUERIES[name](spark, sf).inputFiles() if "lineitem" in f], name


def test_episode_rows_in_blocks(spark):
    rows = spark.range(300).select((F.col("id") % 3).alias("symbol"), F.floor(F.col("id") / 3).alias(sq.RN), F.col("id").alias("x"))
    starts = spark.createDataFrame([(0, 0, 0), (0, 1, 63), (0, 2, 90), (1, 0, 7), (1, 1, 7), (2, 0, 5)], "symbol long, episode int, start long")
    got = rw.episode_rows(rows, starts, 10).toPandas()
    want = {(s, e, i, 3 * (a + i) + s) for s, e, a in [(0, 0, 0), (0, 1, 63), (0, 2, 90), (1, 0, 7), (1, 1, 7), (2, 0, 5)] for i in range(10)}
    assert len(got) == 60 and set(got[["symbol", "episode", "step", "x"]].itertuples(index=False, name=None)) == want


def test_previous_values_of_cut_keys(spark):
    df = rows_of(spark, keys=2, n=100)
    plain, cut = (rw.indexed_rows(df, target_rows=t, previous={"close": "prev"})[0].toPandas().sort_values(["symbol", sq.RN], ignore_index=True)
                  for t in (1000, 15))
    pd.testing.assert_frame_equal(plain, cut[plain.columns], check_dtype=False)
    assert plain.groupby("symbol").prev.first().eq(0).all()
    assert (plain.prev.to_numpy()[1:100] == plain.close.to_numpy()[:99]).all()


def test_trained_folds_by_instants(spark):
    day = datetime.datetime(2020, 1, 1)
    df = spark.createDataFrame([(day + datetime.timedelta(days=d), 0.1 * d, 0.2 * d) for d in [*range(40, 90), *range(40, 90), 95]], "timestamp timestamp_ntz, y double, p double")
    folds = va.generate_folds(spark.createDataFrame([(day,), (day + datetime.timedelta(days=100),)], "timestamp timestamp_ntz"),
                              {"name": "w", "training_days": 30, "validation_days": 10, "step_days": 10})
    tagged = va.fold_rows(df, folds)
    trained = va.trained_folds(df, folds)
    assert trained.count() == tagged.where("role = 'train'").select("window", "fold").distinct().count() < folds.count()
    one, two = (m.toPandas().sort_values("key", ignore_index=True) for m in (va.cv_metrics_from_folds(tagged, "y", "p"), va.cv_metrics_from_folds(tagged, "y", "p", trained)))
    pd.testing.assert_frame_equal(one, two)


def test_upsert_reads_its_batch_once(spark):
    seen = spark.sparkContext.accumulator(0)
    at = "timestamp_ntz'2024-01-01'"
    ledger = spark.range(1, 6).selectExpr("id", "concat('p', id) source_path", "'old' destination_path", "concat('h', id) source_hash",
                                          "id row_count", "'completed' status", f"{at} created_at", f"{at} completed_at")
    runs = spark.range(4, 13).selectExpr("concat('q', id) source_path", "'new' destination_path", "concat('h', id % 10) source_hash", "id row_count",
                                         "'completed' status", f"{at} created_at", f"{at} + make_dt_interval(id) completed_at")

    def each(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    out = lg.upsert(ledger, runs.mapInPandas(each, runs.schema)).toPandas().set_index("source_hash")
    assert seen.value == 9
    assert out["id"].to_dict() == {"h1": 1, "h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6, "h7": 7, "h8": 8, "h9": 9, "h0": 10}
    assert out.loc["h2", ["source_path", "row_count"]].tolist() == ["p2", 12]       # the later of two runs


def test_ingest_converts_each_text_once(spark):
    names = sc.contract("market_data").names
    text = spark.createDataFrame([("2024-01-01 09:15:00", "A", *["1.5"] * 4, "1", "x"), ("2024-01-01 09:15:00+0530", "A", *["2.5"] * 4, "2", "3")],
                                 ", ".join(f"{c} string" for c in ("timestamp", "symbol", "open", "high", "low", "close", "volume", "trade_count")))
    cfg = ig.IngestConfig(source=[], destination="", run_id="t")
    typed = ig.typed_rows(text.withColumn(ig.SRC, F.lit("f")), cfg)
    assert typed._jdf.queryExecution().optimizedPlan().toString().count("to_utc_timestamp(") == 1
    assert typed.columns == [*names, ig.BAD, ig.SRC]
    rows = typed.orderBy("close").collect()
    assert [r[ig.BAD] for r in rows] == [["trade_count"], []] and rows[0]["timestamp"] == rows[1]["timestamp"]
    kept = ig.keep_last(typed.withColumn(ig.POS, F.col("volume")), cfg).collect()
    assert len(kept) == 1 and kept[0]["close"] == 2.5 and kept[0][ig.TIMES] == 2
