"""Dyadic interval joins against plain comparison."""
import datetime as dt
import random

from pyspark.sql import functions as F

from barspark.operators import intervals as iv
from barspark.operators import universe as uv


def test_points_meet_every_interval_that_holds_them_once(spark):
    r = random.Random(1)
    ranges = [(i, lo, lo + r.choice([-1, 0, 1, 2, 7, 30, 365, 14_600])) for i, lo in
              enumerate(r.randint(-20_000, 20_000) for _ in range(150))] + [(900, None, 5), (901, 5, None)]
    points = [(p, r.randint(-25_000, 40_000)) for p in range(300)] + [(900, ranges[0][1]), (901, None)]
    got = iv.join_points(spark.createDataFrame(points, "p int, x long"), F.col("x"),
                         spark.createDataFrame(ranges, "i int, lo long, hi long"), F.col("lo"), F.col("hi"))
    pairs = sorted((x.p, x.i) for x in got.collect())
    assert pairs == sorted((p, i) for p, x in points for i, lo, hi in ranges if None not in (x, lo, hi) and lo <= x <= hi)
    assert len(set(pairs)) == len(pairs) > 300
    none = spark.createDataFrame([], "i int, lo long, hi long")
    assert iv.join_points(spark.createDataFrame(points, "p int, x long"), F.col("x"), none, F.col("lo"), F.col("hi")).count() == 0


def test_forty_years_of_days_are_few_segments(spark):
    cut = (spark.range(5000).select(F.size(iv.segments(F.col("id") * 3 - 7000, F.col("id") * 3 - 7000 + 40 * 366)).alias("n"),
                                    F.size(iv.segments(F.col("id"), F.lit(uv.LAST_DAY))).alias("open")))
    most = cut.agg(F.max("n"), F.max("open")).first()
    assert most[0] < 30 and most[1] < 64


def test_days_before_the_epoch_and_far_ahead(spark):
    days = [dt.datetime(1969, 12, 31, 23, 59), dt.datetime(1970, 1, 1), dt.datetime(1901, 1, 1, 0, 0, 1), dt.datetime(9999, 12, 31, 23, 59, 59)]
    got = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz").select(iv.day_of("t")).collect()
    assert [r[0] for r in got] == [(d - dt.datetime(1970, 1, 1)).days for d in days] and got[3][0] == uv.LAST_DAY


def test_universe_at_with_open_and_long_listings(spark):
    master = [("a", dt.datetime(1960, 1, 1), None), ("b", dt.datetime(1990, 5, 1), dt.datetime(2024, 3, 1, 12)),
              ("c", dt.datetime(2024, 3, 1, 13), dt.datetime(2024, 3, 1, 13)), ("d", None, None), ("e", dt.datetime(2030, 1, 1), None)]
    at = [dt.datetime(2024, 3, 1, h) for h in (11, 12, 13, 14)] + [dt.datetime(1959, 12, 31)]
    got = uv.universe_at(spark.createDataFrame(master, "symbol string, start_date timestamp_ntz, end_date timestamp_ntz"),
                         spark.createDataFrame([(t,) for t in at], "timestamp timestamp_ntz"))
    assert {(r.timestamp, r.symbol) for r in got.collect()} == {
        (t, s) for t in at for s, lo, hi in master if lo and lo <= t and (hi is None or t <= hi)}
