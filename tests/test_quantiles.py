"""Exact quantiles: one path at every size, against sorted Python lists."""
import inspect
import math
import random

import pytest
from pyspark.sql import functions as F

from barspark.operators import stats
from barspark.operators.quality import column_mad

INF = math.inf


def quantile(values, q):
    xs = sorted(v for v in values if v is not None and not math.isnan(v))
    if not xs:
        return None
    pos = q * (len(xs) - 1)
    a, b = xs[math.floor(pos)], xs[math.ceil(pos)]
    frac = pos - math.floor(pos)
    return a if a == b else (1 - frac) * a + frac * b


CASES = {
    "one": [3.5],
    "two": [1.0, 2.0],
    "nothing": [None, math.nan],
    "ties": [7.0] * 50 + [1.0, 9.0],
    "ties across the middle": [1.0] * 4 + [2.0] * 4,
    "zeros": [0.0, -0.0, 0.0, -1.0, 1.0],
    "infinities": [-INF, -INF, 1.0, INF, INF],
    "more infinities than values": [INF] * 5 + [1.0],
    "opposite signs": [-1e300, -5e-324, 5e-324, 1e300],
    "neighbours": [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), 1.0],
    "all scales": [s * 2.0 ** e for e in range(-1074, 1024, 7) for s in (-1, 1)],
    "powers of two": [2.0 ** e for e in range(-20, 21)],
}


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_groups_of_every_shape(spark, q):
    rows = [(name, v) for name, values in CASES.items() for v in values] + [(None, 4.0), (None, 6.0)]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "name string, v double")
    got = {r.name: r.x for r in stats.exact_quantile(df, "v", q, by=["name"], alias="x").collect()}
    want = {name: quantile(values, q) for name, values in CASES.items() if name != "nothing"} | {None: quantile([4.0, 6.0], q)}
    assert got == pytest.approx(want, rel=1e-15, abs=0)


@pytest.mark.parametrize("name", ["one", "nothing", "ties", "infinities", "neighbours", "all scales"])
def test_without_groups_there_is_one_row(spark, name):
    df = spark.createDataFrame([(v,) for v in CASES[name]], "v double")
    rows = stats.exact_quantile(df, "v", 0.5, alias="x").collect()
    assert [r.x for r in rows] == [quantile(CASES[name], 0.5)]


def test_opposite_infinities_have_no_middle(spark):
    df = spark.createDataFrame([(-INF,), (INF,)], "v double")
    assert math.isnan(stats.exact_quantile(df, "v").first()[0])


def test_a_million_rows_equal_the_builtin(spark):
    """Smooth, heavy-tailed, whole-number and single-cell values; a group with most of the rows."""
    u = F.rand(11)
    df = (spark.range(0, 1_000_000, 1, 4)
          .select(F.when(u < 0.7, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 9).cast("string"))).alias("k"),
                  F.randn(3).alias("smooth"), F.exp(F.randn(4) * 20).alias("heavy"),
                  F.floor(F.rand(5) * 5).cast("double").alias("whole"), (1 + F.rand(6) * 1e-5).alias("narrow")).persist())
    try:
        for column, q in (("smooth", 0.5), ("heavy", 0.937), ("whole", 0.5), ("narrow", 0.5)):
            want = {r.k: r.x for r in df.groupBy("k").agg(F.percentile(column, F.lit(q)).alias("x")).collect()}
            got = {r.k: r.x for r in stats.exact_quantile(df, column, q, by=["k"], alias="x").collect()}
            assert got == pytest.approx(want, rel=1e-14), (column, q)
    finally:
        df.unpersist()


def test_one_path(spark):
    """No parameter or constant that another way would depend on; the rows that are shuffled are counts."""
    assert list(inspect.signature(stats.exact_quantile).parameters) == ["df", "value", "q", "by", "alias"]
    assert not [n for n in vars(stats) if "LIMIT" in n]


def test_mad_keeps_the_group_of_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 1.0), ("a", 1.0), ("a", 5.0)], "k string, v double")
    got = {r.k: (r.median, r.mad) for r in column_mad(df, "v", ["k"]).collect()}
    assert got == {None: (2.0, 1.0), "a": (1.0, 0.0)}
