"""The reference's own unit cases, re-expressed on Spark frames."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barspark.operators import actions as ca
from barspark.operators import quality as dq
from barspark.operators import schema as sc
from barspark.sinks import audit as au


def test_contract_issues_missing_and_type(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 9, 15), "ABC", "1.0", 1.2, 100)],
        "timestamp timestamp, symbol string, open string, close double, volume bigint")
    issues = sc.compare(df, sc.contract("market_data"))
    assert {i.column for i in issues if i.kind == "missing"} == {"high", "low", "trade_count"}
    assert [i for i in issues if i.kind == "type"] == [sc.Issue("open", "type", "double", "string")]
    report = sc.issue_report(issues)
    assert set(report) == {"missing", "type"} and report["type"] == {"open": "double / string"}
    assert sc.issue_frame(spark, "d", issues).filter("kind = 'missing'").count() == 3
    with pytest.raises(ValueError, match="trade_count"):
        sc.check(df, sc.contract("market_data"))


def test_contract_issues_nulls_and_unexpected(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "symbol string, extra int")
    sc.set_contract("named", "symbol string!")
    assert sc.compare(df, sc.contract("named")) == [sc.Issue("extra", "unexpected", None, "int"), sc.Issue("symbol", "nulls", "0", "1")]
    sc.check(df.filter("symbol IS NOT NULL").drop("extra"), sc.contract("named"))


def test_conform_orders_and_casts(spark):
    cols = ["volume", "close", "symbol", "trade_count", "open", "timestamp", "low", "high"]
    df = spark.createDataFrame([("100", "1.5", "ABC", "7", "1.0", dt.datetime(2024, 1, 1), "0.9", "1.6")],
                               ", ".join(f"{c} {'timestamp' if c == 'timestamp' else 'string'}" for c in cols))
    out = sc.conform(df, sc.contract("market_data"))
    assert out.columns == sc.contract("market_data").names
    assert dict(out.dtypes)["open"] == "double" and dict(out.dtypes)["volume"] == "bigint"
    row = out.first()
    assert row.open == 1.0 and row.volume == 100
    with pytest.raises(ValueError, match="nulls"):
        sc.conform(df.withColumn("symbol", F.lit(None).cast("string")), sc.contract("market_data"))


def test_conform_refuses_structure(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "A")], "timestamp timestamp, symbol string")
    with pytest.raises(ValueError, match="missing"):
        sc.conform(df, sc.contract("market_data"))


def test_contract_names():
    sc.set_contract("tiny", T.StructType([T.StructField("x", T.LongType(), False)]))
    assert "tiny" in sc.CONTRACTS and not sc.contract("tiny")["x"].nullable
    with pytest.raises(KeyError):
        sc.contract("nope")


def test_required_and_default_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    sc.require_columns(df, ["a"])
    with pytest.raises(KeyError, match="'b'"):
        sc.require_columns(df, ["a", "b"], "Frame")
    out = sc.with_defaults(df, {"a": (9, T.IntegerType()), "ratio": (None, T.DoubleType()), "n": (2, T.LongType())})
    assert out.dtypes == [("a", "int"), ("ratio", "double"), ("n", "bigint")] and out.first() == (1, None, 2)


def test_gaps_one_gap_three_missing(spark):
    ts = [dt.datetime(2024, 1, 1, 9, 0), dt.datetime(2024, 1, 1, 9, 1), dt.datetime(2024, 1, 1, 9, 5), None]
    df = spark.createDataFrame([(t,) for t in ts], "timestamp timestamp_ntz")
    g = dq.detect_time_gaps(df, "timestamp", "1m").collect()
    assert len(g) == 1
    assert g[0].missing_intervals == 3
    assert g[0].start_timestamp == dt.datetime(2024, 1, 1, 9, 1)


def test_dedupe_keeps_last(spark):
    t = dt.datetime(2024, 1, 1, 9, 0)
    df = spark.createDataFrame([(t, "ABC", 1.0, 0), (t, "ABC", 1.5, 1)],
                               "timestamp timestamp_ntz, symbol string, close double, pos int")
    out = dq.collapse_duplicates(df, ["timestamp", "symbol"], order_by=["timestamp"], tie_break=["pos"]).collect()
    assert len(out) == 1 and out[0].close == 1.5
    s = dq.duplicate_summary(df, ["timestamp", "symbol"]).first()
    assert s.collapsed_count == 2 and s.removed_count == 1
    assert dq.collapse_duplicates(df, []).count() == 2


def test_mad_quarantines_250(spark):
    df = spark.createDataFrame([(100.0,), (101.0,), (99.5,), (250.0,)], "close double")
    clean, quarantined = dq.mad_outlier_quarantine(df, ["close"], 3.5)
    assert sorted(r.close for r in clean.collect()) == [99.5, 100.0, 101.0]
    assert [r.close for r in quarantined.collect()] == [250.0]
    c2, q2 = dq.mad_outlier_quarantine(df, [], 3.5)
    assert c2.count() == 4 and q2.count() == 0


def test_mad_text_column_and_zero_mad(spark):
    df = spark.createDataFrame([("1",), ("1",), ("x",), ("1",)], "v string")
    r = dq.mad_outliers(df, ["v", "absent"], 3.5)
    assert r.quarantined.count() == 0          # MAD 0 -> column skipped
    assert r.summary.count() == 0


def test_exact_median_even_count(spark):
    df = spark.createDataFrame([(float(x),) for x in [4, 1, 3, 2]], "v double")
    assert dq.column_median(df, "v").first().median == 2.5


def test_audit_event_nests_details(spark):
    details = spark.range(1).select(F.struct(F.lit(1).alias("value")).alias("details"))
    row = au.audit_event(details, "test_event", "app", "2024-01-01T00:00:00+00:00").first()
    payload = json.loads(row.json)
    assert payload["details"] == {"details": {"value": 1}}
    assert list(payload) == sorted(payload)


def test_factors_ratio2_dividend1_close10(spark):
    df = spark.createDataFrame([("ABC", dt.date(2024, 1, 1), 2.0, 1.0, 10.0)],
                               "symbol string, ex_date date, split_ratio double, cash_dividend double, close double")
    r = ca.compute_adjustment_factors(df).first()
    assert (r.split_factor, r.dividend_factor) == (0.5, 0.9)
    assert abs(r.adjustment_factor - 0.45) < 1e-12


def test_store_lookup_and_persist(spark, tmpdir_path):
    df = spark.createDataFrame([("ABC", dt.date(2024, 1, 1), 2.0, 1.0, 10.0)],
                               "symbol string, ex_date date, split_ratio double, cash_dividend double, close double")
    table = ca.actions_table([df])
    keys = spark.createDataFrame([("ABC", dt.date(2024, 1, 1)), ("ABC", dt.date(2024, 1, 2))],
                                 "symbol string, ex_date date")
    got = {r.ex_date: r.adjustment_factor for r in ca.lookup_factors(keys, table).collect()}
    assert abs(got[dt.date(2024, 1, 1)] - 0.45) < 1e-12 and got[dt.date(2024, 1, 2)] == 1.0
    ca.persist_actions(table, f"{tmpdir_path}/actions")
    assert spark.read.parquet(f"{tmpdir_path}/actions").count() == 1


def test_factor_null_rules(spark):
    rows = [("A", dt.date(2024, 1, 1), None, 1.0, 10.0), ("A", dt.date(2024, 1, 2), 0.0, None, 10.0),
            ("A", dt.date(2024, 1, 3), 2.0, 1.0, None), ("A", dt.date(2024, 1, 4), 2.0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "symbol string, ex_date date, split_ratio double, cash_dividend double, close double")
    frame = {r.ex_date.day: r for r in ca.compute_adjustment_factors(df).collect()}
    safe = {r.ex_date.day: r for r in ca.compute_adjustment_factors(df, null_safe=True).collect()}
    assert frame[1].split_factor is None and safe[1].split_factor == 1.0
    assert frame[2].dividend_factor is None and safe[2].dividend_factor == 1.0
    assert frame[3].dividend_factor == 1.0
    assert frame[4].dividend_factor == float("-inf") and safe[4].dividend_factor == 1.0
