"""Ingest job on CSV landing files written from the driver's tables."""
import datetime as dt
import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from barspark.plans import ingest as ig
from barspark.sinks import ledger as lg
from barspark.sources import fixtures as fx
from barspark.sources import io as sio
from barspark.operators import schema as sc
from barspark.session import Scratch
from barspark.streaming.landing import start_ingest_stream


def _landing(spark, sf, root, n_files=2):
    """bars as landing CSVs: local wall-time text, one duplicate row per file
    (a later correction), split by symbol parity into files."""
    md = fx.market_data(spark, sf).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    corr = md.limit(3).withColumn("close", F.col("close") + 1)
    full = md.unionByName(corr)
    paths = []
    for i in range(n_files):
        part = full.where(F.col("symbol").cast("int") % n_files == i).orderBy("symbol", "timestamp")
        d = f"{root}/tmp{i}"
        part.coalesce(1).write.option("header", True).csv(d)
        src = glob.glob(f"{d}/part-*.csv")[0]
        dst = f"{root}/landing/file{i}.csv"
        os.makedirs(os.path.dirname(dst), exist_ok=True)
        with open(src, "rb") as a, open(dst, "wb") as b:
            b.write(a.read())
        paths.append(dst)
    return paths


def test_ingest_end_to_end(spark, sf, tmpdir_path):
    paths = _landing(spark, sf, tmpdir_path)
    cfg = ig.IngestConfig(source=f"{tmpdir_path}/landing/*.csv", destination=f"{tmpdir_path}/clean",
                          run_id="r1", expected_frequency="1d",
                          ledger_path=f"{tmpdir_path}/ledger", quarantine_path=f"{tmpdir_path}/quarantine",
                          audit_path=f"{tmpdir_path}/audit")
    rep = ig.ingest(spark, cfg)
    assert rep.files == 2 and rep.skipped == 0
    assert rep.rows_in == fx.market_data(spark, sf).count() + 3
    clean = spark.read.parquet(cfg.destination)
    assert clean.count() == rep.rows_out and rep.rows_out + rep.quarantined == rep.rows_in - 3
    # the dedupe kept the later correction (last in file order)
    assert clean.groupBy("symbol", "timestamp").count().where("count > 1").count() == 0
    # UTC: local midnight is 18:30 the day before
    assert clean.select(F.hour("timestamp").alias("h")).distinct().collect()[0].h in (18,)
    ledger = spark.read.parquet(cfg.ledger_path)
    assert ledger.count() == 2 and ledger.select("id").distinct().count() == 2
    events = [json.loads(line) for p in glob.glob(f"{cfg.audit_path}/part-*") for line in open(p)]
    names = {e["event"] for e in events}
    assert {"ingestion_started", "time_gaps_detected", "duplicates_collapsed", "ingestion_completed",
            "ingestion_metadata_recorded", "data_quality_alert"} <= names
    # second run: both files already recorded -> skipped, nothing rewritten
    rep2 = ig.ingest(spark, ig.IngestConfig(**{**cfg.__dict__, "run_id": "r2"}))
    assert rep2.files == 0 and rep2.skipped == 2
    assert spark.read.parquet(cfg.ledger_path).count() == 2


HEAD = "timestamp,symbol,open,high,low,close,volume,trade_count\n"


def _file(root, name, body, head=HEAD):
    os.makedirs(f"{root}/land", exist_ok=True)
    with open(f"{root}/land/{name}", "w") as f:
        f.write(head + body)


def _rows(n, symbol="A", price=1.0):
    return "".join(f"2024-01-01 09:{i:02d}:00,{symbol},1,2,0.5,{price},10,3\n" for i in range(n))


def _cfg(root, run, **more):
    return ig.IngestConfig(source=f"{root}/land/*.csv", destination=f"{root}/out", run_id=run, ledger_path=f"{root}/ledger",
                           quarantine_path=f"{root}/q", audit_path=f"{root}/audit", **more)


def _events(root):
    return [json.loads(line) for p in glob.glob(f"{root}/audit/part-*") for line in open(p)]


def test_a_bad_file_fails_alone(spark, tmpdir_path):
    _file(tmpdir_path, "good.csv", _rows(5))
    _file(tmpdir_path, "text.csv", _rows(3, "B") + "2024-01-01 10:00:00,B,1,2,0.5,oops,10,3\n")
    _file(tmpdir_path, "header.csv", "2024-01-01 09:15:00,A,1.0\n", "timestamp,symbol,close\n")
    _file(tmpdir_path, "nameless.csv", "2024-01-01 09:15:00,,1,2,0.5,1,10,3\n")
    _file(tmpdir_path, "turned.csv", "3,2024-01-01 09:15:00,C,1,2,0.5,7.5,10\n",
          "trade_count,timestamp,symbol,open,high,low,close,volume\n")
    with pytest.raises(ig.RejectedFiles, match="3 file"):
        ig.ingest(spark, _cfg(tmpdir_path, "r1"))
    out = spark.read.parquet(f"{tmpdir_path}/out")
    assert out.count() == 6 and out.filter("symbol = 'C'").first().close == 7.5
    assert {os.path.basename(r.source_path) for r in spark.read.parquet(f"{tmpdir_path}/ledger").collect()} == {"good.csv", "turned.csv"}
    failed = [e for e in _events(tmpdir_path) if e["event"] == "schema_validation_failed"]
    assert {os.path.basename(e["details"]["source"]) for e in failed} == {"text.csv", "header.csv", "nameless.csv"}
    rep = ig.ingest(spark, _cfg(tmpdir_path, "r2", raise_on_rejected=False))
    assert (rep.files, rep.skipped, rep.rejected) == (0, 2, 3)


def test_identical_files_are_ingested_once(spark, tmpdir_path):
    for name in ("a.csv", "b.csv"):
        _file(tmpdir_path, name, _rows(8))
    rep = ig.ingest(spark, _cfg(tmpdir_path, "r1"))
    assert (rep.files, rep.repeated, rep.rows_out) == (1, 1, 8)
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == 8
    assert spark.read.parquet(f"{tmpdir_path}/ledger").count() == 1


def test_a_damaged_ledger_is_not_a_new_one(spark, tmpdir_path):
    _file(tmpdir_path, "a.csv", _rows(4))
    ig.ingest(spark, _cfg(tmpdir_path, "r1"))
    part = glob.glob(f"{tmpdir_path}/ledger/commit-*.parquet")[0]
    crc = os.path.join(os.path.dirname(part), "." + os.path.basename(part) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    with open(part, "wb") as f:
        f.write(b"damaged")
    _file(tmpdir_path, "b.csv", _rows(4, "B"))
    with pytest.raises(Exception):
        ig.ingest(spark, _cfg(tmpdir_path, "r2"))
    assert [os.path.basename(p) for p in glob.glob(f"{tmpdir_path}/ledger/commit-*.parquet")] == [os.path.basename(part)]
    assert "ingestion_failed" in {e["event"] for e in _events(tmpdir_path)}


def test_hashes_of_files_of_every_shape(spark, tmpdir_path):
    import gzip
    import hashlib
    import random
    from urllib.parse import unquote
    r, mark = random.Random(3), b"\xef\xbb\xbf"
    files = {"empty.csv": b"", "mark.csv": mark, "feed.csv": b"\n", "feeds.csv": b"\n\n\n", "marked_feed.csv": mark + b"\n",
             "marked.csv": mark + b"a,b\n1,2", "marked_end.csv": mark + b"a,b\n1,2\n", "two_marks.csv": mark * 2 + b"x",
             "open.csv": b"a,b\n1,2", "crlf.csv": b"a,b\r\n1,2\r\n", "cr.csv": b"a\rb\r", "bytes.csv": bytes(range(256)) * 9,
             "long.csv": b"h" * 100_000 + b"\nx\n", "one_line.csv": b"z" * 3_000_000, "odd [n] {a}.csv": b"odd\n" * 7,
             "rows.csv": b"".join(b"%d,%s\n" % (i, b"v" * r.randrange(60)) for i in range(60_000)),
             "noise.csv": r.randbytes(2_000_000), "packed.csv.gz": gzip.compress(b"a,b\n1,2\n")}
    os.makedirs(f"{tmpdir_path}/shapes")
    for name, content in files.items():
        with open(f"{tmpdir_path}/shapes/{name}", "wb") as f:
            f.write(content)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("100000", split):          # many splits a file, and one
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {unquote(os.path.basename(x.path)): x for x in sio.landing_files(spark, f"{tmpdir_path}/shapes").collect()}
            assert "empty.csv" not in got
            assert {n: (x.length, x.source_hash) for n, x in got.items()} == {
                n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in files.items() if c}
            assert {n: x.header for n, x in got.items() if "packed" not in n} == {
                n: c.split(b"\n")[0].decode("utf-8", "replace") for n, c in files.items() if c and "packed" not in n}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_file_issues(spark, tmpdir_path):
    _file(tmpdir_path, "a.csv", _rows(2))
    issues = sio.file_issues(spark, f"{tmpdir_path}/land/a.csv", sc.contract("market_data"))
    assert {i.column for i in issues} == {"open", "high", "volume", "trade_count"} and {i.kind for i in issues} == {"type"}
    spark.range(1).write.parquet(f"{tmpdir_path}/p.parquet")
    assert len(sio.file_issues(spark, f"{tmpdir_path}/p.parquet", sc.contract("market_data"))) == 9
    with pytest.raises(ValueError, match="json"):
        sio.file_issues(spark, "x.json", sc.contract("market_data"))


def test_source_hash_matches_hashlib(spark, tmpdir_path):
    import hashlib
    p = f"{tmpdir_path}/h.txt"
    with open(p, "wb") as f:
        f.write(b"abc" * 1000)
    got = sio.source_hashes(spark, p).first().source_hash
    assert got == hashlib.sha256(b"abc" * 1000).hexdigest()


def test_ledger_upsert_semantics(spark):
    old = spark.createDataFrame(
        [(1, "a.csv", "d1", "h1", 10, "completed", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
        "id long, source_path string, destination_path string, source_hash string, row_count long, "
        "status string, created_at timestamp_ntz, completed_at timestamp_ntz")
    runs = spark.createDataFrame(
        [("b.csv", "d2", "h1", 11, "completed", dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1)),
         ("c.csv", "d3", "h2", 5, "completed", dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1))],
        "source_path string, destination_path string, source_hash string, row_count long, "
        "status string, created_at timestamp_ntz, completed_at timestamp_ntz")
    got = {r.source_hash: r for r in lg.upsert(old, runs).collect()}
    assert got["h1"].id == 1 and got["h1"].source_path == "a.csv" and got["h1"].row_count == 11
    assert got["h1"].created_at == dt.datetime(2024, 1, 1) and got["h1"].completed_at == dt.datetime(2024, 2, 1)
    assert got["h2"].id == 2
    twice = runs.union(runs.withColumn("row_count", F.col("row_count") + 1).withColumn("completed_at", F.lit(dt.datetime(2024, 3, 1))))
    again = {r.source_hash: r for r in lg.upsert(old, twice).collect()}
    assert len(again) == 2 and again["h2"].row_count == 6 and lg.upsert(old, twice).count() == 2
    log = old.unionByName(lg.numbered(lg.one_per_hash(twice), old))
    now = {r.source_hash: r for r in lg.current(log).collect()}
    assert now["h1"].id == 1 and now["h1"].row_count == 12 and now["h1"].source_path == "a.csv"
    assert lg.new_files(runs, old).count() == 1


def test_zstd_level_is_honoured(spark, sf, tmpdir_path):
    from barspark.sinks.files import write_parquet_zstd
    df = fx.duplicated_lines(spark, sf).coalesce(1)
    write_parquet_zstd(df, f"{tmpdir_path}/z1", 1)
    write_parquet_zstd(df, f"{tmpdir_path}/z19", 19)
    size = lambda d: sum(os.path.getsize(p) for p in glob.glob(f"{d}/*.parquet"))
    assert size(f"{tmpdir_path}/z19") < size(f"{tmpdir_path}/z1")


def test_streaming_landing(spark, tmpdir_path):
    def run():
        start_ingest_stream(spark, f"{tmpdir_path}/land", _cfg(tmpdir_path, "s", raise_on_rejected=False),
                            checkpoint_location=f"{tmpdir_path}/ckpt").awaitTermination(300)
        return spark.read.parquet(f"{tmpdir_path}/out").count()
    _file(tmpdir_path, "a.csv", _rows(6))
    _file(tmpdir_path, "bad.csv", "2024-01-01 09:00:00,B,oops,2,0.5,abc,10,3\n")
    assert run() == 6 and run() == 6
    _file(tmpdir_path, "same.csv", _rows(6))          # known content under a new name
    _file(tmpdir_path, "c.csv", _rows(2, "C"))
    assert run() == 8


def test_a_batch_hashes_only_its_own_files(spark, tmpdir_path, monkeypatch):
    hashed, real = [], ig.landing_files
    monkeypatch.setattr(ig, "landing_files", lambda spark, source: hashed.append(sorted(map(os.path.basename, source))) or real(spark, source))

    def run():
        start_ingest_stream(spark, f"{tmpdir_path}/land", _cfg(tmpdir_path, "s"), checkpoint_location=f"{tmpdir_path}/ckpt",
                            max_files=2).awaitTermination(300)
    for k in range(3):
        _file(tmpdir_path, f"a{k}.csv", _rows(4, f"S{k}"))
    run()
    assert sorted(len(b) for b in hashed) == [1, 2] and sorted(sum(hashed, [])) == ["a0.csv", "a1.csv", "a2.csv"]
    _file(tmpdir_path, "[odd] {name}*.csv", _rows(3, "T"))
    run()
    assert [n.replace("\\", "") for n in hashed[2]] == ["[odd] {name}*.csv"] and len(hashed) == 3
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == 15


def _outlier_file(root, name, symbol):
    """60 rows around 101 and one of 9000."""
    _file(root, name, f"2024-01-01 08:00:00,{symbol},1,2,0.5,9000,10,3\n"
          + "".join(f"2024-01-01 11:{i:02d}:00,{symbol},1,2,0.5,{100 + i % 3},10,3\n" for i in range(60)))


@pytest.mark.parametrize("step", ["write_parquet_zstd", "write_quarantine", "append", "event"])
def test_a_run_that_fails_after_a_step_leaves_nothing_twice(spark, tmpdir_path, monkeypatch, step):
    _outlier_file(tmpdir_path, "a.csv", "A")
    ig.ingest(spark, _cfg(tmpdir_path, "r0"))
    _outlier_file(tmpdir_path, "b.csv", "B")
    home = lg if step == "append" else ig.au if step == "event" else ig
    name = "append_json" if step == "event" else step
    real, calls = getattr(home, name), []

    def breaks(*args, **kw):
        out = real(*args, **kw)
        calls.append(1)
        if step != "event" or "mad_outliers_persisted" in str(args[0].select("event").first()):
            raise OSError("lost")
        return out
    with monkeypatch.context() as m:
        m.setattr(home, name, breaks)
        with pytest.raises(OSError):
            ig.ingest(spark, _cfg(tmpdir_path, "r1"))
    assert calls
    committed = step in ("append", "event")
    state = lg.read(spark, f"{tmpdir_path}/ledger")
    assert state.count() == 1 + committed
    assert lg.published(spark.read.parquet(f"{tmpdir_path}/out"), state).count() == 60 * (1 + committed)
    rep = ig.ingest(spark, _cfg(tmpdir_path, "r2"))
    assert rep.files == (not committed)
    state = lg.read(spark, f"{tmpdir_path}/ledger")
    assert sorted(r.id for r in state.collect()) == [1, 2]
    for path, n in (("out", 120), ("q", 2)):
        data = spark.read.parquet(f"{tmpdir_path}/{path}")
        assert data.count() == n == lg.published(data, state).count()
    assert spark.read.parquet(f"{tmpdir_path}/q").groupBy("source_hash").count().where("count > 1").count() == 0


def test_every_run_leaves_its_metrics(spark, tmpdir_path, monkeypatch):
    _file(tmpdir_path, "a.csv", _rows(9))
    ig.ingest(spark, _cfg(tmpdir_path, "r1", runs_path=f"{tmpdir_path}/runs"))
    _file(tmpdir_path, "b.csv", _rows(5, "B"))
    with monkeypatch.context() as m:
        m.setattr(lg, "append", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ig.ingest(spark, _cfg(tmpdir_path, "r2", runs_path=f"{tmpdir_path}/runs"))
    runs = {r.run_name: r.metrics for r in spark.read.parquet(f"{tmpdir_path}/runs").collect()}
    assert runs["r1"]["rows_in"] == runs["r1"]["rows_written"] == runs["r1"]["rows_out"] == 9
    assert runs["r1"]["failures"] == 0 and abs(runs["r1"]["last_success"] - time.time()) < 600
    assert runs["r2"]["failures"] == 1 and "last_success" not in runs["r2"] and runs["r2"]["rows_written"] == 5
    assert runs["r1"]["duration_s"] > 0 and runs["r1"]["seconds_clean_write"] > 0


def test_concurrent_commits_have_distinct_ids(spark, tmpdir_path):
    from concurrent.futures import ThreadPoolExecutor

    def runs(k):
        rows = [(f"{k}-{i}.csv", "d", f"h{k}-{i}" if i else "shared", i, "completed", dt.datetime(2024, 1, 1 + k), dt.datetime(2024, 1, 1 + k))
                for i in range(4)]
        return spark.createDataFrame(rows, lg.LEDGER_SCHEMA.replace("id long, ", ""))
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda k: lg.append(runs(k), f"{tmpdir_path}/ledger"), range(6)))
    assert sorted(numbers) == [1, 2, 3, 4, 5, 6]
    log = lg.read(spark, f"{tmpdir_path}/ledger")
    assert sorted(r.id for r in log.collect()) == list(range(1, 25))
    now = lg.current(log)
    assert now.count() == 19 == now.select("source_hash").distinct().count()
    assert not glob.glob(f"{tmpdir_path}/ledger/_staging*")


def test_reference_tables(spark, tmpdir_path):
    m = sio.load_reference(spark, None, sio.load_symbol_master)
    assert m.count() == 3 and m.where("end_date IS NULL").count() == 3
    ic = sio.load_index_constituents(spark).collect()
    assert [r["index"] for r in ic] == sorted(r["index"] for r in ic)
    from barspark.sinks.files import materialise
    p = materialise(spark, m, f"{tmpdir_path}/sm")
    assert sio.load_reference(spark, p, sio.load_symbol_master).count() == 3


def test_outlier_statistics_are_per_source_file(spark):
    """Each landing file gets its own median/MAD, as the reference processes one
    file per run: 130 is an outlier among ~100s but normal among ~130s."""
    rows = []
    for i in range(20):
        rows.append(("a.csv", dt.datetime(2024, 1, 1, 9, i), "X", 100.0 + (i % 3) * 0.5, i))
        rows.append(("b.csv", dt.datetime(2024, 1, 1, 9, i), "X", 130.0 + (i % 3) * 0.5, i))
    rows.append(("a.csv", dt.datetime(2024, 1, 1, 10, 0), "X", 130.0, 99))
    df = spark.createDataFrame(rows, "_source_file string, timestamp timestamp, symbol string, close double, "
                                     "pos int").withColumn("_row_pos", F.struct("pos")).drop("pos")
    for c in ("open", "high", "low", "volume", "trade_count"):
        df = df.withColumn(c, F.lit(1))
    cfg = ig.IngestConfig(source=[], destination="", run_id="t", expected_frequency="1m")
    scored, result = ig.assess(df, cfg, Scratch(spark, "t"))
    q = scored.filter("is_outlier").collect()
    assert len(q) == 1 and q[0]["_source_file"] == "a.csv" and q[0].close == 130.0
    assert scored.where("_source_file = 'b.csv' AND NOT is_outlier").count() == 20
    assert {r["_source_file"]: r.outliers for r in result.collect()} == {"a.csv": 1, "b.csv": 0}


def test_scans_and_known_files(spark, tmpdir_path):
    _file(tmpdir_path, "a b.csv", _rows(3))
    schema = sc.contract("market_data")
    got = sio.csv_scan(spark, f"{tmpdir_path}/land/*.csv", schema, text_columns=("timestamp",)).collect()
    assert len(got) == 3 and got[0].timestamp == "2024-01-01 09:00:00" and got[0].trade_count == 3 and got[0].close == 1.0
    assert got[0]._source_file.endswith("a%20b.csv")
    assert sio.csv_scan(spark, [f"{tmpdir_path}/land/a b.csv"], with_source=False, options={"header": "false"}).count() == 4
    spark.range(5).write.parquet(f"{tmpdir_path}/p")
    assert sio.parquet_scan(spark, f"{tmpdir_path}/p").count() == 5
    with pytest.raises(FileNotFoundError, match="nowhere"):
        sio.parquet_scan(spark, f"file://{tmpdir_path}/nowhere")
    files = sio.source_hashes(spark, f"{tmpdir_path}/land/*.csv")
    other = files.withColumn("source_hash", F.lit("other"))
    assert lg.already_ingested(files.unionByName(other), files).count() == 1
    assert lg.new_files(files.unionByName(other), files).first().source_hash == "other"
