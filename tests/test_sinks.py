"""Sinks: partitioned overwrite, alert history retention, round trips."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark import sinks as SK
from tidemark.operators import features as FT
from tidemark.sources import fixtures as X


def test_partitioned_dynamic_overwrite(spark, sf, tmp_path):
    path = str(tmp_path / "feat")
    f = FT.feat_core(X.bars_1h(spark, sf))
    SK.write_partitioned(f, path)
    SK.write_partitioned(f.filter(F.col("symbol") == "BTC-USD").withColumn("volume", F.lit(-1.0)), path)
    back = spark.read.parquet(path)
    assert back.count() == f.count()
    by = {r["symbol"]: r["v"] for r in back.groupBy("symbol").agg(F.min("volume").alias("v")).collect()}
    assert by["BTC-USD"] == -1.0 and all(v >= 0 for k, v in by.items() if k != "BTC-USD")


def test_alert_history_keeps_newest(spark, tmp_path):
    path = str(tmp_path / "alerts")
    t0 = dt.datetime(2026, 1, 1)
    mk = lambda lo, hi: spark.createDataFrame(
        [("BTC-USD", t0 + dt.timedelta(minutes=i), "high_risk", "m", 90.0) for i in range(lo, hi)],
        "symbol string, ts timestamp, alert_type string, message string, risk_score double")
    SK.append_alert_history(mk(0, 700), path, keep=1000)
    SK.append_alert_history(mk(700, 1400), path, keep=1000)
    kept = SK.read_alert_history(spark, path, 5000)
    assert kept.count() == 1000
    assert kept.agg(F.min("ts")).first()[0] == t0 + dt.timedelta(minutes=400)
    top = SK.read_alert_history(spark, path, 50).collect()
    assert len(top) == 50 and top[0]["ts"] == t0 + dt.timedelta(minutes=1399)


def test_bar_file_reader_uses_given_schema(spark, sf, tmp_path):
    from tidemark.sources.feeds import read_bars

    path = str(tmp_path / "bars.csv")
    SK.write_table(X.bars_1h(spark, sf), path, fmt="csv")
    back = read_bars(spark, path, "csv")
    assert back.schema.simpleString().startswith("struct<symbol:string,ts:timestamp,open:double")
    assert back.count() == X.bars_1h(spark, sf).count()


def test_clear_alert_history(spark, tmp_path):
    path = str(tmp_path / "alerts")
    t0 = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([("BTC-USD", t0, "high_risk", "m", 90.0)],
                               "symbol string, ts timestamp, alert_type string, message string, risk_score double")
    SK.append_alert_history(df, path)
    SK.clear_alert_history(spark, path)
    assert SK.read_alert_history(spark, path).count() == 0
    SK.append_alert_history(df, path)
    assert SK.read_alert_history(spark, path).count() == 1


def test_alert_history_survives_retries_and_broken_writes(spark, tmp_path, monkeypatch):
    import os

    monkeypatch.setattr(SK, "COMPACT_AFTER", 3)
    path = str(tmp_path / "alerts")
    t0 = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([("BTC-USD", t0, "high_risk", "m", 90.0)],
                               "symbol string, ts timestamp, alert_type string, message string, risk_score double")
    SK.append_alert_history(df, path, version="e1")
    SK.append_alert_history(df, path, version="e1")  # retried epoch
    assert SK.read_alert_history(spark, path).count() == 1
    df.write.parquet(f"{path}/data/broken")  # a write that broke off before its commit
    open(f"{path}/_log/{2:012d}", "w").close()  # and a commit that broke off
    assert SK.read_alert_history(spark, path).count() == 1
    SK.append_alert_history(df, path, version="e2")
    assert SK.read_alert_history(spark, path).count() == 2
    for i in range(3, 15):
        SK.append_alert_history(df, path, version=f"e{i}")
    SK.append_alert_history(df, path, version="e4")  # merged long ago, still known
    assert SK.read_alert_history(spark, path).count() == 14
    assert len(SK.read_log(spark, path).folders) <= SK.COMPACT_AFTER + 1
    assert len(os.listdir(f"{path}/_log")) < 14 and len(os.listdir(f"{path}/data")) < 14


def test_concurrent_appends_all_survive(spark, tmp_path):
    """Writers that take the same number go on to the next; a merge in between loses none."""
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "alerts")
    t0 = dt.datetime(2026, 1, 1)
    schema = "symbol string, ts timestamp, alert_type string, message string, risk_score double"
    rows = [spark.createDataFrame([(f"S{i}", t0 + dt.timedelta(minutes=i), "high_risk", "m", 90.0)], schema) for i in range(12)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda df: SK.append_alert_history(df, path), rows))
    assert {r["symbol"] for r in SK.read_alert_history(spark, path).collect()} == {f"S{i}" for i in range(12)}
    with ThreadPoolExecutor(6) as pool:
        jobs = [pool.submit(SK.compact_alert_history, spark, path), *[pool.submit(SK.append_alert_history, df, path) for df in rows[:4]]]
        [j.result() for j in jobs]
    assert SK.read_alert_history(spark, path).count() == 16
    taken = [SK._create_exclusive(spark, f"{path}/_log/{900:012d}", "{}") for _ in range(3)]
    assert taken == [True, False, False]


def test_history_keeps_the_newest(spark, tmp_path):
    path = str(tmp_path / "alerts")
    df = spark.range(40).selectExpr("'a' as symbol", "timestamp_seconds(1700000000 + id) as ts", "'high_risk' as alert_type", "cast(id as string) as message", "1.0 as risk_score")
    for part in range(4):
        SK.append_alert_history(df.where(F.col("message") % 4 == part), path, keep=10)
    assert {int(r["message"]) for r in SK.read_alert_history(spark, path).collect()} == set(range(30, 40))
    SK.compact_alert_history(spark, path)
    assert SK.read_alert_history(spark, path, 3).count() == 3 and SK.read_alert_history(spark, path).count() == 10
    SK.clear_alert_history(spark, path)
    assert SK.read_alert_history(spark, path).count() == 0 and SK.read_alert_history(spark, path).columns == df.columns
