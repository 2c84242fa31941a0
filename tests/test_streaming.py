"""Batch = stream: each streaming job replays its input with availableNow
and must equal its batch twin (closed windows only for bar streams)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import tidemark.catalog as C
from tidemark.functions import series as S
from tidemark.operators import alerts as AL
from tidemark.operators import risk as R
from tidemark.operators.bars import ohlcv_bars
from tidemark.plans.partitioning import over_series
from tidemark.sources import fixtures as X
from tidemark.streaming import event_time as ET
from tidemark.streaming import jobs as SJ


def eq(a, b, cols, tol=1e-9):
    a = {tuple(r[c] for c in cols[:2]): r for r in a.collect()}
    b = {tuple(r[c] for c in cols[:2]): r for r in b.collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in cols[2:]:
            x, y = a[k][c], b[k][c]
            if isinstance(x, float) and isinstance(y, float):
                assert x == pytest.approx(y, abs=tol), (k, c)
            else:
                assert x == y, (k, c)


def test_stream_bars_equal_closed_batch_bars(spark, sf):
    s = SJ.run_available_now(SJ.stream_bars(SJ.tick_stream(spark, sf)), "t-bars")
    t = X.ticks(spark, sf)
    last = t.agg(F.max("ts")).first()[0]
    cutoff = last - dt.timedelta(minutes=10)
    b = ohlcv_bars(t, 3600).filter(F.col("ts") + F.expr("INTERVAL 1 HOUR") <= F.lit(cutoff))
    eq(s, b, ["symbol", "ts", "open", "high", "low", "close", "volume"])


def test_stream_dedup(spark, sf):
    t = SJ.tick_stream(spark, sf)
    s = SJ.run_available_now(SJ.stream_dedup(t.unionByName(SJ.tick_stream(spark, sf).filter(F.col("seq") % 3 == 0))), "t-dedup")
    assert s.count() == X.ticks(spark, sf).select("symbol", "ts").distinct().count()


def test_stream_volume_delta(spark, sf):
    s = C.q_str_volume_delta(spark, sf)
    ct = X.cumulative_ticks(spark, sf)
    b = over_series(ct, lambda d, sp: d.withColumn("volume_delta", S.diff_clip("volume", sp)), halo=1, order=("ts", "seq"))
    eq(s.withColumn("ts", F.col("ts").cast("timestamp")), b, ["symbol", "seq", "volume_delta"])


def test_stream_smoothing_equals_batch_twin(spark, sf):
    s = C.q_str_smoothed_risk_stream(spark, sf)
    b = AL.smoothed_risk(C.market_rows(spark, sf))
    eq(s.withColumn("ts", F.col("ts").cast("timestamp")), b, ["symbol", "ts", "smoothed_risk", "streak", "crossed_above", "is_critical"], 1e-6)


def replay(spark, df, build, files=5, late=(), seed=3, watermark="10 minutes"):
    """``df`` in files of mixed event time, ``late`` after them, then the end marker."""
    path = SJ.scratch(spark, "shuffled")
    mixed = df.withColumn("_f", F.pmod(F.xxhash64("symbol", "ts", F.lit(seed)), F.lit(files)))
    for i in range(files):
        mixed.where(F.col("_f") == i).drop("_f").coalesce(1).write.mode("append").parquet(path)
    if late:
        spark.createDataFrame(list(late), df.schema).coalesce(1).write.mode("append").parquet(path)
    ET.end_marker(df).write.mode("append").parquet(path)
    return ET.run_with_late(build(SJ.file_stream(spark, path, df.schema), watermark), "t-shuffled")


def test_event_time_state_equals_batch_on_shuffled_files(spark, sf):
    """The delay covers the disorder, so nothing is late and every value equals the batch twin's."""
    scores = X.frame_1h(spark, sf).select("symbol", "ts", F.col("price").alias("anomaly_score"))
    out, late = replay(spark, scores, SJ.stream_score_window, watermark="400 days")
    b = over_series(scores, lambda d, sp: d.withColumn("risk_percentage", S.minmax_pct("anomaly_score", sp, 100)), halo=100)
    eq(out, b, ["symbol", "ts", "risk_percentage"], 1e-9)
    assert late.count() == 0
    ct = X.cumulative_ticks(spark, sf)
    out, late = replay(spark, ct.withColumn("ts", F.col("ts")), SJ.stream_volume_delta, files=3, watermark="400 days")
    b = over_series(ct, lambda d, sp: d.withColumn("volume_delta", S.diff_clip("volume", sp)), halo=1, order=("ts", "seq"))
    eq(out, b, ["symbol", "seq", "volume_delta"])
    assert late.count() == 0


def test_late_rows_have_an_output_of_their_own(spark):
    """Rows behind a released cell change nothing and are put out as late; the rest equals the batch."""
    t0 = dt.datetime(2024, 1, 1)
    schema = "symbol string, ts timestamp, seq long, price double, volume double"
    rows = [(s, t0 + dt.timedelta(minutes=i), i, 1.0, float(i * i)) for s in ("a", "b", None) for i in range(200)]
    path = SJ.scratch(spark, "late-rows")
    for part in (rows[::2], rows[1::2]):  # the second file fills the gaps of the first, within the watermark
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    ahead = [("a", t0 + dt.timedelta(days=1, minutes=i), 500 + i, 1.0, 1e6 + i) for i in range(2)]
    for row in ahead:  # the first moves the watermark, the second's batch releases what is behind it
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)
    gone = [("a", t0 + dt.timedelta(minutes=5, seconds=1), 900, 1.0, 7e6), ("a", None, 901, 1.0, 8e6), ("b", t0, 902, 1.0, 9e6)]
    spark.createDataFrame(gone, schema).coalesce(1).write.mode("append").parquet(path)
    df = spark.createDataFrame(rows + ahead, schema)
    ET.end_marker(df).write.mode("append").parquet(path)
    out, late = ET.run_with_late(SJ.stream_volume_delta(SJ.file_stream(spark, path, df.schema), "4 hours"), "t-late-rows")
    b = over_series(df, lambda d, sp: d.withColumn("volume_delta", S.diff_clip("volume", sp)), halo=1, order=("ts", "seq"))
    eq(out, b, ["symbol", "seq", "volume_delta"])
    assert sorted(r["seq"] for r in late.collect()) == [900, 901, 902]
    assert late.where("volume_delta is not null").count() == 0


def test_idle_keys_lose_their_state(spark):
    t0 = dt.datetime(2024, 1, 1)
    schema = "symbol string, ts timestamp, seq long, price double, volume double"
    first = [("a", t0 + dt.timedelta(minutes=i), i, 1.0, 10.0 * i) for i in range(10)]
    after = [("b", t0 + dt.timedelta(days=3), 20, 1.0, 1.0)]
    again = [("a", t0 + dt.timedelta(days=4), 30, 1.0, 1000.0), ("a", t0 + dt.timedelta(days=4, minutes=5), 31, 1.0, 1001.0)]
    for ttl, want in ((None, 910.0), ("1 day", 0.0)):
        path = SJ.scratch(spark, "idle")
        for part in (first, after, again):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        df = spark.createDataFrame(again, schema)
        ET.end_marker(df).write.mode("append").parquet(path)
        out, late = ET.run_with_late(SJ.stream_volume_delta(SJ.file_stream(spark, path, df.schema), ttl=ttl), "t-idle")
        got = {r["seq"]: r["volume_delta"] for r in out.collect()}
        assert got[30] == want and got[31] == 1.0 and got[9] == 10.0 and late.count() == 0


def test_micro_batch_scorer_equals_batch(spark, sf):
    path = SJ.materialize_in_order(X.table(spark, sf, "events"), SJ.scratch(spark, "ev"), "ts", 4)
    out = SJ.micro_batch_scorer(spark, SJ.events_to_ticks(SJ.file_stream(spark, path, SJ.EVENTS_SCHEMA)))
    batch = R.rt_frame(X.frame_1h(spark, sf)).join(out.select("symbol", "ts"), ["symbol", "ts"], "left_semi")
    eq(out, batch, ["symbol", "ts", "risk_score", "structure_failure", "volume_behavior", "momentum_exhaustion", "control", "trap_type"])


def test_stream_mode_suppress_equals_batch_twin(spark, sf):
    m = C.market_rows(spark, sf).select("symbol", "ts", "risk_score").withColumn("is_live", F.dayofmonth("ts") % 2 == 1)
    out, late = replay(spark, m, SJ.stream_smoothed_risk, files=3, watermark="400 days")
    eq(out, AL.smoothed_risk(m, live="is_live"), ["symbol", "ts", "smoothed_risk", "streak", "crossed_above", "is_critical"], 1e-6)
    assert late.count() == 0


def test_micro_batch_scorer_on_processing_time_trigger(spark, sf):
    path = SJ.materialize_in_order(X.table(spark, sf, "events"), SJ.scratch(spark, "ev"), "ts", 3)
    ticks = lambda: SJ.events_to_ticks(SJ.file_stream(spark, path, SJ.EVENTS_SCHEMA))
    base = SJ.scratch(spark, "pipe")
    q = SJ.micro_batch_scorer(spark, ticks(), interval="1 second", base=base)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    live = spark.read.parquet(f"{base}/snapshots").drop("epoch")
    once = SJ.micro_batch_scorer(spark, ticks())
    assert live.count() > 0
    assert live.select("symbol", "ts", "risk_score").exceptAll(once.select("symbol", "ts", "risk_score")).count() == 0


def late_tick(spark, sf, between):
    """Bars of a stream that gets the first half of the ticks, ``between`` further
    files, and a tick of the first minute; each file a micro-batch."""
    ev = X.table(spark, sf, "events")
    path = SJ.scratch(spark, "late")
    cut = ev.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)).first()[0]
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    parts = [ev.where(at <= cut), ev.where(at > cut)]
    first = ev.orderBy("ts").first()
    tick = (10**9, first["ts"] + dt.timedelta(minutes=1), 1, "click", 10**6 * 1.0, '{"k": 5}')
    for part in parts[: 1 + between]:
        part.coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([tick], SJ.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    for part in parts[1 + between:]:
        part.coalesce(1).write.mode("append").parquet(path)
    assert spark.read.schema(SJ.EVENTS_SCHEMA).parquet(path).select(F.input_file_name()).distinct().count() == 3
    return SJ.run_available_now(SJ.stream_bars(SJ.events_to_ticks(SJ.file_stream(spark, path, SJ.EVENTS_SCHEMA))), "t-late")


def test_late_tick_is_dropped(spark, sf):
    """A tick of a window that an earlier batch put out changes no bar."""
    s = late_tick(spark, sf, 1)
    assert s.filter(F.col("high") >= 10**6).count() == 0
    t = X.ticks(spark, sf)
    cutoff = t.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    b = ohlcv_bars(t, 3600).filter(F.col("ts") + F.expr("INTERVAL 1 HOUR") <= F.lit(cutoff))
    eq(s, b, ["symbol", "ts", "open", "high", "low", "close", "volume"])


def test_late_tick_of_the_next_batch_joins_an_open_window(spark, sf):
    """Behind the watermark, but its window is not put out yet: the batch before had none to judge it by."""
    s = late_tick(spark, sf, 0)
    assert s.filter(F.col("high") >= 10**6).count() == 1


def test_micro_batch_scorer_raises_alerts_into_history(spark, sf):
    from tidemark import sinks as SK

    path = SJ.materialize_in_order(X.table(spark, sf, "events"), SJ.scratch(spark, "ev"), "ts", 3)
    alerts = SJ.scratch(spark, "alerts")
    out = SJ.micro_batch_scorer(spark, SJ.events_to_ticks(SJ.file_stream(spark, path, SJ.EVENTS_SCHEMA)), alerts_path=alerts)
    hist = SK.read_alert_history(spark, alerts, 1000)
    assert out.count() > 0 and hist.count() > 0
    assert {r[0] for r in hist.select("alert_type").distinct().collect()} <= {"high_risk", "price_spike", "volume_anomaly"}


def test_materialize_keeps_every_row_in_time_order(spark):
    """Null times come first in files of their own, skewed times are dealt by rows, and an empty table streams."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", None, i, 1.0, float(i)) for i in range(88)]
    rows += [("a", t0 + dt.timedelta(seconds=i), 100 + i, 1.0, 100.0 + i) for i in range(800)]
    rows += [("a", t0 + dt.timedelta(days=3650 + i), 1000 + i, 1.0, 1000.0 + i) for i in range(12)]
    schema = "symbol string, ts timestamp, seq long, price double, volume double"
    df = spark.createDataFrame(rows, schema).repartition(5)
    path = SJ.materialize_in_order(df, SJ.scratch(spark, "nulls"))
    back = spark.read.parquet(path)
    assert back.count() == 900 and back.exceptAll(df).count() == 0
    of = back.select("ts", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("m"))
    per = of.groupBy("f", "m").agg(F.count(F.lit(1)).alias("n"), F.count("ts").alias("timed"), F.min("ts").alias("lo"),
                                   F.max("ts").alias("hi")).orderBy("m").collect()
    assert [p["timed"] for p in per][0] == 0 and all(p["timed"] in (0, p["n"]) for p in per)
    assert max(p["n"] for p in per) < 450
    timed = [p for p in per if p["timed"]]
    assert all(a["hi"] <= b["lo"] for a, b in zip(timed, timed[1:]))
    ET.end_marker(df).write.mode("append").parquet(path)
    out, late = ET.run_with_late(SJ.stream_volume_delta(SJ.file_stream(spark, path, schema)), "t-null")
    assert late.count() == 0 and out.count() == 900 and out.where("volume_delta < 0").count() == 0
    assert out.agg(F.sum("volume_delta")).first()[0] == 1011.0
    none = SJ.materialize_in_order(df.limit(0), SJ.scratch(spark, "none"))
    assert ET.run_with_late(SJ.stream_volume_delta(SJ.file_stream(spark, none, schema)), "t-none")[0].count() == 0
    ticks = SJ.file_stream(spark, none, schema)
    assert SJ.micro_batch_scorer(spark, ticks).count() == 0
