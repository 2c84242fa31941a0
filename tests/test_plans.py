"""The chunk + halo plan must give exactly the unsplit (per-symbol) result."""

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import finish
from tidemark.operators import features as FT
from tidemark.operators import risk as R
from tidemark.sources import fixtures as X

SMALL = dict(chunk_rows=7, bucket_size=5 * 3600)


def same(a, b):
    a, b = finish(a), finish(b)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


@pytest.mark.parametrize("op", ["feat_trap", "feat_asset", "feat_core"])
def test_bar_features_chunked(spark, sf, op):
    bars = X.bars_1h(spark, sf)
    fn = getattr(FT, op)
    same(fn(bars, **SMALL), fn(bars, plain=True))


def test_lookahead_chunked(spark, sf):
    bars = X.bars_daily_li(spark, sf)
    same(FT.lbl_trap(bars, chunk_rows=5, bucket_size=86400 * 3), FT.lbl_trap(bars, plain=True))


def test_realtime_chunked(spark, sf):
    fr = X.frame_1h(spark, sf)
    cols = ["symbol", "ts", "bar_no", "risk_score", "structure_failure", "volume_behavior", "momentum_exhaustion", "control"]
    same(R.rt_frame(fr, **SMALL).select(*cols), R.rt_frame(fr, plain=True).withColumn("bar_no", F.col("bar_no").cast("long")).select(*cols))


def test_running_totals_and_ema_chunked(spark, sf):
    fr = X.bars_daily_li(spark, sf).select("symbol", "ts", F.col("close").alias("price"), "volume")
    a = FT.feat_chart(fr, chunk_rows=50, bucket_size=86400 * 10)
    b = FT.feat_chart(fr, plain=True)
    j = a.alias("a").join(b.alias("b"), ["symbol", "ts"])
    diff = j.select(
        F.max(F.abs(F.col("a.vwap") - F.col("b.vwap")) / F.abs(F.col("b.vwap"))).alias("v"),
        F.max(F.abs(F.col("a.ema21") - F.col("b.ema21")) / F.abs(F.col("b.ema21"))).alias("e"),
    ).first()
    assert j.count() == b.count()
    assert diff.v < 1e-12 and diff.e < 1e-12


def test_chunked_plan_splits_symbols(spark, sf):
    """Above one chunk of input, windows partition by (symbol, chunk), not by symbol alone."""
    plan = FT.feat_trap(X.bars_1h(spark, sf), chunk_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan


def test_same_plan_below_one_chunk(spark, sf):
    """An input within one chunk takes the same plan: windows by (symbol, chunk)."""
    plan = FT.feat_trap(X.bars_1h(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan


def test_exact_quantile_like_pandas(spark):
    """Short, constant, tied and two-row series, and cuts far coarser than the rows (accuracy 10)."""
    import numpy as np
    import pandas as pd

    from tidemark.operators.stats import exact_quantile

    rng = np.random.default_rng(5)
    parts = {"one": [3.0], "two": [1.0, 9.0], "same": [4.0] * 50, "ties": rng.integers(0, 4, 500).astype(float),
             "many": rng.normal(size=3000), "with_null": [2.0, None, 8.0]}
    pdf = pd.concat([pd.DataFrame({"symbol": k, "volume": v}) for k, v in parts.items()])
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "symbol string, volume double")
    for q, accuracy in ((0.95, 100_000), (0.5, 10), (0.0, 100), (1.0, 100)):
        got = {r["symbol"]: r["quantile"] for r in exact_quantile(df, q, accuracy=accuracy).collect()}
        want = pdf.astype({"volume": float}).groupby("symbol")["volume"].quantile(q).to_dict()
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want), (q, got, want)


def test_short_tails_are_refused(spark, sf):
    import pytest

    with pytest.raises(ValueError):
        R.trap_report_latest(X.bars_1h(spark, sf), tail=39)
    with pytest.raises(ValueError):
        R.risk_snapshot(X.frame_1h(spark, sf), tail=28)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_group_limited_before_shuffle(spark, sf):
    from tidemark.operators.merge import tail_n

    assert "WindowGroupLimit" in _plan(tail_n(X.bars_1h(spark, sf), 180))
    assert "WindowGroupLimit" in _plan(R.risk_snapshot(X.frame_1h(spark, sf)))


def test_registry_join_is_broadcast(spark, sf):
    from tidemark.operators.params import with_asset_params

    assert "BroadcastHashJoin" in _plan(with_asset_params(X.bars_1h(spark, sf)))


def test_bars_use_partial_aggregation(spark, sf):
    from tidemark.operators.bars import ohlcv_bars

    p = _plan(ohlcv_bars(X.ticks(spark, sf), 3600))
    assert "partial_min_by" in p and "partial_sum" in p


def test_snapshot_tail_equals_full_series(spark, sf):
    fr = X.frame_1h(spark, sf)
    cols = ["symbol", "ts", "bar_no", "risk_score", "structure_failure", "volume_behavior", "momentum_exhaustion", "control"]
    same(R.risk_snapshot(fr).select(*cols), R.risk_snapshot(fr, tail=None).select(*cols))


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("accuracy", [100, 100_000])
def test_exact_quantile_matches_percentile(spark, sf, q, accuracy):
    """Small accuracy forces the sketch-bracket path; the default ranks whole keys."""
    from tidemark.operators.stats import exact_quantile

    t = X.ticks(spark, sf).select("symbol", F.col("price").alias("volume"))
    a = {r[0]: r[1] for r in exact_quantile(t, q, accuracy=accuracy).collect()}
    b = {r[0]: r[1] for r in t.groupBy("symbol").agg(F.percentile("volume", q)).collect()}
    assert a.keys() == b.keys()
    for k in b:
        assert a[k] == pytest.approx(b[k], rel=1e-12, abs=1e-12)


def test_two_level_prefix_offsets(spark):
    from pyspark.sql import Window

    from tidemark.plans.partitioning import prefix_offsets

    rows = [(k, c, (c * 7 + len(k)) % 5 + 1) for k in ("A", "BB") for c in range(0, 40, 3)]
    cells = spark.createDataFrame(rows, "key string, cell long, n long")
    got = prefix_offsets(cells, "key", "cell", "n", "off", fan=2)
    w = Window.partitionBy("key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    want = cells.select("key", "cell", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("off"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_smoothing_is_the_same_in_any_chunking(spark):
    import random

    from tidemark.operators.alerts import smoothed_risk

    r = random.Random(11)
    rows = [("A", f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00:00", 0.0 if r.random() < 0.1 else r.uniform(20, 100)) for i in range(700)]
    df = spark.createDataFrame(rows, "symbol string, t string, risk_score double").selectExpr("symbol", "cast(t as timestamp) ts", "risk_score")
    want = sorted(map(tuple, smoothed_risk(df, plain=True).collect()))
    for chunk in (100, 230):
        got = sorted(map(tuple, smoothed_risk(df, chunk_rows=chunk).select("symbol", "ts", "risk_score", "smoothed_risk", "streak", "crossed_above", "is_critical", "display_level").collect()))
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[:2] == w[:2] and abs(g[3] - w[3]) < 1e-9 and g[4:] == w[4:]


def test_rows_without_key_or_time_stay_in_any_chunking(spark):
    from tidemark.operators.features import feat_tick

    rows = [("A" if i % 40 else None, None if i % 55 == 7 else f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", 100.0 + i % 7, 10.0 + i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "symbol string, t string, price double, volume double").selectExpr("symbol", "cast(t as timestamp) ts", "price", "volume")
    assert feat_tick(df, plain=True).count() == 300 == feat_tick(df, chunk_rows=100).count()


def test_bars_aggregate_by_hash(spark, sf):
    """Open and close come from a fixed-width key; ties, null numbers and negative times sort as the columns do."""
    import datetime as dt

    from tidemark.operators.bars import ohlcv_bars

    plan = ohlcv_bars(X.ticks(spark, sf), 60)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "HashAggregate" in plan
    t0 = dt.datetime(1960, 1, 1)
    rows = [("a", t0, 2, 5.0, 1.0), ("a", t0, None, 7.0, 1.0), ("a", t0, -9, 6.0, 1.0), ("a", t0 + dt.timedelta(seconds=1), 2**63 - 1, 8.0, 1.0),
            ("a", t0 + dt.timedelta(seconds=1), -(2**63), 9.0, None)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, seq long, price double, volume double")
    one = ohlcv_bars(df.repartition(3), 60).first()
    assert (one["open"], one["high"], one["low"], one["close"], one["volume"]) == (7.0, 9.0, 5.0, 8.0, 4.0)


def test_segment_totals_restart_and_hold_no_segment_window(spark, sf):
    from pyspark.sql import Window

    from tidemark.plans.partitioning import segment_totals

    t = X.ticks(spark, sf).withColumn("symbol", F.when(F.col("seq") % 50 != 0, F.col("symbol"))).withColumn(
        "ts", F.when(F.col("seq") % 90 != 0, F.col("ts")))
    got = segment_totals(t, ["symbol", F.to_date("ts")], ("ts", "seq"), F.coalesce("volume", F.lit(0.0)), "total", 600)
    w = Window.partitionBy("symbol", F.to_date("ts")).orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = t.withColumn("total", F.sum(F.coalesce("volume", F.lit(0.0))).over(w))
    same(got, want)
    plan = X.cumulative_ticks(spark, sf)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line or "Window [" in line.strip()[:12]]
    assert windows and all("_bkt" in x or "_sup" in x for x in windows)


def test_band_of_a_constant_series_is_exactly_flat(spark):
    from tidemark.operators.stats import centered_band

    rows = spark.range(400).selectExpr("'c' as symbol", "timestamp_seconds(id * 3600) as ts", "0.1 + 0.2 as risk_score")
    rows = rows.unionByName(spark.range(3).selectExpr("'s' as symbol", "timestamp_seconds(id * 3600) as ts", "cast(id as double) as risk_score"))
    out = centered_band(rows, "risk_score")
    assert out.where("symbol = 'c' and (band_std <> 0 or significant)").count() == 0
    assert out.where("symbol = 'c'").agg(F.countDistinct("band_mean")).first()[0] == 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(") <= 2


def test_ema_lanes_equal_the_definition():
    import numpy as np

    from tidemark.plans.recurrence import ema_path

    r = np.random.default_rng(4)
    for n, alpha in ((1, 0.35), (63, 0.2), (64, 0.2), (65, 0.2), (5000, 2 / 22), (20_000, 0.35)):
        x = r.integers(0, 1000, n) / 10.0
        x[r.random(n) < 0.1] = np.nan
        live = r.random(n) < 0.95
        held, want, state = np.nan, [], []
        for v, on in zip(x, live):
            shown = v if not on or held != held else held if v != v else alpha * v + (1.0 - alpha) * held
            held = shown if on else np.nan
            want.append(shown)
            state.append(held)
        got = ema_path(x, alpha, live)
        assert np.array_equal(got[0], want, equal_nan=True) and np.array_equal(got[1], state, equal_nan=True)


def test_market_rows_in_one_pass_equal_separate_passes(spark, sf):
    """Realtime, asset and change columns of one pass against a pass (and join) each; no join and one numbering in the plan."""
    from tidemark.functions import series as S
    from tidemark.operators import alerts as AL
    from tidemark.plans.partitioning import materialize, over_series

    bars = materialize(X.bars_1h(spark, sf))
    frame = bars.select("symbol", "ts", F.col("close").alias("price"), "volume")
    rt = R.rt_frame(frame).select("symbol", "ts", "price", "volume", "trap_type", "main_reason", "control", F.col("risk_score").alias("rt_score"))
    change = over_series(frame, lambda d, s: d.withColumn("change", S.pct_change("price", s) * 100.0), halo=1).select("symbol", "ts", "change")
    asset = R.asset_report(FT.feat_asset(bars)).select("symbol", "ts", F.least(F.col("trap_risk_score"), F.lit(100.0)).alias("risk_score"))
    want = rt.join(asset, ["symbol", "ts"]).join(change, ["symbol", "ts"])
    got = AL.market_rows(bars)
    same(got.select(*want.columns), want)
    chunked = AL.market_rows(bars, **SMALL)
    same(chunked.select(*want.columns), want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") <= 2 and plan.count("Exchange hash") <= 12  # the numbering's two prefix joins only
    numbered = AL.smoothed_risk(got, index="bar_no")
    same(numbered, AL.smoothed_risk(got))
