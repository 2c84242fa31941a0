"""Hand-table semantics (FIXTURES part C) and the source system's contract."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import series as S
from tidemark.operators import alerts as AL
from tidemark.operators import features as FT
from tidemark.operators import risk as R
from tidemark.operators.params import with_asset_params
from tidemark.plans.partitioning import Series, over_series

T0 = dt.datetime(2026, 1, 1)


def frame(spark, prices, volumes=None, symbol="BTC-USD"):
    volumes = volumes or [1000.0 + 37 * i % 4000 for i in range(len(prices))]
    rows = [(symbol, T0 + dt.timedelta(minutes=i), float(p), float(v)) for i, (p, v) in enumerate(zip(prices, volumes))]
    return spark.createDataFrame(rows, "symbol string, ts timestamp, price double, volume double")


def walk(n, seed=7, drift=0.0, scale=1.0):
    import random

    r = random.Random(seed)
    p, out = 100.0, []
    for _ in range(n):
        p = max(1.0, p * (1 + drift + r.gauss(0, 0.002 * scale)))
        out.append(p)
    return out


def test_components_bounded(spark):
    out = R.rt_frame(frame(spark, walk(80))).collect()
    for r in out:
        for c in ("structure_failure", "volume_behavior", "momentum_exhaustion"):
            assert 0.0 <= r[c] <= 1.0
    assert out[-1]["diagnostics"] is not None or max(r["bar_no"] for r in out) < 25


def test_row_count_guards(spark):
    for n, ready, full in [(9, False, False), (10, True, False), (24, True, False), (25, True, True)]:
        snap = R.risk_snapshot(frame(spark, walk(n))).first()
        assert (snap["trap_type"] != "Neutral") == ready
        assert (snap["diagnostics"] is not None) == full
        if not ready:
            assert snap["risk_score"] == 0.0 and snap["risk_level"] == "LOW" and snap["control"] == "Neutral"


def test_reasons_sorted_and_capped(spark):
    snap = R.rt_frame(frame(spark, walk(120, scale=8.0)))
    for r in snap.filter(F.size("reasons") > 0).collect():
        conf = [x["confidence"] for x in r["reasons"]]
        assert 2 <= len(conf) <= 3 and conf == sorted(conf, reverse=True)
        assert r["risk_score"] >= 40


def test_trap_type_ties(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.5, 0.5), (0.1, 0.6, 0.6, 0.0), (0.1, 0.2, 0.3, 0.3), (0.0, 0.0, 0.0, 0.9)],
                               "s double, v double, m double, a double")
    got = [r[0] for r in df.select(R.trap_type(F.col("s"), F.col("v"), F.col("m"), F.col("a"))).collect()]
    assert got == ["Breakout Failure Trap", "Distribution Trap", "Fake Momentum Trap", "Liquidity Sweep Trap"]


def test_control_labels(spark):
    labels = {r["control"] for r in R.rt_frame(frame(spark, walk(60, drift=0.002))).collect()}
    assert labels <= {"Buyers in Control", "Sellers in Control", "Neutral"}
    up = R.risk_snapshot(frame(spark, [100.0 * 1.01 ** i for i in range(30)], [1000.0] * 30)).first()
    assert up["control"] == "Buyers in Control"


def test_rsi_variants_on_pure_gains(spark):
    rising = frame(spark, [100.0 + i for i in range(30)])
    out = over_series(rising, lambda d, s: d.withColumn("z", S.rsi("price", s, 14, "zero"))
                      .withColumn("n", S.rsi("price", s, 14, "neutral")), halo=16, order=("ts",)).orderBy("ts").collect()
    assert out[12]["z"] is None and out[13]["z"] == 0.0  # no losses: 0 in one variant
    assert all(r["n"] == 50.0 for r in out)  # 50 in the other


def test_flat_minmax_is_50(spark):
    flat = frame(spark, [10.0] * 30)
    out = over_series(flat, lambda d, s: d.withColumn("p", S.minmax_pct("price", s, 100)), halo=100).collect()
    assert {r["p"] for r in out} == {50.0}


def test_zero_base_guards(spark):
    bars = spark.createDataFrame(
        [("BTC-USD", T0 + dt.timedelta(hours=i), *map(float, (o, h, l, c, v))) for i, (o, h, l, c, v) in enumerate(
            [(1, 1, 1, 1, 0), (1, 2, 0, 0, 0), (0, 1, 0, 1, 5), (1, 1, 1, 1, 0), (1, 2, 1, 2, 3)])],
        "symbol string, ts timestamp, open double, high double, low double, close double, volume double")
    bars = bars.select(*[F.col(c).cast("double") if c not in ("symbol", "ts") else F.col(c) for c in bars.columns])
    out = FT.feat_trap(bars).orderBy("ts").collect()
    assert out[0]["upper_wick_ratio"] == 0.0  # zero range -> 0
    assert out[2]["price_return"] == 0.0  # x / 0 -> 0 in values
    assert out[2]["volume_divergence"] == 0  # volume change from 0 is +inf, not < 0
    assert out[1]["volume_change"] == 0.0  # 0 / 0 -> 0


def test_unknown_symbol_uses_default_params(spark):
    df = spark.createDataFrame([("ZZZ",), ("ETH-USD",)], "symbol string")
    rows = {r["symbol"]: r for r in with_asset_params(df).collect()}
    assert rows["ZZZ"]["breakout_lookback"] == 20 and rows["ETH-USD"]["breakout_lookback"] == 15


def test_smoothing_cross_70(spark):
    raw = [60.0, 90.0, 90.0, 90.0, 0.0, 95.0]
    df = spark.createDataFrame([("BTC-USD", T0 + dt.timedelta(minutes=i), r) for i, r in enumerate(raw)],
                               "symbol string, ts timestamp, risk_score double")
    out = AL.smoothed_risk(df).orderBy("ts").collect()
    for row, want in zip(out, sequential(raw, [True] * len(raw))):
        assert (row["smoothed_risk"], row["streak"], row["crossed_above"]) == (pytest.approx(want[0], abs=1e-12), *want[1:])


def sequential(raw, live):
    """The recurrence one row at a time: shown value, streak, crossing."""
    state, streak = 0.0, 0
    for r, on in zip(raw, live):
        new = r if state == 0.0 or not on else 0.35 * r + 0.65 * state
        streak = streak + 1 if on and new >= 70 else 0
        yield new, streak, on and state < 70 <= new
        state = new if on else 0.0


def test_suppressed_rows_unset_the_state_in_any_chunking(spark):
    import random

    r = random.Random(5)
    raw = [0.0 if r.random() < 0.2 else r.uniform(40, 110) for _ in range(400)]
    live = [r.random() > 0.15 for _ in raw]
    live[120:190] = [False] * 70  # more than a chunk
    df = spark.createDataFrame([(None, T0 + dt.timedelta(minutes=i), x, v) for i, (x, v) in enumerate(zip(raw, live))],
                               "symbol string, ts timestamp, risk_score double, is_live boolean")
    for plan in ({"plain": True}, {"chunk_rows": 7}, {"chunk_rows": 61}):
        out = AL.smoothed_risk(df, live="is_live", **plan).orderBy("ts").collect()
        assert len(out) == len(raw)
        for row, want in zip(out, sequential(raw, live)):
            assert (row["smoothed_risk"], row["streak"], row["crossed_above"]) == (pytest.approx(want[0], abs=1e-9), *want[1:])


def test_ema_is_exact_in_any_chunking(spark):
    import random

    r = random.Random(6)
    price = [r.uniform(1, 100) for _ in range(300)]
    df = spark.createDataFrame([("A", T0 + dt.timedelta(minutes=i), x, 1.0) for i, x in enumerate(price)],
                               "symbol string, ts timestamp, price double, volume double")
    want = [price[0]]
    for x in price[1:]:
        want.append(0.2 * x + 0.8 * want[-1])
    for plan in ({"plain": True}, {"chunk_rows": 9}, {"chunk_rows": 100}):
        out = FT.feat_chart(df, **plan).orderBy("ts").collect()
        assert [x["ema9"] for x in out] == pytest.approx(want, abs=1e-9)


def test_require_columns():
    class D:
        columns = ["a"]
    with pytest.raises(ValueError):
        FT.require_columns(D(), ["a", "b"])


def test_snapshot_contract(spark):
    snap = R.risk_snapshot(frame(spark, walk(120))).first().asDict()
    for k in ("risk_score", "risk_level", "trap_type", "reasons", "control", "components"):
        assert k in snap
    assert 0.0 <= snap["risk_score"] <= 100.0


def test_breakout_failure_and_failed_retest(spark):
    """New high above the previous 20-bar high, close back below it."""
    closes = [100.0] * 25 + [103.0, 99.0]
    highs = [101.0] * 25 + [104.0, 102.0]
    rows = [("BTC-USD", T0 + dt.timedelta(hours=i), c, h, c - 1.0, c, 10.0) for i, (c, h) in enumerate(zip(closes, highs))]
    bars = spark.createDataFrame(rows, "symbol string, ts timestamp, open double, high double, low double, close double, volume double")
    out = FT.feat_trap(bars).orderBy("ts").collect()
    # bar 26: high 102 > previous high 104? no; bar 25: high 104 > 101 but close 103 > 101 -> no failure
    assert out[25]["breakout_failure"] == 0
    # bar 26: previous 20-bar high is 104; high 102 is not above it -> no breakout failure,
    # but the previous close (103) was above the high before it (101) and close 99 < 104 -> failed retest
    assert out[26]["breakout_failure"] == 0 and out[26]["failed_retest"] == 1
    assert out[0]["upper_wick_ratio"] == pytest.approx(0.5)
    assert out[26]["pv_correlation"] == 0.0  # constant volume: no correlation, no error


def _bars(spark, closes, volumes):
    rows = [("BTC-USD", T0 + dt.timedelta(hours=i), float(c), float(c) + 1.0 if c else 0.0, max(float(c) - 1.0, 0.0), float(c), float(v))
            for i, (c, v) in enumerate(zip(closes, volumes))]
    return spark.createDataFrame(rows, "symbol string, ts timestamp, open double, high double, low double, close double, volume double")


EDGE = {
    "flat_30": ([10.0] * 30, [5.0] * 30),
    "rising_30": ([10.0 + i for i in range(30)], [5.0 + i for i in range(30)]),
    "zero_mid_30": ([10.0] * 12 + [0.0] * 3 + [10.0] * 15, [5.0] * 10 + [0.0] * 5 + [5.0] * 15),
}


@pytest.mark.parametrize("case", sorted(EDGE))
def test_edge_tables_run_clean(spark, case):
    """Constant, monotone and zero-valued series: every feature set and
    scorer runs under ANSI mode and yields no NaN or infinity."""
    import math

    from tidemark.operators import stats as ST

    closes, vols = EDGE[case]
    bars = _bars(spark, closes, vols)
    frame = bars.select("symbol", "ts", F.col("close").alias("price"), "volume")
    outs = [FT.feat_core(bars), FT.feat_daily(bars), FT.lbl_trap(bars), FT.feat_tick(frame), FT.feat_engine(frame),
            FT.feat_trap(bars), FT.feat_asset(bars), FT.feat_chart(frame), R.trap_report(FT.feat_trap(bars)),
            R.asset_report(FT.feat_asset(bars)), R.rt_frame(frame).drop("diagnostics", "components", "reasons"),
            AL.smoothed_risk(R.rt_frame(frame).select("symbol", "ts", "risk_score")),
            ST.centered_band(R.rt_frame(frame).select("symbol", "ts", "risk_score"), "risk_score")]
    for df in outs:
        for r in df.collect():
            for k, v in r.asDict().items():
                if isinstance(v, float):
                    assert not math.isnan(v) and not math.isinf(v), (case, k)
