"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables through the canonical views and runs a
library operator over the whole input. Nested outputs are flattened to
scalars and doubles are rounded to 6 places so the DuckDB reference SQL
(``tidemark.oracle``) can be compared value by value.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampType

from tidemark.operators import features as FT
from tidemark.operators import risk as R
from tidemark.sources import fixtures as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Row-numbering cells for tick-level series: one second per cell keeps a
# cell small even for the hottest symbol (bars use the weekly default).
TICK_BUCKET_SECONDS = 1


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places; timestamps as timestamp_ntz (naive UTC)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def flat_reasons(arr: Column, n: int = 3, conf: bool = True) -> list[Column]:
    cols = []
    for i in range(n):
        e = F.get(arr, i)
        if conf:
            cols += [e["reason"].alias(f"reason_{i + 1}"), e["confidence"].alias(f"confidence_{i + 1}")]
        else:
            cols.append(e.alias(f"reason_{i + 1}"))
    return cols


RT_FLAT = ["symbol", "ts", "bar_no", "risk_score", "risk_level", "trap_type", "control",
           "structure_failure", "volume_behavior", "momentum_exhaustion", "anomaly_component", "main_reason"]


def rt_flat(df: DataFrame) -> DataFrame:
    return df.select(*RT_FLAT, *flat_reasons(F.col("reasons")))


# ---------------------------------------------------------------- flagship
@query("risk_snapshot")
def q_risk_snapshot(spark, d):
    return finish(rt_flat(R.risk_snapshot(X.frame_1h(spark, d))))


@query("risk_score_rt")
def q_risk_score_rt(spark, d):
    return finish(rt_flat(R.rt_frame(X.frame_1h(spark, d))))


# ---------------------------------------------------------------- features
def _bars_li(spark, d):
    return X.bars_daily_li(spark, d)


@query("feat_core")
def q_feat_core(spark, d):
    return finish(FT.feat_core(X.bars_1h(spark, d)))


@query("feat_daily")
def q_feat_daily(spark, d):
    return finish(FT.feat_daily(_bars_li(spark, d)))


@query("lbl_trap")
def q_lbl_trap(spark, d):
    return finish(FT.lbl_trap(_bars_li(spark, d)))


@query("feat_tick")
def q_feat_tick(spark, d):
    return finish(FT.feat_tick(X.frame_1h(spark, d)))


@query("feat_engine")
def q_feat_engine(spark, d):
    return finish(FT.feat_engine(X.frame_1h(spark, d)))


@query("feat_trap")
def q_feat_trap(spark, d):
    return finish(FT.feat_trap(X.bars_1h(spark, d)))


@query("feat_asset")
def q_feat_asset(spark, d):
    return finish(FT.feat_asset(X.bars_1h(spark, d)))


@query("feat_chart")
def q_feat_chart(spark, d):
    fr = _bars_li(spark, d).select("symbol", "ts", F.col("close").alias("price"), "volume")
    return finish(FT.feat_chart(fr))


# ------------------------------------------------------ base series windows
from tidemark.functions import series as S  # noqa: E402
from tidemark.functions import scalar as SC  # noqa: E402
from tidemark.plans.partitioning import over_series  # noqa: E402


def series_cols(df: DataFrame, make: Callable, halo: int, keep=("symbol", "ts"), lookahead: int = 0) -> DataFrame:
    """Run ``make(spec) -> {name: Column}`` chunk-parallel over ``df``."""
    def build(d, s):
        for name, c in make(s).items():
            d = d.withColumn(name, c)
        return d
    out = over_series(df, build, halo=halo, lookahead=lookahead)
    names = list(make(S.Series()).keys())
    return out.select(*keep, *names)


def li_bars(spark, d):
    return X.bars_daily_li(spark, d)


@query("win_pct_change")
def q_win_pct_change(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {
        "close_change": S.pct_change("close", s), "volume_change": S.pct_change("volume", s)}, 2))


@query("win_pct_change_guarded")
def q_win_pct_change_guarded(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {"volume_change": S.pct_change_guarded("volume", s)}, 2))


@query("win_roc_n")
def q_win_roc_n(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {
        "roc_4": S.pct_change("close", s, 4), "roc_5": S.pct_change("close", s, 5)}, 6))


@query("win_rolling_max_min")
def q_win_rolling_max_min(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {
        "max_high_20": S.rolling_max("high", 20, s), "min_low_20": S.rolling_min("low", 20, s),
        "max_close_20": S.rolling_max("close", 20, s)}, 20))


@query("win_prev_high")
def q_win_prev_high(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {
        "prev_high_20": S.rolling_prev(F.max, "high", 20, s),
        "prev_high_20_min5": S.rolling_prev(F.max, "close", 20, s, 5),
        "prev_high_filled": F.coalesce(S.rolling_prev(F.max, "close", 20, s), F.col("close"))}, 21))


@query("win_rolling_mean")
def q_win_rolling_mean(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {
        "volume_mean_20": S.rolling_mean("volume", 20, s), "close_mean_8_min5": S.rolling_mean("close", 8, s, 5),
        "up_share_5": S.flag_mean(F.col("close") > F.col("open"), 5, s)}, 20))


@query("win_rolling_sum")
def q_win_rolling_sum(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {"volume_sum_3": S.rolling_sum("volume", 3, s)}, 3))


@query("win_rolling_std")
def q_win_rolling_std(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {
        "close_std_20": S.rolling_std("close", 20, s), "close_std_10": S.rolling_std("close", 10, s)}, 20))


@query("win_rolling_corr")
def q_win_rolling_corr(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {
        "corr_20": S.rolling_corr("close", "volume", 20, s), "corr_10_min10": S.rolling_corr("close", "volume", 10, s, 10)}, 20))


@query("win_shift")
def q_win_shift(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {
        "prev_close": S.lag("close", s), "was_up": SC.truth(S.lag(F.col("close") > F.col("open"), s)).cast("int")}, 2))


@query("win_rsi_zero")
def q_win_rsi_zero(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {"rsi_14": S.rsi("close", s, 14, "zero")}, 16))


@query("win_rsi_neutral")
def q_win_rsi_neutral(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {"rsi_14": S.rsi("close", s, 14, "neutral")}, 16))


@query("win_ema")
def q_win_ema(spark, d):
    from tidemark.plans.recurrence import Ema, with_emas

    spans = [Ema("ema9", "close", 2.0 / 10.0), Ema("ema21", "close", 2.0 / 22.0)]
    out = over_series(li_bars(spark, d).select("symbol", "ts", "close"), lambda df, s: with_emas(df, s, spans), halo=0, checkpoint=True)
    return finish(out.select("symbol", "ts", "ema9", "ema21"))


@query("win_vwap")
def q_win_vwap(spark, d):
    from tidemark.plans.partitioning import running_totals

    def build(df, s):
        v = F.when(F.col("volume") == 0, F.lit(1.0)).otherwise(F.col("volume"))
        df = running_totals(df, s, {"_pv": F.col("close") * v, "_v": v})
        return df.withColumn("vwap", F.try_divide("_pv", "_v"))
    return finish(over_series(li_bars(spark, d), build, halo=0).select("symbol", "ts", "vwap"))


@query("win_rolling_minmax")
def q_win_rolling_minmax(spark, d):
    return finish(series_cols(li_bars(spark, d), lambda s: {"risk_pct": S.minmax_pct("close", s, 100)}, 100))


@query("win_extremes_120")
def q_win_extremes_120(spark, d):
    """Latest bar per symbol: change vs the previous bar (a single bar is its
    own previous), change % (0 on a zero base) and the 120-bar price range."""
    def cols(s):
        prev = F.coalesce(S.lag("close", s), F.col("close"))
        change = F.col("close") - prev
        return {"close": F.col("close"), "change": change,
                "change_pct": F.when(prev != 0, change / prev * 100.0).otherwise(F.lit(0.0)),
                "high_120": S.rolling_max("close", 120, s), "low_120": S.rolling_min("close", 120, s)}
    out = series_cols(li_bars(spark, d), cols, 120)
    return finish(R.latest_per_symbol(out))


@query("win_diff_clip")
def q_win_diff_clip(spark, d):
    ct = X.cumulative_ticks(spark, d)
    out = over_series(ct, lambda df, s: df.withColumn("volume_delta", S.diff_clip("volume", s)), halo=1,
                      order=("ts", "seq"), bucket_size=TICK_BUCKET_SECONDS)
    return finish(out.select("symbol", "ts", "seq", "volume", "volume_delta"))


@query("win_centered_band")
def q_win_centered_band(spark, d):
    from tidemark.operators.stats import centered_band

    rt = R.rt_frame(X.frame_1h(spark, d)).select("symbol", "ts", "risk_score")
    return finish(centered_band(rt, "risk_score"))


# ------------------------------------------------------------ risk pieces
from tidemark.operators import stats as ST  # noqa: E402
from tidemark.operators.params import supported, with_asset_params  # noqa: E402

COMP = ["structure_failure", "volume_behavior", "momentum_exhaustion"]


def _rt(spark, d):
    return R.rt_frame(X.frame_1h(spark, d))


@query("risk_components_rt")
def q_risk_components_rt(spark, d):
    return finish(_rt(spark, d).select("symbol", "ts", "bar_no", *COMP))


@query("risk_diagnostics_rt")
def q_risk_diagnostics_rt(spark, d):
    return finish(_rt(spark, d).select("symbol", "ts", "bar_no", "diagnostics.*"))


@query("risk_trap_type")
def q_risk_trap_type(spark, d):
    return finish(_rt(spark, d).select("symbol", "ts", "trap_type"))


@query("risk_reasons_rt")
def q_risk_reasons_rt(spark, d):
    """Reasons of every bar scoring >= 40. The anomaly input (a risk %) is the
    per-asset trap score here, so that the fixture reaches the reason band."""
    bars = X.bars_1h(spark, d)
    anom = R.asset_report(FT.feat_asset(bars)).select(
        "symbol", "ts", F.least(F.col("trap_risk_score"), F.lit(100.0)).alias("anom"))
    frame = bars.select("symbol", "ts", F.col("close").alias("price"), "volume").join(anom, ["symbol", "ts"])
    rt = R.rt_frame(frame, anomaly="anom")
    return finish(rt.select("symbol", "ts", F.posexplode("reasons").alias("pos", "r"))
                  .select("symbol", "ts", "pos", "r.reason", "r.confidence"))


@query("risk_control")
def q_risk_control(spark, d):
    return finish(_rt(spark, d).select("symbol", "ts", "control"))


@query("risk_sentiment")
def q_risk_sentiment(spark, d):
    return finish(_rt(spark, d).select("symbol", "ts", "control", R.sentiment(F.col("control")).alias("sentiment")))


@query("risk_main_reason")
def q_risk_main_reason(spark, d):
    return finish(R.risk_snapshot(X.frame_1h(spark, d)).select("symbol", "ts", "risk_score", "main_reason"))


@query("fn_component_share")
def q_fn_component_share(spark, d):
    return finish(R.component_share(_rt(spark, d)))


@query("fn_risk_band_snapshot")
def q_fn_risk_band_snapshot(spark, d):
    return finish(_rt(spark, d).select("symbol", "ts", "risk_score", SC.band_snapshot("risk_score").alias("band")))


@query("fn_risk_band_model")
def q_fn_risk_band_model(spark, d):
    return finish(_rt(spark, d).select("symbol", "ts", "risk_score", SC.band_model("risk_score").alias("band")))


@query("agg_risk_distribution")
def q_agg_risk_distribution(spark, d):
    return finish(ST.risk_distribution(_rt(spark, d), "risk_score"))


@query("agg_score_summary")
def q_agg_score_summary(spark, d):
    return finish(ST.score_summary(_rt(spark, d), "risk_score"))


@query("agg_validation_metrics")
def q_agg_validation_metrics(spark, d):
    return finish(ST.validation_metrics(_rt(spark, d), "risk_score", anomaly_pct=20.0, high_pct=15.0))


@query("agg_backtest_buckets")
def q_agg_backtest_buckets(spark, d):
    return finish(ST.backtest_buckets(_rt(spark, d).withColumn("pct", F.col("risk_score") * 4.0), "pct"))


def _trap(spark, d):
    return R.trap_report(FT.feat_trap(X.bars_1h(spark, d)))


@query("risk_components_trap")
def q_risk_components_trap(spark, d):
    return finish(_trap(spark, d).select("symbol", "ts", *COMP, "anomaly_score"))


@query("risk_score_trap")
def q_risk_score_trap(spark, d):
    return finish(_trap(spark, d).select("symbol", "ts", "trap_risk_score", "risk_level"))


@query("fn_risk_band_generic")
def q_fn_risk_band_generic(spark, d):
    return finish(_trap(spark, d).select("symbol", "ts", "trap_risk_score", SC.band_generic("trap_risk_score").alias("band")))


@query("risk_reasons_trap")
def q_risk_reasons_trap(spark, d):
    return finish(_trap(spark, d).select("symbol", "ts", F.posexplode("top_3_reasons").alias("pos", "reason")))


@query("risk_invalidation")
def q_risk_invalidation(spark, d):
    t = _trap(spark, d).select("symbol", "ts", F.lit("generic").alias("model"), F.posexplode("invalidated_by").alias("pos", "condition"))
    a = _asset(spark, d).select("symbol", "ts", F.lit("asset").alias("model"), F.posexplode("invalidated_by").alias("pos", "condition"))
    return finish(t.unionByName(a))


def _flat_report(df: DataFrame) -> DataFrame:
    return df.select(
        "symbol", "ts", "trap_risk_score", "risk_level", *COMP, "anomaly_score",
        *[F.get("top_3_reasons", i).alias(f"reason_{i + 1}") for i in range(3)],
        *[F.get("invalidated_by", i).alias(f"invalidated_{i + 1}") for i in range(2)],
    )


@query("risk_report_trap")
def q_risk_report_trap(spark, d):
    return finish(_flat_report(R.trap_report_latest(X.bars_1h(spark, d))))


def _asset(spark, d):
    return R.asset_report(FT.feat_asset(X.bars_1h(spark, d)))


@query("risk_components_asset")
def q_risk_components_asset(spark, d):
    return finish(_asset(spark, d).select("symbol", "ts", *COMP, "anomaly_score"))


@query("risk_score_asset")
def q_risk_score_asset(spark, d):
    return finish(_asset(spark, d).select("symbol", "ts", "trap_risk_score", "risk_level"))


@query("fn_risk_band_asset")
def q_fn_risk_band_asset(spark, d):
    return finish(_asset(spark, d).select("symbol", "ts", "trap_risk_score", SC.band_asset("trap_risk_score").alias("band")))


@query("risk_reasons_asset")
def q_risk_reasons_asset(spark, d):
    return finish(_asset(spark, d).select("symbol", "ts", F.posexplode("top_3_reasons").alias("pos", "reason")))


@query("risk_report_asset")
def q_risk_report_asset(spark, d):
    return finish(_flat_report(R.asset_report_latest(X.bars_1h(spark, d))))


@query("fn_high_risk_filter")
def q_fn_high_risk_filter(spark, d):
    a = _asset(spark, d).withColumn("band", SC.band_model("trap_risk_score"))
    hi = a.filter(F.col("band") == "Potential Market Trap")
    return finish(hi.select("symbol", "ts", "trap_risk_score",
                            (F.col("ts") - F.expr("INTERVAL 12 HOURS")).alias("span_start"),
                            (F.col("ts") + F.expr("INTERVAL 12 HOURS")).alias("span_end")))


# ------------------------------------------------------------ scalar fns
@query("fn_safe_divide")
def q_fn_safe_divide(spark, d):
    b = X.bars_1h(spark, d)
    return finish(b.select("symbol", "ts", SC.safe_divide(F.col("close") - F.col("open"), F.col("high") - F.col("low")).alias("body_share")))


@query("fn_clip01")
def q_fn_clip01(spark, d):
    b = X.bars_1h(spark, d)
    return finish(b.select("symbol", "ts", SC.clip01(F.try_divide(F.col("close") - F.col("open"), F.col("open")) * 10.0).alias("move01")))


@query("fn_clean_features")
def q_fn_clean_features(spark, d):
    raw = series_cols(X.bars_1h(spark, d), lambda s: {
        "price_return": S.pct_change("close", s), "volume_change": S.pct_change("volume", s),
        "volatility": S.rolling_std("close", 10, s)}, 10)
    # a feed may carry infinities and NaN: three hours of the day do
    hour = F.hour("ts")
    dirty = F.when(hour == 3, float("inf")).when(hour == 4, float("-inf")).when(hour == 5, float("nan"))
    names = ["price_return", "volume_change", "volatility"]
    return finish(raw.select("symbol", "ts", *[SC.fill0(F.coalesce(dirty, F.col(c))).alias(c) for c in names]))


MODEL_FEATURES = ["price_return", "volume_change", "volatility", "breakout_strength", "is_breakout", "pv_divergence"]


@query("fn_align_features")
def q_fn_align_features(spark, d):
    from tidemark.operators.anomaly import align_features

    f = FT.feat_daily(X.bars_daily_li(spark, d)).drop("is_breakout")  # one model column missing -> 0
    return finish(align_features(f, MODEL_FEATURES, ["symbol", "ts"]))


@query("fn_candle_shape")
def q_fn_candle_shape(spark, d):
    b = X.bars_1h(spark, d)
    return finish(b.select("symbol", "ts", SC.upper_wick_ratio("high", "close", "low").alias("upper_wick_ratio"),
                           SC.body_ratio("open", "close", "high", "low").alias("body_ratio")))


@query("fn_range_volatility")
def q_fn_range_volatility(spark, d):
    b = X.bars_daily_li(spark, d)
    return finish(b.select("symbol", "ts", SC.range_volatility("high", "low", "open").alias("volatility")))


# ------------------------------------------------------------------ joins
@query("join_asset_params")
def q_join_asset_params(spark, d):
    b = X.bars_1h(spark, d).unionByName(X.bars_daily_li(spark, d))
    p = with_asset_params(b.select("symbol", "ts", "close"))
    return finish(p.drop("breakout_reason", "volume_reason", "momentum_reason"))


@query("join_supported_symbols")
def q_join_supported_symbols(spark, d):
    b = X.bars_1h(spark, d).unionByName(X.bars_daily_li(spark, d))
    return finish(supported(b.select("symbol", "ts", "close")))


# ----------------------------------------------------------- aggregations
@query("agg_ohlcv_bars")
def q_agg_ohlcv_bars(spark, d):
    from tidemark.operators.bars import ohlcv_bars

    return finish(ohlcv_bars(X.ticks(spark, d), 60))


@query("agg_latest_bars")
def q_agg_latest_bars(spark, d):
    from tidemark.operators.bars import latest_bars

    return finish(latest_bars(X.ticks(spark, d), 500, 20, 3600))


@query("agg_resample_minute")
def q_agg_resample_minute(spark, d):
    from tidemark.operators.bars import resample_minute

    ct = over_series(X.cumulative_ticks(spark, d), lambda df, s: df.withColumn("volume_delta", S.diff_clip("volume", s)),
                     halo=1, order=("ts", "seq"), bucket_size=TICK_BUCKET_SECONDS)
    return finish(resample_minute(ct, 60))


@query("agg_feed_health")
def q_agg_feed_health(spark, d):
    from tidemark.operators.bars import feed_health

    return finish(feed_health(X.ticks(spark, d), "2024-01-30 23:50:00"))


@query("agg_label_count")
def q_agg_label_count(spark, d):
    return finish(ST.label_count(FT.lbl_trap(X.bars_daily_li(spark, d))))


@query("agg_scaler_fit")
def q_agg_scaler_fit(spark, d):
    return finish(ST.scaler_fit(FT.feat_engine(X.frame_1h(spark, d)), MODEL_FEATURES))


@query("agg_volume_cap")
def q_agg_volume_cap(spark, d):
    return finish(ST.volume_cap(X.bars_1h(spark, d).select("symbol", "ts", "volume")))


@query("agg_distinct_symbols")
def q_agg_distinct_symbols(spark, d):
    return finish(X.ticks(spark, d).select("symbol").distinct())


# ------------------------------------------------------- alerts and events
from tidemark.operators import alerts as AL  # noqa: E402
from tidemark.operators import merge as MG  # noqa: E402


def market_rows(spark, d) -> DataFrame:
    from tidemark.plans.partitioning import materialize

    bars = materialize(X.bars_1h(spark, d))  # ticks are scanned and aggregated once
    return materialize(AL.market_rows(bars))


@query("alert_rules")
def q_alert_rules(spark, d):
    m = market_rows(spark, d)
    return finish(AL.alert_rules(m.select("symbol", "ts", "risk_score", "change", "volume")))


@query("alert_volume_multiple")
def q_alert_volume_multiple(spark, d):
    return finish(AL.volume_multiple_alerts(X.bars_1h(spark, d)))


def _smoothed(spark, d, live=None):
    m = market_rows(spark, d)
    if live:
        m = m.withColumn("is_live", F.dayofmonth("ts") % 2 == 1)
    return AL.smoothed_risk(m, live="is_live" if live else None, written=True, index="bar_no")


SMOOTH_OUT = ["symbol", "ts", "risk_score", "smoothed_risk", "streak", "crossed_above", "is_critical", "display_level"]


@query("str_smoothed_risk")
def q_str_smoothed_risk(spark, d):
    return finish(_smoothed(spark, d).select(*SMOOTH_OUT))


@query("str_mode_suppress")
def q_str_mode_suppress(spark, d):
    return finish(_smoothed(spark, d, live=True).select(*SMOOTH_OUT, "is_live"))


@query("fn_risk_band_display")
def q_fn_risk_band_display(spark, d):
    return finish(_smoothed(spark, d).select("symbol", "ts", "streak", "smoothed_risk", "display_level"))


@query("event_threshold_cross")
def q_event_threshold_cross(spark, d):
    return finish(AL.threshold_cross_events(_smoothed(spark, d)))


@query("event_top10_history")
def q_event_top10_history(spark, d):
    return finish(AL.top_events(AL.threshold_cross_events(_smoothed(spark, d)), 10))


@query("event_change_log")
def q_event_change_log(spark, d):
    return finish(AL.change_log(_smoothed(spark, d), index="bar_no"))


def _alerts(spark, d):
    m = market_rows(spark, d)
    return AL.alert_rules(m.select("symbol", "ts", "risk_score", "change", "volume"))


@query("snk_alert_payload")
def q_snk_alert_payload(spark, d):
    return finish(AL.alert_payload(_alerts(spark, d)))


@query("snk_alert_history")
def q_snk_alert_history(spark, d):
    """Append, clear, append in parts, merge, and read the newest 50."""
    from tidemark.plans.partitioning import materialize

    alerts, path = materialize(_alerts(spark, d)), _scratch(spark, "alerts")
    SK.append_alert_history(alerts, path)
    SK.clear_alert_history(spark, path)
    for part in range(3):
        SK.append_alert_history(alerts.where(F.hour("ts") % 3 == part), path, keep=200, version=f"part-{part}")
        SK.append_alert_history(alerts.where(F.hour("ts") % 3 == part), path, keep=200, version=f"part-{part}")  # retried: appends nothing
    SK.compact_alert_history(spark, path)
    return finish(SK.read_alert_history(spark, path, 50))


# ------------------------------------------------------- sets and top-k
@query("sort_time")
def q_sort_time(spark, d):
    return finish(X.bars_daily_orders(spark, d).orderBy("symbol", "ts"))


@query("topk_latest_row")
def q_topk_latest_row(spark, d):
    return finish(R.latest_per_symbol(X.bars_daily_orders(spark, d)))


@query("topk_tail_n")
def q_topk_tail_n(spark, d):
    return finish(MG.tail_n(X.bars_1h(spark, d), 180))


@query("set_union_symbols")
def q_set_union_symbols(spark, d):
    return finish(MG.union_all(X.bars_1h(spark, d), X.bars_daily_li(spark, d), X.bars_daily_orders(spark, d)))


@query("set_merge_precedence")
def q_set_merge_precedence(spark, d):
    hist, live = X.history_live(spark, d)
    return finish(MG.merge_precedence(hist, live, 180))


@query("set_source_fallback")
def q_set_source_fallback(spark, d):
    hist, live = X.history_live(spark, d)
    return finish(MG.source_fallback(live.filter(F.col("symbol") != "XRP-USD"), hist))


@query("split_train_validation")
def q_split_train_validation(spark, d):
    return finish(MG.split_by_time(X.bars_daily_li(spark, d).select("symbol", "ts", "close"), 0.2))


# ------------------------------------------------------- sources / feeds
from tidemark.sources import feeds as FD  # noqa: E402


@query("src_ticker_json")
def q_src_ticker_json(spark, d):
    return finish(FD.normalize_ticker_json(X.raw_ticker_json(spark, d)))


@query("src_trade_json")
def q_src_trade_json(spark, d):
    return finish(FD.normalize_trade_json(X.raw_trade_json(spark, d)))


@query("src_kline_array")
def q_src_kline_array(spark, d):
    return finish(FD.normalize_klines(X.raw_kline_json(spark, d)).drop("day"))


@query("src_order_book_ladder")
def q_src_order_book_ladder(spark, d):
    return finish(FD.order_book_ladder(X.order_book(spark, d)))


@query("src_symbol_normalize")
def q_src_symbol_normalize(spark, d):
    t = X.ticks(spark, d).select("symbol")
    ex = FD.exchange_symbol(F.col("symbol"))
    raw = t.select(F.col("symbol").alias("raw")).union(t.select(ex.alias("raw"))).union(t.select(F.lower(ex).alias("raw"))).distinct()
    return finish(FD.normalize_symbols(raw))


@query("src_daily_dialect")
def q_src_daily_dialect(spark, d):
    b = X.bars_daily_li(spark, d).select(F.col("ts").alias("Date"), F.col("open").alias("Open"), F.col("high").alias("High"),
                                         F.col("low").alias("Low"), F.col("close").alias("Close"), F.col("volume").alias("Volume"), "symbol")
    return finish(FD.daily_dialect(b, "symbol"))


@query("src_coerce_types")
def q_src_coerce_types(spark, d):
    raw = X.raw_lineitem_text(spark, d)
    return finish(FD.coerce_types(raw, ["shipdate"], ["quantity", "extendedprice"]))




@query("src_bars_file")
def q_src_bars_file(spark, d):
    """Bars written as a CSV file table, read with the given schema, checked and sorted."""
    path = _scratch(spark, "bars-csv")
    SK.write_table(X.bars_daily_orders(spark, d), path, fmt="csv")
    return finish(FT.require_columns(FD.read_bars(spark, path, "csv"), FT.BAR_COLS).orderBy("symbol", "ts"))


# ------------------------------------------------------------ anomaly model
from tidemark.operators import anomaly as AN  # noqa: E402


def _features(spark, d):
    return FT.feat_engine(X.frame_1h(spark, d))


def _model(spark, d):
    from tidemark.plans.partitioning import materialize

    f = materialize(_features(spark, d))  # read by the scaler, the sampling and the scoring
    model, stats = AN.train(f)
    return f, model, stats


@query("ml_scale")
def q_ml_scale(spark, d):
    f = _features(spark, d)
    return finish(AN.scale(f.select("symbol", "ts", *AN.MODEL_FEATURES), AN.scaler_stats(f, AN.MODEL_FEATURES)))


@query("ml_iforest_fit")
def q_ml_iforest_fit(spark, d):
    return finish(_model(spark, d)[1]["nodes"])


@query("ml_iforest_score")
def q_ml_iforest_score(spark, d):
    f, model, stats = _model(spark, d)
    return finish(AN.score_frame(f, model, stats).select("symbol", "ts", "anomaly_score"))


@query("ml_latest_risk")
def q_ml_latest_risk(spark, d):
    f, model, stats = _model(spark, d)
    return finish(AN.latest_risk(AN.score_frame(f, model, stats)))


@query("ml_score_table")
def q_ml_score_table(spark, d):
    f, model, stats = _model(spark, d)
    t = AN.score_frame(f, model, stats)
    return finish(t.select("symbol", "ts", "price", "volume", *AN.MODEL_FEATURES, "anomaly_score", "risk_percentage",
                           "risk_level"))


def _scratch(spark, name: str) -> str:
    import uuid

    from tidemark.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@query("ml_retrain_job")
def q_ml_retrain_job(spark, d):
    """Two trainings into one registry: the first is promoted, an equal one after it is not."""
    from tidemark.operators import registry as RG
    from tidemark.plans.partitioning import materialize

    f, path = materialize(FT.feat_tick(X.frame_1h(spark, d))), _scratch(spark, "registry")
    first, second = RG.retrain(f, path), RG.retrain(f, path)
    both = first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
    return finish(both.drop("model"))


@query("snk_model")
def q_snk_model(spark, d):
    """The nodes of a saved and reloaded model."""
    from tidemark.operators import registry as RG

    f, model, stats = _model(spark, d)
    folder = RG.save_candidate(_scratch(spark, "registry"), model, stats, RG.score_windows(AN.score_frame(f, model, stats)), {"rows": stats["rows"]})
    return finish(RG.load_model(spark, folder)[0]["nodes"])


@query("risk_snapshot_ml")
def q_risk_snapshot_ml(spark, d):
    """Flagship with the anomaly term: model risk % feeds the snapshot."""
    f, model, stats = _model(spark, d)
    scored = AN.score_frame(f, model, stats).select("symbol", "ts", "price", "volume", "risk_percentage")
    return finish(rt_flat(R.risk_snapshot(scored, anomaly="risk_percentage")))


# --------------------------------------------------------------- streaming
from tidemark.streaming import jobs as SJ  # noqa: E402


@query("src_stream_files")
def q_src_stream_files(spark, d):
    """The given files as a stream, not copied."""
    return finish(SJ.run_available_now(SJ.tick_stream(spark, d), "ticks"))


@query("str_bars")
def q_str_bars(spark, d):
    return finish(SJ.run_available_now(SJ.stream_bars(SJ.tick_stream(spark, d)), "bars"))


@query("str_dedup")
def q_str_dedup(spark, d):
    t = SJ.tick_stream(spark, d)
    repolled = SJ.tick_stream(spark, d).filter(F.col("seq") % 5 == 0)
    return finish(SJ.run_available_now(SJ.stream_dedup(t.unionByName(repolled)), "dedup"))


def _in_event_time(spark, df, build, name):
    """Replay ``df`` in waves through an event-time job; its rows in time."""
    return SJ.run_waves(spark, SJ.write_waves(df, SJ.scratch(spark, name)), df.schema, build, f"{name}-out")[0]


@query("str_volume_delta")
def q_str_volume_delta(spark, d):
    return finish(_in_event_time(spark, X.cumulative_ticks(spark, d), SJ.stream_volume_delta, "volume-delta"))


@query("str_smoothed_risk_stream")
def q_str_smoothed_risk_stream(spark, d):
    m = market_rows(spark, d).select("symbol", "ts", "risk_score")
    return finish(_in_event_time(spark, m, SJ.stream_smoothed_risk, "smoothed"))


@query("str_score_window")
def q_str_score_window(spark, d):
    f, model, stats = _model(spark, d)
    sc = AN.score_frame(f, model, stats).select("symbol", "ts", "anomaly_score")
    return finish(_in_event_time(spark, sc, SJ.stream_score_window, "score-window"))


@query("str_micro_batch_scoring")
def q_str_micro_batch_scoring(spark, d):
    ev, base = X.table(spark, d, "events"), SJ.scratch(spark, "micro-batches")
    path = SJ.write_waves(ev, SJ.scratch(spark, "events-waves"), closing=False)
    for raw in SJ.waves(spark, path, SJ.EVENTS_SCHEMA):  # a restart from the checkpoint after each wave
        out = SJ.micro_batch_scorer(spark, SJ.events_to_ticks(raw), base=base)
    return finish(out.select("symbol", "ts", "risk_score", "risk_level", "trap_type", "control", *COMP,
                             *flat_reasons(F.col("reasons"))))


# ------------------------------------------------------------------ sinks
from tidemark import sinks as SK  # noqa: E402


@query("snk_features_partitioned")
def q_snk_features_partitioned(spark, d):
    path = _scratch(spark, "features")
    SK.write_partitioned(FT.feat_core(X.bars_1h(spark, d)), path)
    return finish(spark.read.parquet(path))


@query("snk_table")
def q_snk_table(spark, d):
    path = _scratch(spark, "labels")
    SK.write_table(FT.lbl_trap(X.bars_daily_li(spark, d)), path)
    return finish(spark.read.parquet(path))


@query("src_require_columns")
def q_src_require_columns(spark, d):
    """Schema check before any work: raises ValueError naming missing columns."""
    return finish(FT.require_columns(X.bars_1h(spark, d), FT.BAR_COLS))
