"""Risk components, scores, trap types, reasons, invalidations, snapshots.

The source system scores one symbol's latest frame; here every bar is
scored with trailing windows (so the latest bar's row *is* the snapshot of
the frame ending there) and ``latest_per_symbol`` picks the newest row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import series as S
from tidemark.functions.scalar import (
    band_asset, band_generic, band_snapshot, clip01, fill0, truth,
)
from tidemark.operators.params import DEFAULT_SYMBOL, fill_template, with_asset_params
from tidemark.plans.partitioning import Series, over_series

# Trap type labels, reason texts, control labels.
TRAP_TYPES = {
    "structure_failure": "Breakout Failure Trap",
    "volume_behavior": "Distribution Trap",
    "momentum_exhaustion": "Fake Momentum Trap",
    "anomaly": "Liquidity Sweep Trap",
}
RT_REASONS = [
    "Price broke resistance but failed to hold",
    "Price rising without volume support",
    "Momentum exhausted after sharp push",
    "Anomalous behavior detected vs recent history",
]
GENERIC_REASONS = [
    "Breakout failed or rejected quickly",
    "Price rose without volume support (divergence)",
    "Momentum faded after a sharp move",
    "Anomaly model flagged unusual behavior",
]
ASSET_ANOMALY_REASON = "Anomaly model flagged unusual market behavior."
GENERIC_INVALIDATION = ["Rising volume confirms the move", "Price holds above the breakout zone"]
ASSET_INVALIDATION = ["Strong volume surge confirms the move.", "Price continues rising with strength."]
CONTROL = ["Buyers in Control", "Sellers in Control", "Neutral"]
MONITORING = "Monitoring..."

COMPONENTS = ["structure_failure", "volume_behavior", "momentum_exhaustion"]


def latest_per_symbol(df: DataFrame, key: str = "symbol", ts: str = "ts") -> DataFrame:
    """Newest row per key (row_number = 1 becomes a per-task group limit)."""
    w = Window.partitionBy(key).orderBy(F.col(ts).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def trap_type(s: Column, v: Column, m: Column, a: Column) -> Column:
    """Argmax of the four components; ties resolve s > v > m > a."""
    top = F.greatest(s, v, m, a)
    return (
        F.when(s == top, TRAP_TYPES["structure_failure"])
        .when(v == top, TRAP_TYPES["volume_behavior"])
        .when(m == top, TRAP_TYPES["momentum_exhaustion"])
        .otherwise(TRAP_TYPES["anomaly"])
    )


def ranked_reasons(cands: list[tuple[str, Column]], keep: float = 0.20, min_n: int = 2, max_n: int = 3) -> Column:
    """Stable sort by confidence desc, keep >= ``keep``; if fewer than
    ``min_n`` survive take the top ``min_n``; cap ``max_n``; confidence as
    a rounded percentage."""
    arr = F.array_sort(
        F.array(*[
            F.struct((F.lit(0.0) - c).alias("k"), F.lit(i).alias("o"), F.lit(t).alias("reason"), c.alias("c"))
            for i, (t, c) in enumerate(cands)
        ])
    )
    kept = F.filter(arr, lambda x: x["c"] >= keep)
    chosen = F.when(F.size(kept) < min_n, F.slice(arr, 1, min_n)).otherwise(F.slice(kept, 1, max_n))
    return F.transform(
        chosen, lambda x: F.struct(x["reason"].alias("reason"), F.round(clip01(x["c"]) * 100.0, 1).alias("confidence"))
    )


# ------------------------------------------------------------ realtime engine
def rt_cols(df: DataFrame, s: Series, anomaly: str | None = None) -> DataFrame:
    price, vol = F.col("price"), F.col("volume")
    pos = s.position()
    if "_bar_offset" in df.columns:  # scoring a tail: restore the series position
        pos = pos + F.col("_bar_offset")
    df = df.withColumns({
        "bar_no": pos,
        "_ret": fill0(S.pct_change("price", s)),
        "_vchg": fill0(S.pct_change("volume", s)),
        "_rh": S.rolling_prev(F.max, "price", 20, s, 5),
        "_max20": S.rolling_max("price", 20, s, 5),
        "_vmean20": S.rolling_mean("volume", 20, s, 5),
        "_rsi": S.rsi("price", s, 14, "neutral"),
    })
    rh = F.col("_rh")
    near_high = truth(price >= F.col("_max20") * 0.995)
    low_rel = truth(vol < F.col("_vmean20") * 0.9)
    lrsi = S.lag("_rsi", s)
    df = df.withColumns({
        "_bo": truth(price > rh),
        "_near_high": near_high,
        "_nhlv": near_high & low_rel,
        "_rsi_fall": truth((lrsi > 68) & (F.col("_rsi") < lrsi - 2)),
        "_mfade": truth(S.rolling_mean("_ret", 3, s, 3) < S.rolling_mean("_ret", 8, s, 5)),
        "_puvd": (F.col("_ret") > 0) & (F.col("_vchg") < 0),
    })
    df = df.withColumn("_bf", truth(S.lag("_bo", s)) & truth(price < rh))
    ret = F.col("_ret")
    full = F.col("bar_no") >= 25
    zero = F.lit(0.0)
    structure = clip01(0.7 * S.flag_mean(F.col("_bf"), 5, s) + 0.3 * S.flag_mean((ret < -0.002) & F.col("_near_high"), 5, s))
    volume = clip01(0.65 * S.flag_mean(F.col("_puvd"), 8, s) + 0.35 * S.flag_mean(F.col("_nhlv"), 8, s))
    momentum = clip01(0.6 * S.flag_mean(F.col("_rsi_fall"), 8, s) + 0.4 * S.flag_mean(F.col("_mfade"), 8, s))
    diag = {
        "breakout_failure_strength": S.flag_mean(F.col("_bf"), 8, s),
        "price_up_volume_down_strength": S.flag_mean(F.col("_puvd"), 8, s),
        "rsi_fall_strength": S.flag_mean(F.col("_rsi_fall"), 8, s),
        "near_high_low_volume_strength": S.flag_mean(F.col("_nhlv"), 8, s),
        "momentum_fade_strength": S.flag_mean(F.col("_mfade"), 8, s),
        "latest_rsi": F.col("_rsi"),
        "latest_return": ret,
        "latest_volume_change": F.col("_vchg"),
    }
    p5 = S.rolling_mean("_ret", 5, s)
    v5 = S.rolling_mean("_vchg", 5, s)
    control = (
        F.when(F.col("bar_no") < 10, CONTROL[2])
        .when((p5 > 0.0008) & (v5 >= -0.01), CONTROL[0])
        .when((p5 < -0.0008) & (v5 >= -0.01), CONTROL[1])
        .otherwise(CONTROL[2])
    )
    a = clip01(F.col(anomaly) / 100.0) if anomaly else F.lit(0.0)
    df = df.select(
        *[c for c in df.columns if not c.startswith("_")],
        F.when(full, structure).otherwise(zero).alias("structure_failure"),
        F.when(full, volume).otherwise(zero).alias("volume_behavior"),
        F.when(full, momentum).otherwise(zero).alias("momentum_exhaustion"),
        a.alias("anomaly_component"),
        F.when(full, F.struct(*[v.alias(k) for k, v in diag.items()])).alias("diagnostics"),
        control.alias("control"),
    )
    return df


def rt_score_cols(df: DataFrame) -> DataFrame:
    s, v, m, a = (F.col(c) for c in (*COMPONENTS, "anomaly_component"))
    ready = F.col("bar_no") >= 10
    weighted = (F.lit(0.35) * s + F.lit(0.25) * v + F.lit(0.20) * m + F.lit(0.20) * a) * 100.0
    score = F.when(ready, F.round(F.greatest(F.lit(0.0), F.least(weighted, F.lit(100.0))), 1)).otherwise(F.lit(0.0))
    d = F.col("diagnostics")
    dget = lambda k: F.coalesce(d[k], F.lit(0.0))
    cands = [
        (RT_REASONS[0], F.greatest(s, dget("breakout_failure_strength"))),
        (RT_REASONS[1], F.greatest(v, dget("price_up_volume_down_strength"))),
        (RT_REASONS[2], F.greatest(m, dget("rsi_fall_strength"))),
        (RT_REASONS[3], a),
    ]
    reasons = F.when(ready & (F.col("risk_score") >= 40), ranked_reasons(cands)).otherwise(
        F.array().cast("array<struct<reason:string,confidence:double>>")
    )
    df = df.withColumns({
        "risk_score": score,
        "trap_type": F.when(ready, trap_type(s, v, m, a)).otherwise(F.lit("Neutral")),
        "components": F.when(ready, F.struct(s.alias("structure_failure"), v.alias("volume_behavior"),
                                             m.alias("momentum_exhaustion"), a.alias("anomaly"))),
    })
    df = df.withColumns({"risk_level": band_snapshot("risk_score"), "reasons": reasons})
    return df.withColumn("main_reason", F.coalesce(F.get(F.col("reasons"), 0)["reason"], F.lit(MONITORING)))


def rt_frame(frame: DataFrame, anomaly: str | None = None, **plan) -> DataFrame:
    """Score every bar of a (symbol, ts, price, volume[, anomaly]) frame:
    components, diagnostics, control, risk score/level, trap type, reasons."""
    cols = ["symbol", "ts", "price", "volume"] + ([anomaly] if anomaly else [])
    out = over_series(frame.select(*cols), lambda d, s: rt_cols(d, s, anomaly), halo=40, **plan)
    return rt_score_cols(out)


# Longest look-back chain of rt_cols is 28 rows (8-row mean of a lagged flag on
# a 20-row high); the newest row of a tail this long scores like the full series.
SNAPSHOT_LOOKBACK = 28
SNAPSHOT_TAIL = 64


def _long_enough(tail: int, lookback: int) -> None:
    if tail <= lookback:
        raise ValueError(f"tail of {tail} rows: the newest row needs itself and {lookback} rows before it")


def risk_snapshot(frame: DataFrame, anomaly: str | None = None, tail: int = SNAPSHOT_TAIL, **plan) -> DataFrame:
    """Flagship: the full nested risk record of the newest bar per symbol.

    Only the newest ``tail`` bars of each symbol are scored: ``row_number <=
    tail`` runs as a per-task group limit before the shuffle, so the work is
    O(symbols x tail) after one pass, however long (or skewed) the history.
    The bar position is restored from the per-symbol count.
    """
    from tidemark.operators.merge import tail_n

    if tail is None:
        return latest_per_symbol(rt_frame(frame, anomaly, **plan))
    _long_enough(tail, SNAPSHOT_LOOKBACK)
    cols = ["symbol", "ts", "price", "volume"] + ([anomaly] if anomaly else [])
    counts = frame.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n"))
    recent = tail_n(frame.select(*cols), tail).join(counts, "symbol")
    recent = recent.withColumn("_bar_offset", F.col("_n") - F.least(F.col("_n"), F.lit(tail))).drop("_n")
    out = rt_score_cols(over_series(recent, lambda d, s: rt_cols(d, s, anomaly), halo=0, plain=True))
    return latest_per_symbol(out)


def sentiment(control: Column) -> Column:
    return F.when(control == CONTROL[0], "BULLISH").when(control == CONTROL[1], "BEARISH").otherwise("NEUTRAL")


def component_share(df: DataFrame) -> DataFrame:
    """Each component's share (in %) of the sum of positive components."""
    names = ["structure_failure", "volume_behavior", "momentum_exhaustion", "anomaly_component"]
    pos = [F.greatest(F.lit(0.0), F.coalesce(F.col(c), F.lit(0.0))) for c in names]
    total = pos[0] + pos[1] + pos[2] + pos[3]
    total = F.when(total <= 0, F.lit(1.0)).otherwise(total)
    labels = ["Structure", "Volume", "Momentum", "Anomaly"]
    parts = F.array(*[F.struct(F.lit(lbl).alias("component"), (p / total * 100.0).alias("share")) for lbl, p in zip(labels, pos)])
    return df.select("symbol", "ts", F.inline(parts))


# -------------------------------------------------------- generic trap model
def trap_components(feats: DataFrame, anomaly: str | None = None, spec: Series | None = None) -> DataFrame:
    """Structure / volume / momentum from trap features: 3-row flag means
    plus the current wick ratio and correlation; each clipped to [0, 1]."""
    s = spec or Series()
    fm = lambda c: F.avg(F.col(c).cast("double")).over(s.rows(-2, 0))
    a = clip01(F.col(anomaly)) if anomaly else F.lit(0.0)
    return feats.select(
        *feats.columns,
        clip01(0.5 * fm("breakout_failure") + 0.3 * fm("failed_retest") + 0.2 * F.col("upper_wick_ratio")).alias("structure_failure"),
        clip01(0.5 * fm("volume_divergence") + 0.2 * fm("volume_spike_on_reversal") + 0.3 * (F.col("pv_correlation") * -1.0)).alias("volume_behavior"),
        clip01(0.4 * fm("fast_reversal") + 0.3 * fm("rsi_overbought_fall") + 0.3 * fm("momentum_fade")).alias("momentum_exhaustion"),
        a.alias("anomaly_score"),
    )


def trap_score(weights: dict | None = None) -> Column:
    w = {"structure_failure": 0.35, "volume_behavior": 0.25, "anomaly_score": 0.15, "momentum_exhaustion": 0.25}
    w.update(weights or {})
    s = (F.lit(w["structure_failure"]) * F.col("structure_failure") + F.lit(w["volume_behavior"]) * F.col("volume_behavior")
         + F.lit(w["anomaly_score"]) * F.col("anomaly_score") + F.lit(w["momentum_exhaustion"]) * F.col("momentum_exhaustion"))
    return F.round(s * 100.0, 1)


def trap_reasons() -> Column:
    comps = [("structure_failure", 0.4), ("volume_behavior", 0.4), ("momentum_exhaustion", 0.4), ("anomaly_score", 0.6)]
    arr = F.array(*[
        F.when(F.col(c) > t, F.struct((F.lit(0.0) - F.col(c)).alias("k"), F.lit(i).alias("o"), F.lit(GENERIC_REASONS[i]).alias("r")))
        for i, (c, t) in enumerate(comps)
    ])
    return F.transform(F.slice(F.array_sort(F.array_compact(arr)), 1, 3), lambda x: x["r"])


def trap_invalidation() -> Column:
    return F.array_compact(F.array(
        F.when(F.col("volume_change") > 0, F.lit(GENERIC_INVALIDATION[0])),
        F.when(F.col("breakout_strength") > 0, F.lit(GENERIC_INVALIDATION[1])),
    ))


def trap_report(feats: DataFrame, anomaly: str | None = None, weights: dict | None = None, **plan) -> DataFrame:
    """Per bar: score, level, top-3 reasons, invalidations, components."""
    comp = over_series(feats, lambda d, s: trap_components(d, anomaly, s), halo=4, **plan)
    comp = comp.withColumns({"trap_risk_score": trap_score(weights), "top_3_reasons": trap_reasons(),
                             "invalidated_by": trap_invalidation()})
    return comp.withColumn("risk_level", band_generic("trap_risk_score"))


# ------------------------------------------------------------ per-asset model
def asset_components(feats: DataFrame, anomaly: str | None = None) -> DataFrame:
    a = clip01(F.col(anomaly)) if anomaly else F.lit(0.0)
    c = F.col
    # the per-bar exhaustion flag keeps its value under another name
    feats = feats.withColumnRenamed("momentum_exhaustion", "momentum_exhaustion_flag")
    return feats.select(
        *feats.columns,
        clip01(0.5 * c("fake_breakout_prob") + 0.3 * c("sharp_reversal") + 0.2 * c("compression_to_expansion")).alias("structure_failure"),
        clip01(0.6 * c("volume_absorption_prob") + 0.4 * c("compression_ratio")).alias("volume_behavior"),
        clip01(0.5 * c("momentum_exhaustion_prob") + 0.3 * (c("reversal_velocity") * -1.0) + 0.2 * c("compression_to_expansion")).alias("momentum_exhaustion"),
        a.alias("anomaly_score"),
    )


def asset_score(clip_100: bool = False) -> Column:
    s, v, m, a = (F.col(x) for x in ("structure_failure", "volume_behavior", "momentum_exhaustion", "anomaly_score"))
    base = F.col("w_structure") * s + F.col("w_volume") * v + F.col("w_momentum") * m + F.col("w_anomaly") * a
    plain = s + v + m + a
    spikes = (s > 0.6).cast("int") + (v > 0.6).cast("int") + (m > 0.6).cast("int") + (a > 0.6).cast("int")
    amplified = F.when(spikes >= 2, F.least(F.lit(1.0), plain * 1.3)).otherwise(plain)
    final = F.greatest(base, amplified)
    if clip_100:
        final = F.least(final, F.lit(1.0))
    return F.round(final * 100.0, 1)


def asset_reasons() -> Column:
    c = F.col
    bt = fill_template(c("breakout_reason"), lookback=c("breakout_lookback"), threshold=c("breakout_threshold"),
                       reversal=c("reversal_window"), window=c("absorption_window"))
    vt = fill_template(c("volume_reason"), window=c("absorption_window"), lookback=c("breakout_lookback"),
                       threshold=c("breakout_threshold"), reversal=c("reversal_window"))
    mt = fill_template(c("momentum_reason"), threshold=c("momentum_threshold"), window=c("momentum_window"),
                       lookback=c("breakout_lookback"), reversal=c("reversal_window"))
    return F.slice(F.array_compact(F.array(
        F.when(c("structure_failure") > 0.5, bt),
        F.when(c("volume_behavior") > 0.5, vt),
        F.when(c("momentum_exhaustion") > 0.5, mt),
        F.when(c("anomaly_score") > 0.6, F.lit(ASSET_ANOMALY_REASON)),
    )), 1, 3)


def asset_invalidation() -> Column:
    return F.array_compact(F.array(
        F.when(F.col("volume_change") > 0.2, F.lit(ASSET_INVALIDATION[0])),
        F.when(F.col("price_return") > 0.02, F.lit(ASSET_INVALIDATION[1])),
    ))


def asset_report(feats: DataFrame, anomaly: str | None = None, clip_100: bool = False) -> DataFrame:
    """Per bar: asset-weighted score with spike amplification, level,
    templated reasons, invalidations, components."""
    from tidemark.operators.params import PARAM_COLUMNS

    withp = with_asset_params(asset_components(feats, anomaly))
    out = withp.withColumns({"trap_risk_score": asset_score(clip_100), "top_3_reasons": asset_reasons(),
                             "invalidated_by": asset_invalidation()})
    out = out.withColumn("risk_level", band_asset("trap_risk_score"))
    return out.drop(*[c for c in PARAM_COLUMNS if c != "symbol"])


__all__ = [n for n in dir() if not n.startswith("_")] + ["DEFAULT_SYMBOL"]


# Longest look-back chains: per-asset features 39 rows (20-row mean of a
# 20-row std), trap features + 3-row component means 24 rows.
REPORT_LOOKBACK = 39
REPORT_TAIL = 64


def trap_report_latest(bars: DataFrame, anomaly: str | None = None, weights: dict | None = None,
                       tail: int = REPORT_TAIL) -> DataFrame:
    """Generic trap report of the newest bar per symbol, computed on the
    newest ``tail`` bars only (group-limited before the shuffle; exact for
    the newest bar because the tail is longer than every look-back)."""
    from tidemark.operators.features import feat_trap
    from tidemark.operators.merge import tail_n

    _long_enough(tail, REPORT_LOOKBACK)
    recent = tail_n(bars, tail)
    return latest_per_symbol(trap_report(feat_trap(recent, plain=True), anomaly, weights, plain=True))


def asset_report_latest(bars: DataFrame, anomaly: str | None = None, tail: int = REPORT_TAIL) -> DataFrame:
    """Per-asset report of the newest bar per symbol from the newest ``tail`` bars."""
    from tidemark.operators.features import feat_asset
    from tidemark.operators.merge import tail_n

    _long_enough(tail, REPORT_LOOKBACK)
    return latest_per_symbol(asset_report(feat_asset(tail_n(bars, tail), plain=True), anomaly))
