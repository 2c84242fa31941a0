"""Feature sets over ordered per-symbol series (one query each).

Each ``*_cols(df, spec)`` adds window columns over one shared spec (one
sort per chunk in the plan); the public function runs it through
:func:`tidemark.plans.over_series`, which splits every symbol into row
chunks with a look-back halo so no task holds a whole symbol.

Null rule of the source system: flags are computed before the final fill
(NULL compares as false); values end NULL -> 0. Divisions use ``try_divide``
so +-inf never appears (a zero base reads as NULL -> 0); where the source
compared an infinite ratio in a flag, the x/0 case is spelled out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import series as S
from tidemark.functions.scalar import (
    body_ratio, fill0, flag, range_volatility, ratio_gt, ratio_lt, safe_divide, upper_wick_ratio,
)
from tidemark.plans.partitioning import Series, over_series

BAR_COLS = ["symbol", "ts", "open", "high", "low", "close", "volume"]


def require_columns(df: DataFrame, required) -> DataFrame:
    """Raise ValueError naming the missing columns (schema check, no job)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def _fill(df: DataFrame, cols) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in cols], *[fill0(c).alias(c) for c in cols])


# ---------------------------------------------------------------- feat_core
CORE_OUT = ["price_return", "volume_change", "volatility", "breakout_strength",
            "pv_correlation", "price_momentum", "volume_momentum"]


def core_cols(df: DataFrame, s: Series) -> DataFrame:
    close, high, vol = F.col("close"), F.col("high"), F.col("volume")
    lc = S.lag("close", s)
    rh = S.rolling_max("high", 20, s)
    l4 = S.lag("close", s, 4)
    df = df.withColumns({
        "price_return": F.try_divide(close - lc, lc),
        "volume_change": S.pct_change_guarded("volume", s),
        "breakout_strength": F.try_divide(close - rh, rh),
        "price_momentum": F.try_divide(close - l4, l4),
        "volume_momentum": S.pct_change_guarded("volume", s, 4),
    })
    return df.withColumns({
        "volatility": S.rolling_std("price_return", 20, s),
        "pv_correlation": S.rolling_corr("price_return", "volume_change", 20, s),
    })


def feat_core(bars: DataFrame, **plan) -> DataFrame:
    require_columns(bars, BAR_COLS)
    out = over_series(bars.select(*BAR_COLS), core_cols, halo=24, **plan)
    return _fill(out, CORE_OUT)


# --------------------------------------------------------------- feat_daily
DAILY_OUT = ["price_return", "volume_change", "volatility", "rolling_max_20", "breakout_strength",
             "is_breakout", "pv_divergence"]


def daily_cols(df: DataFrame, s: Series) -> DataFrame:
    lc, lv = S.lag("close", s), S.lag("volume", s)
    rm = S.rolling_max("close", 20, s)
    df = df.withColumns({
        "price_return": S.pct_change("close", s),
        "volume_change": S.pct_change("volume", s),
        "volatility": range_volatility("high", "low", "open"),
        "rolling_max_20": rm,
        "breakout_strength": F.try_divide(F.col("close") - rm, rm),
        "pv_divergence": flag(ratio_gt("close", lc, 0.0) & ratio_lt("volume", lv, 0.0)),
    })
    return df.withColumn("is_breakout", flag(F.col("close") > S.lag("rolling_max_20", s)))


def feat_daily(bars: DataFrame, **plan) -> DataFrame:
    require_columns(bars, BAR_COLS)
    out = over_series(bars.select(*BAR_COLS), daily_cols, halo=24, **plan)
    return _fill(out, DAILY_OUT)


# ---------------------------------------------------------------- lbl_trap
def label_cols(df: DataFrame, s: Series, vol_max: float = 0.3, drop: float = 0.02, ahead: int = 3) -> DataFrame:
    df = daily_cols(df, s)
    fut = S.lead("close", s, ahead)
    lv = S.lag("volume", s)
    cond = (
        (F.col("is_breakout") == 1)
        & ratio_lt("volume", lv, vol_max)
        & (F.try_divide(F.col("close") - fut, F.col("close")) >= drop)
    )
    return df.withColumn("label", flag(cond))


def lbl_trap(bars: DataFrame, vol_max: float = 0.3, drop: float = 0.02, ahead: int = 3, **plan) -> DataFrame:
    """label = 1 if is_breakout and volume_change < vol_max and the close
    falls by >= ``drop`` over the next ``ahead`` rows; last rows 0."""
    require_columns(bars, BAR_COLS)
    out = over_series(bars.select(*BAR_COLS), lambda d, s: label_cols(d, s, vol_max, drop, ahead),
                      halo=24, lookahead=ahead, **plan)
    return _fill(out, DAILY_OUT)


# ----------------------------------------------------------------- feat_tick
TICK_OUT = ["price_return", "volume_change", "volatility", "breakout_strength", "is_breakout", "pv_divergence"]


def tick_cols(df: DataFrame, s: Series) -> DataFrame:
    lp, lv = S.lag("price", s), S.lag("volume", s)
    rm = S.rolling_max("price", 20, s)
    up = ratio_gt("price", lp, 0.0)
    down = ratio_lt("price", lp, 0.0)
    vup = ratio_gt("volume", lv, 0.0)
    vdown = ratio_lt("volume", lv, 0.0)
    df = df.withColumns({
        "price_return": S.pct_change("price", s),
        "volume_change": S.pct_change("volume", s),
        "_rm": rm,
        "breakout_strength": F.try_divide(F.col("price") - rm, rm),
        "pv_divergence": flag((up & vdown) | (down & vup)),
    })
    return df.withColumns({
        "volatility": S.rolling_std("price_return", 10, s),
        "is_breakout": flag(F.col("price") > S.lag("_rm", s)),
    }).drop("_rm")


def feat_tick(frame: DataFrame, **plan) -> DataFrame:
    """Features on a (symbol, ts, price, volume) frame; two-sided divergence."""
    require_columns(frame, ["symbol", "ts", "price", "volume"])
    out = over_series(frame.select("symbol", "ts", "price", "volume"), tick_cols, halo=24, **plan)
    return _fill(out, TICK_OUT).select("ts", "symbol", *TICK_OUT)


# --------------------------------------------------------------- feat_engine
ENGINE_OUT = ["price_return", "volume_change", "volatility", "breakout_strength", "is_breakout", "pv_divergence"]


def engine_cols(df: DataFrame, s: Series) -> DataFrame:
    """Returns filled with 0 *before* the windows; previous 20-row high,
    first row filled with its own price."""
    ret = fill0(S.pct_change("price", s))
    vchg = fill0(S.pct_change("volume", s))
    rm = F.coalesce(S.rolling_prev(F.max, "price", 20, s), F.col("price"))
    df = df.withColumns({"price_return": ret, "volume_change": vchg, "_rm": rm})
    return df.withColumns({
        "volatility": S.rolling_std("price_return", 10, s),
        "breakout_strength": F.try_divide(F.col("price") - F.col("_rm"), F.nullif(F.col("_rm"), F.lit(0.0))),
        "is_breakout": flag(F.col("price") > F.col("_rm")),
        "pv_divergence": flag((F.col("price_return") > 0) & (F.col("volume_change") < 0)),
    }).drop("_rm")


def feat_engine(frame: DataFrame, **plan) -> DataFrame:
    require_columns(frame, ["symbol", "ts", "price", "volume"])
    out = over_series(frame.select("symbol", "ts", "price", "volume"), engine_cols, halo=24, **plan)
    return _fill(out, ENGINE_OUT)


# ----------------------------------------------------------------- feat_trap
TRAP_OUT = ["price_return", "volume_change", "breakout_strength", "breakout_failure", "failed_retest",
            "upper_wick_ratio", "body_to_range_ratio", "volume_spike", "absorption_signal",
            "volume_divergence", "pv_correlation", "volume_spike_on_reversal", "gap_rejection",
            "price_momentum", "rsi_14", "rsi_overbought_fall", "fast_reversal", "momentum_fade"]


def trap_cols(df: DataFrame, s: Series, breakout_window: int = 20, corr_window: int = 10,
              volume_window: int = 20, momentum_window: int = 5, rsi_period: int = 14) -> DataFrame:
    c, h, o, v = F.col("close"), F.col("high"), F.col("open"), F.col("volume")
    lc, lv = S.lag("close", s), S.lag("volume", s)
    rh = S.rolling_max("high", breakout_window, s)
    ph = S.rolling_prev(F.max, "high", breakout_window, s)
    ph2 = F.max(h).over(s.rows(-(breakout_window + 1), -2))
    up = ratio_gt("close", lc, 0.0)
    down = ratio_lt("close", lc, 0.0)
    df = df.withColumns({
        "price_return": S.pct_change("close", s),
        "volume_change": S.pct_change("volume", s),
        "_up": up,
        "_down": down,
        "breakout_strength": safe_divide(c - rh, rh),
        "_ph": ph,
        "_ph2": ph2,
        "upper_wick_ratio": upper_wick_ratio("high", "close", "low"),
        "body_to_range_ratio": body_ratio("open", "close", "high", "low"),
        "volume_spike": flag(v > S.rolling_mean("volume", volume_window, s) * 1.5),
        "volume_divergence": flag(up & ratio_lt("volume", lv, 0.0)),
        "gap_rejection": flag((o > lc * 1.002) & (c < o)),
        "price_momentum": S.pct_change("close", s, momentum_window),
        "rsi_14": S.rsi("close", s, rsi_period, "zero"),
    })
    lag_up = S.lag("_up", s)
    lr = S.lag("price_return", s)
    return df.withColumns({
        "breakout_failure": flag((h > F.col("_ph")) & (c < F.col("_ph"))),
        "failed_retest": flag((lc > F.col("_ph2")) & (c < F.col("_ph"))),
        "absorption_signal": flag((F.col("volume_spike") == 1) & (F.col("body_to_range_ratio") < 0.3)),
        "pv_correlation": S.rolling_corr("price_return", "volume_change", corr_window, s, corr_window),
        "volume_spike_on_reversal": flag((F.col("volume_spike") == 1) & F.col("_down") & F.coalesce(lag_up, F.lit(False))),
        "rsi_overbought_fall": flag((F.col("rsi_14") > 70) & (F.col("rsi_14") - S.lag("rsi_14", s) < 0)),
        "fast_reversal": flag(F.coalesce(lag_up, F.lit(False)) & ((lr > 0.02) | lr.isNull()) & (F.col("price_return") < -0.02)),
        "momentum_fade": flag((F.col("price_momentum") < S.lag("price_momentum", s)) & F.col("_up")),
    }).drop("_up", "_down", "_ph", "_ph2")


def feat_trap(bars: DataFrame, **plan) -> DataFrame:
    """Trap features (fake breakouts, divergence, absorption, exhaustion)."""
    require_columns(bars, BAR_COLS)
    out = over_series(bars.select(*BAR_COLS), trap_cols, halo=40, **plan)
    return _fill(out, TRAP_OUT)


# --------------------------------------------------------------- feat_chart
def chart_cols(df: DataFrame, s: Series) -> DataFrame:
    from tidemark.plans.partitioning import running_totals
    from tidemark.plans.recurrence import Ema, with_emas

    v = F.when(F.col("volume") == 0, F.lit(1.0)).otherwise(F.col("volume"))
    df = with_emas(df, s, [Ema("ema9", "price", 2.0 / 10.0), Ema("ema21", "price", 2.0 / 22.0)])
    df = running_totals(df, s, {"_pv": F.col("price") * v, "_v": v})
    return df.withColumn("vwap", F.try_divide(F.col("_pv"), F.col("_v"))).drop("_pv", "_v")


def feat_chart(frame: DataFrame, q: float = 0.95, **plan) -> DataFrame:
    """EMA 9/21, cumulative VWAP (zero volume counted as 1) and the volume
    capped at its per-symbol ``q`` quantile (exact, linear interpolation)."""
    require_columns(frame, ["symbol", "ts", "price", "volume"])
    base = frame.select("symbol", "ts", "price", "volume")
    out = over_series(base, chart_cols, halo=0, checkpoint=not plan.get("plain", False), **plan)
    from tidemark.operators.stats import exact_quantile

    cap = exact_quantile(base, q, "symbol", "volume", out="_cap")
    return out.join(cap, "symbol", "left").withColumn("volume_plot", F.least(F.col("volume"), F.col("_cap"))).drop("_cap")


# ---------------------------------------------------------------- feat_asset
ASSET_OUT = ["price_return", "volume_change", "breakout_strength", "breakout_failure", "fake_breakout_prob",
             "volume_spike", "body_to_range", "absorption_signal", "volume_absorption_prob", "momentum_roc",
             "momentum_exhaustion", "momentum_exhaustion_prob", "reversal_velocity", "sharp_reversal",
             "volatility", "compression_ratio", "compression_to_expansion"]


def _per_param(param: str, make) -> "F.Column":
    """Frames need literal bounds: one frame per distinct registry value,
    picked per row by the row's parameter (all share one sort)."""
    from tidemark.operators.params import distinct_values

    vals = distinct_values(param)
    out = None
    for v in vals:
        e = make(v)
        out = F.when(F.col(param) == v, e) if out is None else out.when(F.col(param) == v, e)
    return out


def asset_cols(df: DataFrame, s: Series) -> DataFrame:
    c, h, o, v = F.col("close"), F.col("high"), F.col("open"), F.col("volume")
    rh = _per_param("breakout_lookback", lambda n: S.rolling_max("high", n, s))
    ph = _per_param("breakout_lookback", lambda n: S.rolling_prev(F.max, "high", n, s))
    df = df.withColumns({
        "price_return": S.pct_change("close", s),
        "volume_change": S.pct_change("volume", s),
        "breakout_strength": safe_divide(c - rh, rh),
        "_ph": ph,
        "volume_spike": flag(v > _per_param("absorption_window", lambda n: S.rolling_mean("volume", n, s)) * 1.5),
        "body_to_range": body_ratio("open", "close", "high", "low"),
        "momentum_roc": _per_param("momentum_window", lambda n: S.pct_change("close", s, n)) * 100.0,
        "volatility": F.try_divide(_per_param("compression_window", lambda n: S.rolling_std("high", n, s)), c),
    })
    roc, lroc = F.col("momentum_roc"), S.lag("momentum_roc", s)
    thr = F.col("momentum_threshold")
    df = df.withColumns({
        "breakout_failure": flag((h > F.col("_ph")) & (c < F.col("_ph"))),
        "absorption_signal": flag((F.col("volume_spike") == 1) & (F.col("body_to_range") < 0.3)),
        "reversal_velocity": _per_param("reversal_window", lambda n: S.rolling_sum("price_return", n, s)),
        "momentum_exhaustion": flag((roc > thr) & (lroc > thr) & (roc < lroc)),
        "_vmean": _per_param("compression_window", lambda n: S.rolling_mean("volatility", n, s)),
    })
    vol = F.col("volatility")
    return df.withColumns({
        "fake_breakout_prob": _per_param("reversal_window", lambda n: S.rolling_mean("breakout_failure", n, s)),
        "volume_absorption_prob": _per_param("absorption_window", lambda n: S.rolling_mean("absorption_signal", n, s)),
        "sharp_reversal": flag(F.col("reversal_velocity") < -F.col("breakout_threshold") / 100.0),
        "momentum_exhaustion_prob": _per_param("momentum_window", lambda n: S.rolling_mean("momentum_exhaustion", n, s)),
        "compression_ratio": F.try_divide(F.col("_vmean"), F.nullif(vol, F.lit(0.0))),
        "compression_to_expansion": flag(F.when(vol == 0, F.col("_vmean") > 0).otherwise(F.try_divide(F.col("_vmean"), vol) > 1.5)),
    }).drop("_ph", "_vmean")


def feat_asset(bars: DataFrame, **plan) -> DataFrame:
    """Per-asset trap features: windows and thresholds come from the
    registry row of each symbol (unknown symbols use the default row)."""
    from tidemark.operators.params import PARAM_COLUMNS, with_asset_params

    require_columns(bars, BAR_COLS)
    withp = with_asset_params(bars.select(*BAR_COLS))
    out = over_series(withp, asset_cols, halo=48, **plan)
    return _fill(out, ASSET_OUT).drop(*[c for c in PARAM_COLUMNS if c != "symbol"])
