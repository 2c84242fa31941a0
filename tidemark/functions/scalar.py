"""Scalar column functions: safe arithmetic, clamps, bands, candle shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num, den, default: float = 0.0) -> Column:
    """num / den, ``default`` when den == 0; a NULL operand stays NULL."""
    num, den = col(num), col(den)
    return F.when(den == 0, F.lit(float(default))).otherwise(F.try_divide(num, den))


def clip01(x) -> Column:
    """Clamp to [0, 1]; NULL -> 0 (inputs are zero-filled upstream)."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(col(x).cast("double"), F.lit(0.0))))


def clip(x, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), col(x)))


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int, NULL counts as false (pandas NaN comparisons)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def truth(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def fill0(x) -> Column:
    """NULL, NaN and +-inf -> 0 (the comparison is false for each of them)."""
    return F.when(F.abs(col(x)) < F.lit(float("inf")), col(x)).otherwise(F.lit(0))


def ratio_change(x, base) -> Column:
    """x / base - 1, NULL when base is 0 or NULL."""
    return F.try_divide(col(x), col(base)) - F.lit(1.0)


def ratio_gt(x, base, t: float) -> Column:
    """Truth of ``x / base - 1 > t`` with x/0 read as +-inf (pandas)."""
    x, base = col(x), col(base)
    return truth(F.when(base == 0, x > 0).otherwise(ratio_change(x, base) > F.lit(t)))


def ratio_lt(x, base, t: float) -> Column:
    """Truth of ``x / base - 1 < t`` with x/0 read as +-inf (pandas)."""
    x, base = col(x), col(base)
    return truth(F.when(base == 0, x < 0).otherwise(ratio_change(x, base) < F.lit(t)))


def upper_wick_ratio(high, close, low) -> Column:
    rng = col(high) - col(low)
    return F.try_divide(col(high) - col(close), F.nullif(rng, F.lit(0.0)))


def body_ratio(open_, close, high, low) -> Column:
    rng = col(high) - col(low)
    return F.try_divide(F.abs(col(close) - col(open_)), F.nullif(rng, F.lit(0.0)))


def range_volatility(high, low, open_) -> Column:
    return F.try_divide(col(high) - col(low), col(open_))


# ---- risk bands (four scales in the source system, kept apart) -----------
# Band labels of the four scales, low to high.
MODEL_BANDS = ["Normal", "Suspicious", "Potential Market Trap"]
SNAPSHOT_BANDS = ["LOW", "ELEVATED", "CRITICAL"]
GENERIC_BANDS = ["Low", "Medium", "High"]
ASSET_BANDS = ["Low", "Medium", "High"]
DISPLAY_BANDS = ["LOW", "ELEVATED", "CRITICAL"]
LOG_LEVELS = ["NORMAL", "ELEVATED", "CRITICAL"]


def band_model(risk_pct, include_lowest: bool = False) -> Column:
    """(0,30] Normal, (30,70] Suspicious, (70,100] Potential Market Trap."""
    r = col(risk_pct)
    low_ok = (r >= 0) if include_lowest else (r > 0)
    return (
        F.when(low_ok & (r <= 30), MODEL_BANDS[0])
        .when((r > 30) & (r <= 70), MODEL_BANDS[1])
        .when((r > 70) & (r <= 100), MODEL_BANDS[2])
    )


def band_snapshot(score) -> Column:
    s = col(score)
    return F.when(s >= 70, SNAPSHOT_BANDS[2]).when(s >= 40, SNAPSHOT_BANDS[1]).otherwise(SNAPSHOT_BANDS[0])


def band_generic(score) -> Column:
    s = col(score)
    return F.when(s >= 70, GENERIC_BANDS[2]).when(s >= 40, GENERIC_BANDS[1]).otherwise(GENERIC_BANDS[0])


def band_asset(score) -> Column:
    s = col(score)
    return F.when(s >= 80, ASSET_BANDS[2]).when(s >= 50, ASSET_BANDS[1]).otherwise(ASSET_BANDS[0])


def band_display(streak, smoothed) -> Column:
    return F.when(col(streak) >= 3, DISPLAY_BANDS[2]).when(col(smoothed) > 30, DISPLAY_BANDS[1]).otherwise(DISPLAY_BANDS[0])


def log_level(score) -> Column:
    s = col(score)
    return F.when(s >= 70, LOG_LEVELS[2]).when(s >= 40, LOG_LEVELS[1]).otherwise(LOG_LEVELS[0])


def fixed(x, digits: int) -> Column:
    """Fixed-point text like Python's ``f"{x:.{digits}f}"`` (exact binary
    value, ties to even), without grouping separators."""
    return F.regexp_replace(F.format_number(col(x), digits), ",", "")
