"""Per-series window column functions.

Every function takes a :class:`tidemark.plans.Series` spec and returns a
Column; frames are counted in rows, trailing and including the current row
unless said otherwise. ``min_periods`` mirrors the pandas rule: the result is
NULL until the frame holds that many non-NULL values. All functions that
share one spec share one sort in the physical plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalar import col, ratio_change, truth
from tidemark.plans.partitioning import Series


def lag(x, spec: Series, n: int = 1, default=None) -> Column:
    return F.lag(col(x), n, default).over(spec.w())


def lead(x, spec: Series, n: int = 1) -> Column:
    return F.lead(col(x), n).over(spec.w())


def pct_change(x, spec: Series, n: int = 1) -> Column:
    """x / x[-n] - 1; NULL on the first n rows and on a zero base."""
    return ratio_change(x, lag(x, spec, n))


def pct_change_guarded(x, spec: Series, n: int = 1) -> Column:
    """(x - x[-n]) / (x[-n] if x[-n] > 0 else 1)."""
    p = lag(x, spec, n)
    return (col(x) - p) / F.when(p > 0, p).otherwise(F.lit(1.0))


def _frame_agg(agg, x, spec: Series, lo: int, hi: int, min_periods: int) -> Column:
    w = spec.rows(lo, hi)
    v = agg(col(x)).over(w)
    if min_periods > 1:
        v = F.when(F.count(col(x)).over(w) >= min_periods, v)
    return v


def rolling(agg, x, n: int, spec: Series, min_periods: int = 1) -> Column:
    """agg over the trailing n rows including the current one."""
    return _frame_agg(agg, x, spec, -(n - 1), 0, min_periods)


def rolling_prev(agg, x, n: int, spec: Series, min_periods: int = 1) -> Column:
    """rolling(n) shifted by one row: agg over rows(-n, -1)."""
    return _frame_agg(agg, x, spec, -n, -1, min_periods)


def rolling_max(x, n, spec, min_periods=1):
    return rolling(F.max, x, n, spec, min_periods)


def rolling_min(x, n, spec, min_periods=1):
    return rolling(F.min, x, n, spec, min_periods)


def rolling_mean(x, n, spec, min_periods=1):
    return rolling(F.avg, x, n, spec, min_periods)


def rolling_sum(x, n, spec, min_periods=1):
    return rolling(F.sum, x, n, spec, min_periods)


def rolling_std(x, n, spec, min_periods=1):
    """Sample standard deviation (NULL for a single value, like pandas)."""
    return rolling(F.stddev_samp, x, n, spec, min_periods)


def flag_mean(cond: Column, n: int, spec: Series) -> Column:
    """Share of the last n rows where ``cond`` holds (NULL counts as false)."""
    return F.avg(truth(cond).cast("double")).over(spec.rows(-(n - 1), 0))


def rolling_corr(x, y, n: int, spec: Series, min_pairs: int | None = None) -> Column:
    """Pearson correlation over the trailing n rows.

    NULL when fewer than ``min_pairs`` complete pairs are present or when
    either side is constant in the frame.
    """
    w = spec.rows(-(n - 1), 0)
    x, y = col(x), col(y)
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    pairs = F.count(xs).over(w)
    sx, sy = F.stddev_samp(xs).over(w), F.stddev_samp(ys).over(w)
    ok = (sx > 0) & (sy > 0) & (pairs >= (min_pairs or 2))
    # covariance / (sd_x * sd_y): the built-in corr divides by a zero
    # variance under ANSI mode and fails the job on a constant frame
    return F.when(ok, F.try_divide(F.covar_samp(xs, ys).over(w), sx * sy))


def diff_clip(x, spec: Series) -> Column:
    """x - x[-1], 0 on the first row, negatives clipped to 0."""
    return F.greatest(F.coalesce(col(x) - lag(x, spec), F.lit(0.0)), F.lit(0.0))


def rsi(x, spec: Series, period: int = 14, zero_loss: str = "zero") -> Column:
    """RSI with simple means of gains and losses over ``period`` rows.

    The first row counts as gain 0 and loss 0, so the first value is on row
    ``period``. ``zero_loss="zero"``: no losses -> 0 and warm-up NULL;
    ``"neutral"``: no losses or warm-up -> 50.
    """
    d = col(x) - lag(x, spec)
    gain = F.when(d > 0, d).otherwise(F.lit(0.0))
    loss = F.when(d < 0, -d).otherwise(F.lit(0.0))
    w = spec.rows(-(period - 1), 0)
    ready = F.count(F.lit(1)).over(w) >= period
    ag = F.when(ready, F.avg(gain).over(w))
    al = F.when(ready, F.avg(loss).over(w))
    if zero_loss == "zero":
        rs = F.when(al == 0, F.lit(0.0)).otherwise(F.try_divide(ag, al))
        return F.lit(100.0) - F.try_divide(F.lit(100.0), F.lit(1.0) + rs)
    rs = F.try_divide(ag, F.nullif(al, F.lit(0.0)))
    return F.coalesce(F.lit(100.0) - F.try_divide(F.lit(100.0), F.lit(1.0) + rs), F.lit(50.0))


def minmax_pct(x, spec: Series, n: int = 100) -> Column:
    """(x - min) / (max - min) * 100 over the trailing n values; flat -> 50."""
    w = spec.rows(-(n - 1), 0)
    lo, hi = F.min(col(x)).over(w), F.max(col(x)).over(w)
    rng = hi - lo
    pct = F.when(rng > 0, (col(x) - lo) / rng * F.lit(100.0)).otherwise(F.lit(50.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), pct))
