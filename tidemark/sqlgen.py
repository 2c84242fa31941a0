"""Small helpers that write the DuckDB reference SQL used by the oracle check.

The reference SQL is written independently of the Spark plans: plain
window functions over whole symbols, no chunking.
"""

from __future__ import annotations


def bound(n) -> str:
    if n is None:
        return "unbounded preceding"
    if n == "inf":
        return "unbounded following"
    if n < 0:
        return f"{-n} preceding"
    if n == 0:
        return "current row"
    return f"{n} following"


def W(lo=None, hi=None, key: str = "symbol", order: str = "ts") -> str:
    base = f"partition by {key} order by {order}"
    if lo is None and hi is None:
        return f"over ({base})"
    return f"over ({base} rows between {bound(lo)} and {bound(hi)})"


def roll(agg: str, x: str, n: int, minp: int = 1, key="symbol", order="ts") -> str:
    w = W(-(n - 1), 0, key, order)
    e = f"{agg}({x}) {w}"
    return f"(case when count({x}) {w} >= {minp} then {e} end)" if minp > 1 else e


def roll_prev(agg: str, x: str, n: int, minp: int = 1, key="symbol", order="ts") -> str:
    w = W(-n, -1, key, order)
    e = f"{agg}({x}) {w}"
    return f"(case when count({x}) {w} >= {minp} then {e} end)" if minp > 1 else e


def lag(x: str, n: int = 1, key="symbol", order="ts") -> str:
    return f"lag({x}, {n}) {W(key=key, order=order)}"


def lead(x: str, n: int = 1, key="symbol", order="ts") -> str:
    return f"lead({x}, {n}) {W(key=key, order=order)}"


def pct(x: str, n: int = 1, key="symbol", order="ts") -> str:
    return f"({x} / nullif({lag(x, n, key, order)}, 0) - 1)"


def ratio_gt(x: str, base: str, t: float) -> str:
    return f"coalesce(case when {base} = 0 then {x} > 0 else {x} / {base} - 1 > {t} end, false)"


def ratio_lt(x: str, base: str, t: float) -> str:
    return f"coalesce(case when {base} = 0 then {x} < 0 else {x} / {base} - 1 < {t} end, false)"


def flag(cond: str) -> str:
    return f"cast(coalesce({cond}, false) as integer)"


def fmean(cond: str, n: int, key="symbol", order="ts") -> str:
    return f"avg(cast(coalesce({cond}, false) as double)) {W(-(n - 1), 0, key, order)}"


def clip01(x: str) -> str:
    return f"greatest(0.0, least(1.0, coalesce(cast({x} as double), 0.0)))"


def corr(x: str, y: str, n: int, min_pairs: int | None = None, key="symbol", order="ts") -> str:
    w = W(-(n - 1), 0, key, order)
    xs = f"case when {x} is not null and {y} is not null then {x} end"
    ys = f"case when {x} is not null and {y} is not null then {y} end"
    mp = min_pairs or 2
    return (f"(case when count({xs}) {w} >= {mp} and stddev_samp({xs}) {w} > 0 and stddev_samp({ys}) {w} > 0 "
            f"then corr({xs}, {ys}) {w} end)")


def rsi(x: str, period: int = 14, mode: str = "zero", key="symbol", order="ts") -> str:
    """Needs ``{x}`` and a precomputed ``_d`` (= x - lag x) in scope."""
    w = W(-(period - 1), 0, key, order)
    ag = f"(case when count(*) {w} >= {period} then avg(case when _d > 0 then _d else 0 end) {w} end)"
    al = f"(case when count(*) {w} >= {period} then avg(case when _d < 0 then -_d else 0 end) {w} end)"
    if mode == "zero":
        rs = f"(case when {al} = 0 then 0.0 else {ag} / {al} end)"
        return f"(100.0 - 100.0 / (1.0 + {rs}))"
    return f"coalesce(100.0 - 100.0 / (1.0 + {ag} / nullif({al}, 0)), 50.0)"


def r6(x: str) -> str:
    return sround(x, 6)


def sround(x: str, n: int) -> str:
    """Spark's double rounding: HALF_UP on the shortest decimal repr."""
    return f"cast(round(try_cast(cast(cast({x} as double) as varchar) as decimal(38,17)), {n}) as double)"
