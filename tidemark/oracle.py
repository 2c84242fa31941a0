"""DuckDB reference SQL for the registered queries (same names, same
columns). Tables are the driver's pre-registered views."""

from __future__ import annotations

from tidemark.sqlgen import W, clip01, fmean, lag, pct, r6, roll, roll_prev, rsi, sround

ORACLE: dict[str, str] = {}

TICKS = """ticks as (
  select case event_type when 'click' then 'BTC-USD' when 'view' then 'ETH-USD' when 'purchase' then 'SOL-USD'
              when 'signup' then 'BNB-USD' else 'XRP-USD' end as symbol,
         ts, event_id as seq, value as price, try_cast(json_extract_string(props, '$.k') as double) as volume
  from events)"""


def bars_cte(name: str, unit: str) -> str:
    return f"""{name} as (
  select symbol, date_trunc('{unit}', ticks.ts) as ts, min_by(price, (ticks.ts, seq)) as open, max(price) as high,
         min(price) as low, max_by(price, (ticks.ts, seq)) as close, cast(sum(volume) as double) as volume
  from ticks group by 1, 2)"""


BARS_1H = bars_cte("bars_1h", "hour")
BARS_1D = bars_cte("bars_1d", "day")
FRAME_1H = "frame_1h as (select symbol, ts, close as price, volume from bars_1h)"
BASE_1H = f"{TICKS},\n{BARS_1H},\n{FRAME_1H}"

BARS_LI = """bars_li as (
  select l_returnflag as symbol, l_shipdate as ts,
         min_by(l_extendedprice / nullif(l_quantity, 0), (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) as open,
         max(l_extendedprice / nullif(l_quantity, 0)) as high, min(l_extendedprice / nullif(l_quantity, 0)) as low,
         max_by(l_extendedprice / nullif(l_quantity, 0), (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) as close,
         cast(sum(l_quantity) as double) as volume
  from lineitem group by 1, 2)"""

BARS_ORD = """bars_ord as (
  select o_orderpriority as symbol, o_orderdate as ts, min_by(o_totalprice, o_orderkey) as open, max(o_totalprice) as high,
         min(o_totalprice) as low, max_by(o_totalprice, o_orderkey) as close, cast(count(*) as double) as volume
  from orders group by 1, 2)"""


def rt_sql(frame: str = "frame_1h", anomaly: str = "0.0") -> str:
    """CTEs a..f: every bar of ``frame`` scored by the realtime engine."""
    return f"""
rt_a as (
  select symbol, ts, price, volume, {anomaly} as _anom,
         row_number() {W()} as bar_no,
         coalesce({pct('price')}, 0) as _ret, coalesce({pct('volume')}, 0) as _vchg,
         {roll_prev('max', 'price', 20, 5)} as _rh, {roll('max', 'price', 20, 5)} as _max20,
         {roll('avg', 'volume', 20, 5)} as _vmean20, price - {lag('price')} as _d
  from {frame}),
rt_b as (select *, {rsi('price', 14, 'neutral')} as _rsi from rt_a),
rt_c as (
  select *, coalesce(price > _rh, false) as _bo, coalesce(price >= _max20 * 0.995, false) as _near_high,
         coalesce(price >= _max20 * 0.995, false) and coalesce(volume < _vmean20 * 0.9, false) as _nhlv,
         coalesce({lag('_rsi')} > 68 and _rsi < {lag('_rsi')} - 2, false) as _rsi_fall,
         coalesce({roll('avg', '_ret', 3, 3)} < {roll('avg', '_ret', 8, 5)}, false) as _mfade,
         (_ret > 0 and _vchg < 0) as _puvd
  from rt_b),
rt_d as (select *, coalesce({lag('_bo')}, false) and coalesce(price < _rh, false) as _bf from rt_c),
rt_e as (
  select symbol, ts, price, volume, bar_no,
    case when bar_no >= 25 then {clip01(f"0.7 * {fmean('_bf', 5)} + 0.3 * {fmean('_ret < -0.002 and _near_high', 5)}")} else 0.0 end as structure_failure,
    case when bar_no >= 25 then {clip01(f"0.65 * {fmean('_puvd', 8)} + 0.35 * {fmean('_nhlv', 8)}")} else 0.0 end as volume_behavior,
    case when bar_no >= 25 then {clip01(f"0.6 * {fmean('_rsi_fall', 8)} + 0.4 * {fmean('_mfade', 8)}")} else 0.0 end as momentum_exhaustion,
    {clip01('_anom / 100.0')} as anomaly_component,
    case when bar_no >= 25 then {fmean('_bf', 8)} end as d_bf,
    case when bar_no >= 25 then {fmean('_puvd', 8)} end as d_puvd,
    case when bar_no >= 25 then {fmean('_rsi_fall', 8)} end as d_rsi,
    case when bar_no >= 25 then {fmean('_nhlv', 8)} end as d_nhlv,
    case when bar_no >= 25 then {fmean('_mfade', 8)} end as d_mfade,
    case when bar_no >= 25 then _rsi end as d_rsi_last,
    case when bar_no >= 25 then _ret end as d_ret,
    case when bar_no >= 25 then _vchg end as d_vchg,
    case when bar_no < 10 then 'Neutral'
         when avg(_ret) {W(-4, 0)} > 0.0008 and avg(_vchg) {W(-4, 0)} >= -0.01 then 'Buyers in Control'
         when avg(_ret) {W(-4, 0)} < -0.0008 and avg(_vchg) {W(-4, 0)} >= -0.01 then 'Sellers in Control'
         else 'Neutral' end as control
  from rt_d),
rt_f as (
  select *, case when bar_no >= 10 then {sround("greatest(0.0, least((0.35 * structure_failure + 0.25 * volume_behavior + 0.20 * momentum_exhaustion + 0.20 * anomaly_component) * 100.0, 100.0))", 1)} else 0.0 end as risk_score
  from rt_e),
rt_g as (
  select *,
    case when risk_score >= 70 then 'CRITICAL' when risk_score >= 40 then 'ELEVATED' else 'LOW' end as risk_level,
    case when bar_no < 10 then 'Neutral'
         when structure_failure = greatest(structure_failure, volume_behavior, momentum_exhaustion, anomaly_component) then 'Breakout Failure Trap'
         when volume_behavior = greatest(structure_failure, volume_behavior, momentum_exhaustion, anomaly_component) then 'Distribution Trap'
         when momentum_exhaustion = greatest(structure_failure, volume_behavior, momentum_exhaustion, anomaly_component) then 'Fake Momentum Trap'
         else 'Liquidity Sweep Trap' end as trap_type,
    list_sort([
      {{'k': 0.0 - greatest(structure_failure, coalesce(d_bf, 0.0)), 'o': 0, 'r': 'Price broke resistance but failed to hold', 'c': greatest(structure_failure, coalesce(d_bf, 0.0))}},
      {{'k': 0.0 - greatest(volume_behavior, coalesce(d_puvd, 0.0)), 'o': 1, 'r': 'Price rising without volume support', 'c': greatest(volume_behavior, coalesce(d_puvd, 0.0))}},
      {{'k': 0.0 - greatest(momentum_exhaustion, coalesce(d_rsi, 0.0)), 'o': 2, 'r': 'Momentum exhausted after sharp push', 'c': greatest(momentum_exhaustion, coalesce(d_rsi, 0.0))}},
      {{'k': 0.0 - anomaly_component, 'o': 3, 'r': 'Anomalous behavior detected vs recent history', 'c': anomaly_component}}
    ]) as _ranked
  from rt_f),
rt as (
  select *, case when bar_no >= 10 and risk_score >= 40 then
              (case when len(list_filter(_ranked, lambda x: x.c >= 0.2)) < 2 then _ranked[1:2]
                    else list_filter(_ranked, lambda x: x.c >= 0.2)[1:3] end) else [] end as _chosen
  from rt_g)"""


def rt_flat_select(src: str = "rt") -> str:
    reasons = ", ".join(
        f"_chosen[{i}].r as reason_{i}, case when _chosen[{i}].c is not null then {sround(f"greatest(0.0, least(1.0, _chosen[{i}].c)) * 100.0", 1)} end as confidence_{i}"
        for i in (1, 2, 3)
    )
    return f"""select symbol, ts, bar_no, {r6('risk_score')} as risk_score, risk_level, trap_type, control,
  {r6('structure_failure')} as structure_failure, {r6('volume_behavior')} as volume_behavior,
  {r6('momentum_exhaustion')} as momentum_exhaustion, {r6('anomaly_component')} as anomaly_component,
  coalesce(_chosen[1].r, 'Monitoring...') as main_reason, {reasons} from {src}"""


ORACLE["risk_score_rt"] = f"with {BASE_1H},{rt_sql()}\n{rt_flat_select()}"
ORACLE["risk_snapshot"] = (
    f"with {BASE_1H},{rt_sql()},\nlatest as (select * from rt qualify row_number() over (partition by symbol order by ts desc) = 1)\n"
    f"{rt_flat_select('latest')}"
)


# ---------------------------------------------------------------- features
from tidemark.operators.params import ASSET_ROWS, PARAM_COLUMNS, distinct_values  # noqa: E402
from tidemark.sqlgen import corr, flag, lead, ratio_gt, ratio_lt  # noqa: E402

BARS = ["symbol", "ts", "open", "high", "low", "close", "volume"]


def out_select(src: str, keys, dbl=(), ints=(), fill=True) -> str:
    parts = list(keys)
    for c in dbl:
        parts.append(f"{r6(f'coalesce({c}, 0)' if fill else c)} as {c}")
    for c in ints:
        parts.append(f"cast(coalesce({c}, 0) as integer) as {c}")
    return f"select {', '.join(parts)} from {src}"


def bars_out(src, dbl=(), ints=()):
    return out_select(src, ["symbol", "ts"], [*["open", "high", "low", "close", "volume"], *dbl], ints, True)


CORE = f"""core1 as (select {', '.join(BARS)}, (close - {lag('close')}) / nullif({lag('close')}, 0) as price_return,
    (volume - {lag('volume')}) / (case when {lag('volume')} > 0 then {lag('volume')} else 1.0 end) as volume_change,
    max(high) {W(-19, 0)} as _rh, (close - {lag('close', 4)}) / nullif({lag('close', 4)}, 0) as price_momentum,
    (volume - {lag('volume', 4)}) / (case when {lag('volume', 4)} > 0 then {lag('volume', 4)} else 1.0 end) as volume_momentum
  from bars_1h),
core2 as (select *, stddev_samp(price_return) {W(-19, 0)} as volatility, (close - _rh) / nullif(_rh, 0) as breakout_strength,
    {corr('price_return', 'volume_change', 20)} as pv_correlation from core1)"""
ORACLE["feat_core"] = f"with {TICKS},\n{BARS_1H},\n{CORE}\n" + bars_out(
    "core2", ["price_return", "volume_change", "volatility", "breakout_strength", "pv_correlation", "price_momentum", "volume_momentum"])


def daily_sql(src: str) -> str:
    return f"""d1 as (select {', '.join(BARS)}, {pct('close')} as price_return, {pct('volume')} as volume_change,
    (high - low) / nullif(open, 0) as volatility, max(close) {W(-19, 0)} as rolling_max_20,
    {lag('close')} as _lc, {lag('volume')} as _lv from {src}),
d2 as (select *, (close - rolling_max_20) / nullif(rolling_max_20, 0) as breakout_strength,
    {flag(f"close > {lag('rolling_max_20')}")} as is_breakout,
    {flag(f"{ratio_gt('close', '_lc', 0.0)} and {ratio_lt('volume', '_lv', 0.0)}")} as pv_divergence from d1)"""


DAILY_D = ["price_return", "volume_change", "volatility", "rolling_max_20", "breakout_strength"]
ORACLE["feat_daily"] = f"with {BARS_LI},\n{daily_sql('bars_li')}\n" + bars_out("d2", DAILY_D, ["is_breakout", "pv_divergence"])
ORACLE["lbl_trap"] = (
    f"with {BARS_LI},\n{daily_sql('bars_li')},\n"
    f"d3 as (select *, {flag(f'is_breakout = 1 and {ratio_lt(chr(118) + 'olume', '_lv', 0.3)} and (close - {lead('close', 3)}) / nullif(close, 0) >= 0.02')} as label from d2)\n"
    + bars_out("d3", DAILY_D, ["is_breakout", "pv_divergence", "label"])
)

TICK_SQL = f"""t1 as (select symbol, ts, price, volume, {pct('price')} as price_return, {pct('volume')} as volume_change,
    max(price) {W(-19, 0)} as _rm, {lag('price')} as _lp, {lag('volume')} as _lv from frame_1h),
t2 as (select *, stddev_samp(price_return) {W(-9, 0)} as volatility, (price - _rm) / nullif(_rm, 0) as breakout_strength,
    {flag(f"price > {lag('_rm')}")} as is_breakout,
    {flag(f"({ratio_gt('price', '_lp', 0.0)} and {ratio_lt('volume', '_lv', 0.0)}) or ({ratio_lt('price', '_lp', 0.0)} and {ratio_gt('volume', '_lv', 0.0)})")} as pv_divergence
  from t1)"""
ORACLE["feat_tick"] = f"with {BASE_1H},\n{TICK_SQL}\n" + out_select(
    "t2", ["ts", "symbol"], ["price_return", "volume_change", "volatility", "breakout_strength"], ["is_breakout", "pv_divergence"])

ENGINE_SQL = f"""e1 as (select symbol, ts, price, volume, coalesce({pct('price')}, 0) as price_return,
    coalesce({pct('volume')}, 0) as volume_change, coalesce(max(price) {W(-20, -1)}, price) as _rm from frame_1h),
e2 as (select *, stddev_samp(price_return) {W(-9, 0)} as volatility, (price - _rm) / nullif(_rm, 0) as breakout_strength,
    {flag('price > _rm')} as is_breakout, {flag('price_return > 0 and volume_change < 0')} as pv_divergence from e1)"""
ORACLE["feat_engine"] = f"with {BASE_1H},\n{ENGINE_SQL}\n" + out_select(
    "e2", ["symbol", "ts"], ["price", "volume", "price_return", "volume_change", "volatility", "breakout_strength"],
    ["is_breakout", "pv_divergence"])

TRAP_SQL = f"""p1 as (select {', '.join(BARS)}, {pct('close')} as price_return, {pct('volume')} as volume_change,
    {lag('close')} as _lc, {lag('volume')} as _lv, max(high) {W(-19, 0)} as _rh, max(high) {W(-20, -1)} as _ph,
    max(high) {W(-21, -2)} as _ph2, (high - close) / nullif(high - low, 0) as upper_wick_ratio,
    abs(close - open) / nullif(high - low, 0) as body_to_range_ratio, avg(volume) {W(-19, 0)} as _vm,
    close - {lag('close')} as _d from bars_1h),
p2 as (select *, case when _rh = 0 then 0.0 else (close - _rh) / _rh end as breakout_strength,
    {flag('high > _ph and close < _ph')} as breakout_failure, {flag('_lc > _ph2 and close < _ph')} as failed_retest,
    {flag('volume > _vm * 1.5')} as volume_spike, {ratio_gt('close', '_lc', 0.0)} as _up, {ratio_lt('close', '_lc', 0.0)} as _down,
    {ratio_lt('volume', '_lv', 0.0)} as _vdown, {corr('price_return', 'volume_change', 10, 10)} as pv_correlation,
    {flag('open > _lc * 1.002 and close < open')} as gap_rejection, {pct('close', 5)} as price_momentum,
    {rsi('close', 14, 'zero')} as rsi_14 from p1),
p3 as (select *, {flag('volume_spike = 1 and body_to_range_ratio < 0.3')} as absorption_signal,
    {flag('_up and _vdown')} as volume_divergence,
    {flag(f"volume_spike = 1 and _down and coalesce({lag('_up')}, false)")} as volume_spike_on_reversal,
    {flag(f"rsi_14 > 70 and rsi_14 - {lag('rsi_14')} < 0")} as rsi_overbought_fall,
    {flag(f"coalesce({lag('_up')}, false) and ({lag('price_return')} > 0.02 or {lag('price_return')} is null) and price_return < -0.02")} as fast_reversal,
    {flag(f"price_momentum < {lag('price_momentum')} and _up")} as momentum_fade from p2)"""
TRAP_D = ["price_return", "volume_change", "breakout_strength", "upper_wick_ratio", "body_to_range_ratio", "pv_correlation",
          "price_momentum", "rsi_14"]
TRAP_I = ["breakout_failure", "failed_retest", "volume_spike", "absorption_signal", "volume_divergence",
          "volume_spike_on_reversal", "gap_rejection", "rsi_overbought_fall", "fast_reversal", "momentum_fade"]
ORACLE["feat_trap"] = f"with {TICKS},\n{BARS_1H},\n{TRAP_SQL}\n" + bars_out("p3", TRAP_D, TRAP_I)


def sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"cast({v!r} as double)"
    return str(v)


PARAMS_VALUES = "pa(" + ", ".join(PARAM_COLUMNS) + ") as (values " + ", ".join(
    "(" + ", ".join(sql_lit(v) for v in r) + ")" for r in ASSET_ROWS) + ")"
DEFAULT_ROW = dict(zip(PARAM_COLUMNS, ASSET_ROWS[0]))


def with_params_sql(src: str, name: str = "ap") -> str:
    cols = ", ".join(f"coalesce(p.{c}, {sql_lit(DEFAULT_ROW[c])}) as {c}" for c in PARAM_COLUMNS if c != "symbol")
    return f"{name} as (select b.*, {cols} from {src} b left join pa p on b.symbol = p.symbol)"


def per(param: str, make) -> str:
    return "(case " + " ".join(f"when {param} = {v} then {make(v)}" for v in distinct_values(param)) + " end)"


ASSET_SQL = f"""{PARAMS_VALUES},
{with_params_sql('bars_1h')},
a1 as (select *, {pct('close')} as price_return, {pct('volume')} as volume_change,
    {per('breakout_lookback', lambda n: f"max(high) {W(-(n - 1), 0)}")} as _rh,
    {per('breakout_lookback', lambda n: f"max(high) {W(-n, -1)}")} as _ph,
    {per('absorption_window', lambda n: f"avg(volume) {W(-(n - 1), 0)}")} as _vm,
    abs(close - open) / nullif(high - low, 0) as body_to_range,
    {per('momentum_window', lambda n: pct('close', n))} * 100.0 as momentum_roc,
    {per('compression_window', lambda n: f"stddev_samp(high) {W(-(n - 1), 0)}")} / nullif(close, 0) as volatility
  from ap),
a2 as (select *, case when _rh = 0 then 0.0 else (close - _rh) / _rh end as breakout_strength,
    {flag('high > _ph and close < _ph')} as breakout_failure, {flag('volume > _vm * 1.5')} as volume_spike,
    {per('reversal_window', lambda n: f"sum(price_return) {W(-(n - 1), 0)}")} as reversal_velocity,
    {per('compression_window', lambda n: f"avg(volatility) {W(-(n - 1), 0)}")} as _vmean,
    {flag(f"momentum_roc > momentum_threshold and {lag('momentum_roc')} > momentum_threshold and momentum_roc < {lag('momentum_roc')}")} as momentum_exhaustion
  from a1),
a3 as (select *, {flag('volume_spike = 1 and body_to_range < 0.3')} as absorption_signal,
    {per('reversal_window', lambda n: f"avg(breakout_failure) {W(-(n - 1), 0)}")} as fake_breakout_prob,
    {flag('reversal_velocity < -breakout_threshold / 100.0')} as sharp_reversal,
    _vmean / nullif(volatility, 0) as compression_ratio,
    {flag('case when volatility = 0 then _vmean > 0 else _vmean / volatility > 1.5 end')} as compression_to_expansion,
    {per('momentum_window', lambda n: f"avg(momentum_exhaustion) {W(-(n - 1), 0)}")} as momentum_exhaustion_prob
  from a2),
a4 as (select *, {per('absorption_window', lambda n: f"avg(absorption_signal) {W(-(n - 1), 0)}")} as volume_absorption_prob from a3)"""
ASSET_D = ["price_return", "volume_change", "breakout_strength", "fake_breakout_prob", "body_to_range", "volume_absorption_prob",
           "momentum_roc", "momentum_exhaustion_prob", "reversal_velocity", "volatility", "compression_ratio"]
ASSET_I = ["breakout_failure", "volume_spike", "absorption_signal", "momentum_exhaustion", "sharp_reversal", "compression_to_expansion"]
ORACLE["feat_asset"] = f"with {TICKS},\n{BARS_1H},\n{ASSET_SQL}\n" + bars_out("a4", ASSET_D, ASSET_I)

CHART_SQL = f"""fr as (select symbol, ts, close as price, volume from bars_li),
ch1 as (select *, case when volume = 0 then 1.0 else volume end as _v from fr),
ch2 as (select symbol, ts, price, volume,
    list_reduce(list(price) {W(None, 0)}, lambda acc, x: 0.2 * x + 0.8 * acc) as ema9,
    list_reduce(list(price) {W(None, 0)}, lambda acc, x: {2.0 / 22.0!r} * x + {1.0 - 2.0 / 22.0!r} * acc) as ema21,
    sum(price * _v) {W(None, 0)} / sum(_v) {W(None, 0)} as vwap,
    least(volume, quantile_cont(volume, 0.95) over (partition by symbol)) as volume_plot from ch1)"""
ORACLE["feat_chart"] = f"with {BARS_LI},\n{CHART_SQL}\n" + out_select(
    "ch2", ["symbol", "ts"], ["price", "volume", "ema9", "ema21", "vwap", "volume_plot"], fill=False)


# ------------------------------------------------------ base series windows
def li_q(cols: dict, dbl: list | None = None, ints: list | None = None, src: str = "bars_li") -> str:
    sel = ", ".join(f"{e} as {n}" for n, e in cols.items())
    dbl = list(cols) if dbl is None else dbl
    ints = ints or []
    return f"with {BARS_LI},\nq as (select symbol, ts, {sel} from {src})\n" + out_select("q", ["symbol", "ts"], dbl, [], fill=False) \
        if not ints else f"with {BARS_LI},\nq as (select symbol, ts, {sel} from {src})\n" + out_select("q", ["symbol", "ts"], dbl, ints, fill=False)


ORACLE["win_pct_change"] = li_q({"close_change": pct("close"), "volume_change": pct("volume")})
ORACLE["win_pct_change_guarded"] = li_q({"volume_change": f"(volume - {lag('volume')}) / (case when {lag('volume')} > 0 then {lag('volume')} else 1.0 end)"})
ORACLE["win_roc_n"] = li_q({"roc_4": pct("close", 4), "roc_5": pct("close", 5)})
ORACLE["win_rolling_max_min"] = li_q({"max_high_20": f"max(high) {W(-19, 0)}", "min_low_20": f"min(low) {W(-19, 0)}",
                                      "max_close_20": f"max(close) {W(-19, 0)}"})
ORACLE["win_prev_high"] = li_q({"prev_high_20": f"max(high) {W(-20, -1)}", "prev_high_20_min5": roll_prev("max", "close", 20, 5),
                                "prev_high_filled": f"coalesce(max(close) {W(-20, -1)}, close)"})
ORACLE["win_rolling_mean"] = li_q({"volume_mean_20": f"avg(volume) {W(-19, 0)}", "close_mean_8_min5": roll("avg", "close", 8, 5),
                                   "up_share_5": fmean("close > open", 5)})
ORACLE["win_rolling_sum"] = li_q({"volume_sum_3": f"sum(volume) {W(-2, 0)}"})
ORACLE["win_rolling_std"] = li_q({"close_std_20": f"stddev_samp(close) {W(-19, 0)}", "close_std_10": f"stddev_samp(close) {W(-9, 0)}"})
ORACLE["win_rolling_corr"] = li_q({"corr_20": corr("close", "volume", 20), "corr_10_min10": corr("close", "volume", 10, 10)})
ORACLE["win_shift"] = li_q({"prev_close": lag("close"), "was_up": flag(lag("close > open"))}, ["prev_close"], ["was_up"])
ORACLE["win_rsi_zero"] = (f"with {BARS_LI},\nb as (select *, close - {lag('close')} as _d from bars_li),\n"
                          f"q as (select symbol, ts, {rsi('close', 14, 'zero')} as rsi_14 from b)\n" + out_select("q", ["symbol", "ts"], ["rsi_14"], fill=False))
ORACLE["win_rsi_neutral"] = (f"with {BARS_LI},\nb as (select *, close - {lag('close')} as _d from bars_li),\n"
                             f"q as (select symbol, ts, {rsi('close', 14, 'neutral')} as rsi_14 from b)\n" + out_select("q", ["symbol", "ts"], ["rsi_14"], fill=False))
ORACLE["win_ema"] = li_q({
    "ema9": f"list_reduce(list(close) {W(None, 0)}, lambda acc, x: 0.2 * x + 0.8 * acc)",
    "ema21": f"list_reduce(list(close) {W(None, 0)}, lambda acc, x: {2.0 / 22.0!r} * x + {1.0 - 2.0 / 22.0!r} * acc)"})
ORACLE["win_vwap"] = li_q({"vwap": f"sum(close * (case when volume = 0 then 1.0 else volume end)) {W(None, 0)} / sum(case when volume = 0 then 1.0 else volume end) {W(None, 0)}"})
ORACLE["win_rolling_minmax"] = li_q({"risk_pct": f"greatest(0.0, least(100.0, case when max(close) {W(-99, 0)} - min(close) {W(-99, 0)} > 0 then (close - min(close) {W(-99, 0)}) / (max(close) {W(-99, 0)} - min(close) {W(-99, 0)}) * 100.0 else 50.0 end))"})
ORACLE["win_extremes_120"] = (
    f"with {BARS_LI},\nq0 as (select *, coalesce({lag('close')}, close) as _prev from bars_li),\n"
    f"q as (select symbol, ts, close, close - _prev as change, case when _prev <> 0 then (close - _prev) / _prev * 100.0 else 0.0 end as change_pct,"
    f" max(close) {W(-119, 0)} as high_120, min(close) {W(-119, 0)} as low_120 from q0 qualify row_number() over (partition by symbol order by ts desc) = 1)\n"
    + out_select("q", ["symbol", "ts"], ["close", "change", "change_pct", "high_120", "low_120"], fill=False))
CUM_TICKS = f"""{TICKS},
cum as (select symbol, ts, seq, price, sum(coalesce(volume, 0.0)) over (partition by symbol, cast(ts as date) order by ts, seq rows between unbounded preceding and current row) as volume from ticks)"""
ORACLE["win_diff_clip"] = (
    f"with {CUM_TICKS},\nq as (select symbol, ts, seq, volume, greatest(coalesce(volume - {lag('volume', 1, order='ts, seq')}, 0.0), 0.0) as volume_delta from cum)\n"
    + out_select("q", ["symbol", "ts", "seq"], ["volume", "volume_delta"], fill=False))


def band_sql(src: str, value: str, max_w: int = 20) -> str:
    mean = " ".join(f"when _w = {w} then avg({value}) {W(-(w // 2), (w - 1) // 2)}" for w in range(1, max_w + 1))
    std = " ".join(f"when _w = {w} then stddev_samp({value}) {W(-(w // 2), (w - 1) // 2)}" for w in range(1, max_w + 1))
    return f"""bn as (select s.*, n._n, least({max_w}, greatest(1, floor(n._n / 2))) as _w from {src} s
    join (select symbol, count(*) as _n from {src} group by symbol) n using (symbol)),
bb as (select symbol, ts, {value}, case when _n <= _w then avg({value}) {W(-1, 1)} else (case {mean} end) end as band_mean,
    case when _n <= _w then 0.0 else (case {std} end) end as band_std from bn),
bc as (select *, band_mean + 1.5 * band_std as band_upper, band_mean - 1.5 * band_std as band_lower,
    coalesce(abs({value} - band_mean) > 1.5 * band_std, false) as significant from bb)"""


ORACLE["win_centered_band"] = (f"with {BASE_1H},{rt_sql()},\n{band_sql('rt', 'risk_score')}\n"
                               + out_select("bc", ["symbol", "ts", "significant"], ["risk_score", "band_mean", "band_std", "band_upper", "band_lower"], fill=False))


# ------------------------------------------------------------ risk pieces
from tidemark.operators.risk import ASSET_ANOMALY_REASON, ASSET_INVALIDATION, GENERIC_INVALIDATION, GENERIC_REASONS  # noqa: E402

RT = f"with {BASE_1H},{rt_sql()}\n"
COMPS = ["structure_failure", "volume_behavior", "momentum_exhaustion"]
ORACLE["risk_components_rt"] = RT + out_select("rt", ["symbol", "ts", "bar_no"], COMPS, fill=False)
ORACLE["risk_diagnostics_rt"] = RT + (
    f"select symbol, ts, bar_no, {r6('d_bf')} as breakout_failure_strength, {r6('d_puvd')} as price_up_volume_down_strength, "
    f"{r6('d_rsi')} as rsi_fall_strength, {r6('d_nhlv')} as near_high_low_volume_strength, {r6('d_mfade')} as momentum_fade_strength, "
    f"{r6('d_rsi_last')} as latest_rsi, {r6('d_ret')} as latest_return, {r6('d_vchg')} as latest_volume_change from rt")
ORACLE["risk_trap_type"] = RT + "select symbol, ts, trap_type from rt"
ORACLE["risk_control"] = RT + "select symbol, ts, control from rt"
ORACLE["risk_sentiment"] = RT + ("select symbol, ts, control, case when control = 'Buyers in Control' then 'BULLISH' "
                                 "when control = 'Sellers in Control' then 'BEARISH' else 'NEUTRAL' end as sentiment from rt")
ORACLE["risk_main_reason"] = RT + (f"select symbol, ts, {r6('risk_score')} as risk_score, coalesce(_chosen[1].r, 'Monitoring...') as main_reason "
                                   "from rt qualify row_number() over (partition by symbol order by ts desc) = 1")
_POS = ["greatest(0.0, coalesce(structure_failure, 0.0))", "greatest(0.0, coalesce(volume_behavior, 0.0))",
        "greatest(0.0, coalesce(momentum_exhaustion, 0.0))", "greatest(0.0, coalesce(anomaly_component, 0.0))"]
_TOT = f"(case when ({' + '.join(_POS)}) <= 0 then 1.0 else ({' + '.join(_POS)}) end)"
ORACLE["fn_component_share"] = RT + (
    "select symbol, ts, x.component as component, " + r6("x.share") + " as share from (select symbol, ts, unnest(["
    + ", ".join(f"{{'component': '{lbl}', 'share': {p} / {_TOT} * 100.0}}" for lbl, p in zip(["Structure", "Volume", "Momentum", "Anomaly"], _POS))
    + "]) as x from rt)")
ORACLE["fn_risk_band_snapshot"] = RT + f"select symbol, ts, {r6('risk_score')} as risk_score, risk_level as band from rt"


def band_model_sql(x: str) -> str:
    return (f"case when {x} > 0 and {x} <= 30 then 'Normal' when {x} > 30 and {x} <= 70 then 'Suspicious' "
            f"when {x} > 70 and {x} <= 100 then 'Potential Market Trap' end")


ORACLE["fn_risk_band_model"] = RT + f"select symbol, ts, {r6('risk_score')} as risk_score, {band_model_sql('risk_score')} as band from rt"
ORACLE["agg_risk_distribution"] = RT + f"select {band_model_sql('risk_score')} as risk_level, count(*) as n from rt group by 1"
ORACLE["agg_score_summary"] = RT + (f"select count(*) as n, {r6('avg(risk_score)')} as mean_score, {r6('min(risk_score)')} as min_score, "
                                    f"{r6('max(risk_score)')} as max_score from rt")
ORACLE["agg_validation_metrics"] = RT + (
    f"select count(*) as validation_samples, {r6('avg(cast(risk_score > 20.0 as double))')} as anomaly_rate, {r6('avg(risk_score)')} as mean_score, "
    f"{r6('stddev_pop(risk_score)')} as std_score, cast(count_if(risk_score > 15.0) as bigint) as high_risk_count from rt")
ORACLE["agg_backtest_buckets"] = RT + (
    "select count(*) as total_samples, cast(count_if(pct > 80) as bigint) as high_risk_periods, cast(count_if(pct > 40 and pct <= 80) as bigint) as medium_risk_periods, "
    f"cast(count_if(pct <= 40) as bigint) as low_risk_periods, {r6('avg(pct)')} as mean_risk_score, {r6('max(pct)')} as max_risk_score "
    "from (select risk_score * 4.0 as pct from rt)")

TRAP_FILLED = ", ".join(f"coalesce({c}, 0) as {c}" for c in TRAP_D + TRAP_I)
TRAP_RISK = f"""{TICKS},
{BARS_1H},
{TRAP_SQL},
tf as (select {', '.join(BARS)}, {TRAP_FILLED} from p3),
tc as (select *,
    {clip01(f"0.5 * avg(breakout_failure) {W(-2, 0)} + 0.3 * avg(failed_retest) {W(-2, 0)} + 0.2 * upper_wick_ratio")} as structure_failure,
    {clip01(f"0.5 * avg(volume_divergence) {W(-2, 0)} + 0.2 * avg(volume_spike_on_reversal) {W(-2, 0)} + 0.3 * (pv_correlation * -1.0)")} as volume_behavior,
    {clip01(f"0.4 * avg(fast_reversal) {W(-2, 0)} + 0.3 * avg(rsi_overbought_fall) {W(-2, 0)} + 0.3 * avg(momentum_fade) {W(-2, 0)}")} as momentum_exhaustion,
    0.0 as anomaly_score from tf),
td as (select *, {sround('(0.35 * structure_failure + 0.25 * volume_behavior + 0.15 * anomaly_score + 0.25 * momentum_exhaustion) * 100.0', 1)} as trap_risk_score,
    list_transform(list_sort(list_filter([
      case when structure_failure > 0.4 then {{'k': 0.0 - structure_failure, 'o': 0, 'r': '{GENERIC_REASONS[0]}'}} end,
      case when volume_behavior > 0.4 then {{'k': 0.0 - volume_behavior, 'o': 1, 'r': '{GENERIC_REASONS[1]}'}} end,
      case when momentum_exhaustion > 0.4 then {{'k': 0.0 - momentum_exhaustion, 'o': 2, 'r': '{GENERIC_REASONS[2]}'}} end,
      case when anomaly_score > 0.6 then {{'k': 0.0 - anomaly_score, 'o': 3, 'r': '{GENERIC_REASONS[3]}'}} end
    ], lambda x: x is not null))[1:3], lambda x: x.r) as top_3_reasons,
    list_filter([case when volume_change > 0 then '{GENERIC_INVALIDATION[0]}' end,
                 case when breakout_strength > 0 then '{GENERIC_INVALIDATION[1]}' end], lambda x: x is not null) as invalidated_by
  from tc),
tr as (select *, case when trap_risk_score >= 70 then 'High' when trap_risk_score >= 40 then 'Medium' else 'Low' end as risk_level from td)"""
ORACLE["risk_components_trap"] = f"with {TRAP_RISK}\n" + out_select("tr", ["symbol", "ts"], COMPS + ["anomaly_score"], fill=False)
ORACLE["risk_score_trap"] = f"with {TRAP_RISK}\n" + out_select("tr", ["symbol", "ts", "risk_level"], ["trap_risk_score"], fill=False)
ORACLE["fn_risk_band_generic"] = f"with {TRAP_RISK}\n" + out_select("tr", ["symbol", "ts", "risk_level as band"], ["trap_risk_score"], fill=False)
ORACLE["risk_reasons_trap"] = f"with {TRAP_RISK}\n" + (
    "select symbol, ts, cast(unnest(range(len(top_3_reasons))) as integer) as pos, unnest(top_3_reasons) as reason from tr")

ASSET_FILLED = ", ".join(f"coalesce({c}, 0) as {c}" for c in ASSET_D + ASSET_I)
PARAM_PLAIN = [c for c in PARAM_COLUMNS if c != "symbol"]


def tpl_sql(tpl: str, **vals) -> str:
    out = tpl
    for k, v in vals.items():
        out = f"replace({out}, '{{{k}}}', cast({v} as varchar))"
    return out


ASSET_RISK = f"""{TICKS},
{BARS_1H},
{ASSET_SQL},
af as (select {', '.join(BARS)}, {ASSET_FILLED.replace('as momentum_exhaustion,', 'as momentum_exhaustion_flag,')} from a4),
ac as (select *,
    {clip01('0.5 * fake_breakout_prob + 0.3 * sharp_reversal + 0.2 * compression_to_expansion')} as structure_failure,
    {clip01('0.6 * volume_absorption_prob + 0.4 * compression_ratio')} as volume_behavior,
    {clip01('0.5 * momentum_exhaustion_prob + 0.3 * (reversal_velocity * -1.0) + 0.2 * compression_to_expansion')} as momentum_exhaustion,
    0.0 as anomaly_score from af),
{with_params_sql('ac', 'acp')},
ad as (select *, w_structure * structure_failure + w_volume * volume_behavior + w_momentum * momentum_exhaustion + w_anomaly * anomaly_score as _base,
    structure_failure + volume_behavior + momentum_exhaustion + anomaly_score as _plain,
    cast(structure_failure > 0.6 as integer) + cast(volume_behavior > 0.6 as integer) + cast(momentum_exhaustion > 0.6 as integer)
      + cast(anomaly_score > 0.6 as integer) as _spikes from acp),
ae as (select *, {sround('greatest(_base, case when _spikes >= 2 then least(1.0, _plain * 1.3) else _plain end) * 100.0', 1)} as trap_risk_score,
    list_filter([
      case when structure_failure > 0.5 then {tpl_sql('breakout_reason', lookback='breakout_lookback', threshold='breakout_threshold', reversal='reversal_window', window='absorption_window')} end,
      case when volume_behavior > 0.5 then {tpl_sql('volume_reason', window='absorption_window', lookback='breakout_lookback', threshold='breakout_threshold', reversal='reversal_window')} end,
      case when momentum_exhaustion > 0.5 then {tpl_sql('momentum_reason', threshold='momentum_threshold', window='momentum_window', lookback='breakout_lookback', reversal='reversal_window')} end,
      case when anomaly_score > 0.6 then '{ASSET_ANOMALY_REASON}' end], lambda x: x is not null)[1:3] as top_3_reasons,
    list_filter([case when volume_change > 0.2 then '{ASSET_INVALIDATION[0]}' end,
                 case when price_return > 0.02 then '{ASSET_INVALIDATION[1]}' end], lambda x: x is not null) as invalidated_by
  from ad),
ar as (select *, case when trap_risk_score >= 80 then 'High' when trap_risk_score >= 50 then 'Medium' else 'Low' end as risk_level from ae)"""
ORACLE["risk_components_asset"] = f"with {ASSET_RISK}\n" + out_select("ar", ["symbol", "ts"], COMPS + ["anomaly_score"], fill=False)
ORACLE["risk_score_asset"] = f"with {ASSET_RISK}\n" + out_select("ar", ["symbol", "ts", "risk_level"], ["trap_risk_score"], fill=False)
ORACLE["fn_risk_band_asset"] = f"with {ASSET_RISK}\n" + out_select("ar", ["symbol", "ts", "risk_level as band"], ["trap_risk_score"], fill=False)
ORACLE["risk_reasons_asset"] = f"with {ASSET_RISK}\n" + (
    "select symbol, ts, cast(unnest(range(len(top_3_reasons))) as integer) as pos, unnest(top_3_reasons) as reason from ar")
ORACLE["risk_invalidation"] = (
    f"with {TRAP_RISK},\n{ASSET_RISK.replace(TICKS + ',', '', 1).replace(BARS_1H + ',', '', 1)}\n"
    "select symbol, ts, 'generic' as model, cast(unnest(range(len(invalidated_by))) as integer) as pos, unnest(invalidated_by) as condition from tr\n"
    "union all select symbol, ts, 'asset' as model, cast(unnest(range(len(invalidated_by))) as integer) as pos, unnest(invalidated_by) as condition from ar")


def flat_report_sql(src: str) -> str:
    return (f"select symbol, ts, {r6('trap_risk_score')} as trap_risk_score, risk_level, "
            + ", ".join(f"{r6(c)} as {c}" for c in COMPS + ["anomaly_score"]) + ", "
            + ", ".join(f"top_3_reasons[{i}] as reason_{i}" for i in (1, 2, 3)) + ", "
            + ", ".join(f"invalidated_by[{i}] as invalidated_{i}" for i in (1, 2))
            + f" from {src} qualify row_number() over (partition by symbol order by ts desc) = 1")


ORACLE["risk_report_trap"] = f"with {TRAP_RISK}\n" + flat_report_sql("tr")
ORACLE["risk_report_asset"] = f"with {ASSET_RISK}\n" + flat_report_sql("ar")
ORACLE["fn_high_risk_filter"] = f"with {ASSET_RISK}\n" + (
    f"select symbol, ts, {r6('trap_risk_score')} as trap_risk_score, ts - interval 12 hours as span_start, ts + interval 12 hours as span_end "
    f"from ar where ({band_model_sql('trap_risk_score')}) = 'Potential Market Trap'")

# ------------------------------------------------------------ scalar fns
B1H = f"with {TICKS},\n{BARS_1H}\n"
ORACLE["fn_safe_divide"] = B1H + f"select symbol, ts, {r6('case when (high - low) = 0 then 0.0 else (close - open) / (high - low) end')} as body_share from bars_1h"
ORACLE["fn_clip01"] = B1H + f"select symbol, ts, {r6(clip01('(close - open) / nullif(open, 0) * 10.0'))} as move01 from bars_1h"
_RAW = {"price_return": pct("close"), "volume_change": pct("volume"), "volatility": f"stddev_samp(close) {W(-9, 0)}"}
ORACLE["fn_clean_features"] = B1H + "select symbol, ts, " + ", ".join(
    f"case when hour(ts) in (3, 4, 5) then 0.0 else {r6(f'coalesce({x}, 0.0)')} end as {c}" for c, x in _RAW.items()) + " from bars_1h"
ORACLE["fn_align_features"] = f"with {BARS_LI},\n{daily_sql('bars_li')}\n" + (
    f"select symbol, ts, {r6('coalesce(price_return, 0)')} as price_return, {r6('coalesce(volume_change, 0)')} as volume_change, "
    f"{r6('coalesce(volatility, 0)')} as volatility, {r6('coalesce(breakout_strength, 0)')} as breakout_strength, "
    f"cast(0.0 as double) as is_breakout, cast(coalesce(pv_divergence, 0) as double) as pv_divergence from d2")
ORACLE["fn_candle_shape"] = B1H + (f"select symbol, ts, {r6('(high - close) / nullif(high - low, 0)')} as upper_wick_ratio, "
                                   f"{r6('abs(close - open) / nullif(high - low, 0)')} as body_ratio from bars_1h")
ORACLE["fn_range_volatility"] = f"with {BARS_LI}\nselect symbol, ts, {r6('(high - low) / nullif(open, 0)')} as volatility from bars_li"

# ------------------------------------------------------------------ joins
UNION_BARS = f"with {TICKS},\n{BARS_1H},\n{BARS_LI},\nub as (select symbol, ts, close from bars_1h union all select symbol, ts, close from bars_li)"
ORACLE["join_asset_params"] = UNION_BARS + f",\n{PARAMS_VALUES},\n{with_params_sql('ub', 'up')}\n" + (
    "select symbol, ts, " + r6("close") + " as close, " + ", ".join(
        (r6(c) + f" as {c}") if isinstance(DEFAULT_ROW[c], float) else c for c in PARAM_PLAIN if not c.endswith("_reason"))
    + " from up")
ORACLE["join_supported_symbols"] = UNION_BARS + f",\n{PARAMS_VALUES}\n" + (
    f"select symbol, ts, {r6('close')} as close from ub where symbol in (select symbol from pa)")

# ----------------------------------------------------------- aggregations
ORACLE["agg_ohlcv_bars"] = f"with {TICKS},\n{bars_cte('b1m', 'minute')}\n" + bars_out("b1m")
ORACLE["agg_latest_bars"] = (
    f"with {TICKS},\nlt as (select * from ticks qualify row_number() over (partition by symbol order by ts desc, seq desc) <= 500 "
    "and count(*) over (partition by symbol) >= 20),\n"
    + bars_cte("lb", "hour").replace("from ticks", "from lt").replace("ticks.ts", "lt.ts") + "\n" + bars_out("lb"))
ORACLE["agg_resample_minute"] = (
    f"with {CUM_TICKS},\nvd as (select *, greatest(coalesce(volume - {lag('volume', 1, order='ts, seq')}, 0.0), 0.0) as volume_delta from cum)\n"
    f"select symbol, date_trunc('minute', vd.ts) as ts, {r6('max_by(price, (vd.ts, seq))')} as price, {r6('sum(volume_delta)')} as volume from vd group by 1, 2")
ORACLE["agg_feed_health"] = (
    f"with {TICKS}\nselect symbol, count(*) as ticks, max(ts) as last_ts, "
    + r6("(epoch_us(timestamp '2024-01-30 23:50:00') - epoch_us(max(ts))) / 1e6") + " as age_seconds, "
    "(epoch_us(timestamp '2024-01-30 23:50:00') - epoch_us(max(ts))) / 1e6 < 30 as is_fresh from ticks group by symbol")
ORACLE["agg_label_count"] = (
    f"with {BARS_LI},\n{daily_sql('bars_li')},\n"
    f"d3 as (select *, {flag(f'is_breakout = 1 and {ratio_lt(chr(118) + 'olume', '_lv', 0.3)} and (close - {lead('close', 3)}) / nullif(close, 0) >= 0.02')} as label from d2)\n"
    "select cast(sum(label) as bigint) as positives, count(*) as rows from d3")
_ENG_F = ["price_return", "volume_change", "volatility", "breakout_strength", "is_breakout", "pv_divergence"]
ORACLE["agg_scaler_fit"] = f"with {BASE_1H},\n{ENGINE_SQL},\nef as (select " + ", ".join(
    f"cast(coalesce({c}, 0) as double) as {c}" for c in _ENG_F) + " from e2)\n" + " union all ".join(
    f"select '{c}' as feature, {i} as position, {r6(f'avg({c})')} as mean, "
    f"{r6(f'case when stddev_pop({c}) = 0 then 1.0 else stddev_pop({c}) end')} as scale from ef" for i, c in enumerate(_ENG_F))
ORACLE["agg_volume_cap"] = B1H + (
    f"select symbol, ts, {r6('volume')} as volume, {r6('quantile_cont(volume, 0.95) over (partition by symbol)')} as volume_cap, "
    f"{r6('least(volume, quantile_cont(volume, 0.95) over (partition by symbol))')} as volume_plot from bars_1h")
ORACLE["agg_distinct_symbols"] = f"with {TICKS}\nselect distinct symbol from ticks"


# ------------------------------------------------------- alerts and events
MARKET = (f"with {BASE_1H},{rt_sql()},\n{ASSET_RISK.replace(TICKS + ',', '', 1).replace(BARS_1H + ',', '', 1)},\n"
          f"chg as (select symbol, ts, {pct('price')} * 100.0 as change from frame_1h),\n"
          "mk as (select rt.symbol, rt.ts, rt.price, rt.volume, rt.trap_type, coalesce(rt._chosen[1].r, 'Monitoring...') as main_reason,"
          " rt.control, rt.risk_score as rt_score, least(ar.trap_risk_score, 100.0) as risk_score, chg.change"
          " from rt join ar on rt.symbol = ar.symbol and rt.ts = ar.ts join chg on rt.symbol = chg.symbol and rt.ts = chg.ts)")


def fmt1(x: str) -> str:
    return f"printf('%.1f', {x})"


ALERTS = MARKET + """,
al as (select symbol, ts, risk_score, change, volume, unnest(list_filter([
    case when risk_score >= 80.0 then {'alert_type': 'high_risk', 'message': 'High risk detected: ' || printf('%.1f', risk_score) || '%'} end,
    case when abs(change) >= 5.0 then {'alert_type': 'price_spike', 'message': 'Price spike detected: ' || printf('%.2f', abs(change)) || '% ' || (case when change > 0 then 'up' else 'down' end)} end,
    case when volume > 1000000.0 then {'alert_type': 'volume_anomaly', 'message': 'Unusual volume detected: ' || format('{:,.0f}', volume)} end
  ], lambda x: x is not null)) as a from mk),
alerts as (select symbol, ts, risk_score, change, volume, a.alert_type as alert_type, a.message as message from al)"""
ORACLE["alert_rules"] = ALERTS + "\n" + out_select("alerts", ["symbol", "ts", "alert_type", "message"], ["risk_score", "change", "volume"], fill=False)
ORACLE["alert_volume_multiple"] = (
    f"with {TICKS},\n{BARS_1H},\nvm as (select symbol, ts, volume, avg(volume) {W(-20, -1)} as volume_mean from bars_1h)\n"
    f"select symbol, ts, {r6('volume')} as volume, {r6('volume_mean')} as volume_mean, 'volume_anomaly' as alert_type, "
    "'Unusual volume detected: ' || format('{:,.0f}', volume) as message from vm where volume > 3.0 * volume_mean")
_SHOWN = "[{{'{name}': 'Type', 'value': alert_type, '{short}': true}}, {{'{name}': 'Risk Score', 'value': risk_text, '{short}': true}}, {{'{name}': 'Time', 'value': time_text, '{short}': true}}]"
ORACLE["snk_alert_payload"] = ALERTS + f""",
pl as (select symbol, ts, alert_type, message, {r6("risk_score")} as risk_score,
  case when risk_score >= 70 then 'danger' when risk_score >= 40 then 'warning' else 'good' end as chat_color,
  case when risk_score >= 70 then 16711680 when risk_score >= 40 then 16755200 else 65280 end as embed_color,
  'Alert: ' || upper(symbol) as title, printf('%.1f', risk_score) || '%' as risk_text, strftime(ts, '%H:%M:%S') as time_text,
  'Market alert: ' || upper(symbol) || ' - ' || alert_type as subject, strftime(ts, '%Y-%m-%d %H:%M:%S') as stamp from alerts)
select * exclude (stamp),
  concat_ws(chr(10), 'Market alerts', '', 'Symbol: ' || upper(symbol), 'Type: ' || alert_type, 'Message: ' || message, 'Risk Score: ' || risk_text,
    'Time: ' || stamp, '', 'This is an automated alert.') as mail_body,
  concat_ws(chr(10), 'ALERT [' || stamp || '] ' || upper(symbol), '   Type: ' || alert_type, '   Message: ' || message, '   Risk Score: ' || risk_text) as console_text,
  cast(to_json({{'channel': '#alerts', 'username': 'Market alerts', 'attachments': [
    {{'color': chat_color, 'title': title, 'text': message, 'fields': {_SHOWN.format(name='title', short='short')}}}]}}) as varchar) as payload,
  cast(to_json({{'username': 'Market alerts', 'embeds': [{{'title': title, 'description': message, 'color': embed_color,
    'fields': {_SHOWN.format(name='name', short='inline')}, 'timestamp': strftime(ts, '%Y-%m-%dT%H:%M:%S')}}]}}) as varchar) as embed_payload
from pl"""
ORACLE["snk_alert_history"] = ALERTS + "\n" + out_select(
    "(select * from alerts order by ts desc, symbol, alert_type limit 50)", ["symbol", "ts", "alert_type", "message"],
    ["risk_score", "change", "volume"], fill=False)


def smooth_sql(src: str, live: str | None = None) -> str:
    """The exact recurrence over all rows of a symbol: ``r`` is shown, ``s`` is the state (0: unset)."""
    on = live or "true"
    step = "case when x.o and acc.s <> 0 then 0.35 * x.r + 0.65 * acc.s else x.r end"
    return f"""sm1 as (select *, list_reduce(list({{'r': cast(risk_score as double), 's': case when {on} then cast(risk_score as double) else 0.0 end, 'o': {on}}}) {W(None, 0)},
    lambda acc, x: {{'r': {step}, 's': case when x.o then {step} else 0.0 end, 'o': x.o}}) as _m, row_number() {W()} as _pos from {src}),
sm2 as (select *, _m.r as smoothed_risk, coalesce(lag(_m.s) {W()}, 0.0) as _last from sm1),
sm3 as (select *, _pos - coalesce(max(case when smoothed_risk < 70 or not {on} then _pos end) {W(None, 0)}, 0) as streak,
    _last < 70 and smoothed_risk >= 70 and {on} as crossed_above from sm2),
sm as (select *, streak >= 3 as is_critical, case when streak >= 3 then 'CRITICAL' when {sround('smoothed_risk', 1)} > 30 then 'ELEVATED' else 'LOW' end as display_level from sm3)"""


SMOOTH_SEL = ["symbol", "ts", "streak", "crossed_above", "is_critical", "display_level"]
ORACLE["str_smoothed_risk"] = MARKET + ",\n" + smooth_sql("mk") + "\n" + out_select("sm", SMOOTH_SEL, ["risk_score", "smoothed_risk"], fill=False)
ORACLE["str_mode_suppress"] = MARKET + ",\nmkl as (select *, dayofmonth(ts) % 2 = 1 as is_live from mk),\n" + smooth_sql("mkl", "is_live") + "\n" + out_select(
    "sm", SMOOTH_SEL + ["is_live"], ["risk_score", "smoothed_risk"], fill=False)
ORACLE["fn_risk_band_display"] = MARKET + ",\n" + smooth_sql("mk") + "\n" + out_select("sm", ["symbol", "ts", "streak", "display_level"], ["smoothed_risk"], fill=False)
EVENTS = (MARKET + ",\n" + smooth_sql("mk") + ",\nev as (select symbol, ts, " + sround("price", 2) + " as price, " + sround("smoothed_risk", 1)
          + " as trap_risk_pct, trap_type, main_reason from sm where crossed_above)")
ORACLE["event_threshold_cross"] = EVENTS + "\n" + out_select("ev", ["symbol", "ts", "trap_type", "main_reason"], ["price", "trap_risk_pct"], fill=False)
ORACLE["event_top10_history"] = EVENTS + "\n" + out_select(
    "(select * from ev order by ts desc, symbol limit 10)", ["symbol", "ts", "trap_type", "main_reason"], ["price", "trap_risk_pct"], fill=False)
ORACLE["event_change_log"] = MARKET + ",\n" + smooth_sql("mk") + f""",
cl1 as (select *, case when {sround('smoothed_risk', 1)} >= 70 then 'CRITICAL' when {sround('smoothed_risk', 1)} >= 40 then 'ELEVATED' else 'NORMAL' end as _lvl from sm),
cl2 as (select symbol, ts, list_filter([
    case when crossed_above then {{'level': 'error', 'message': 'TRAP DETECTED: ' || trap_type || ' (' || cast(risk_score as varchar) || '%)'}}
         when {sround('smoothed_risk', 1)} > 40 and {lag('_lvl')} is distinct from 'ELEVATED'
         then {{'level': 'warning', 'message': 'ELEVATED RISK: ' || trap_type || ' (' || cast({sround('smoothed_risk', 1)} as varchar) || '%)'}} end,
    case when {lag('control')} is distinct from control then {{'level': 'info', 'message': 'BIAS SHIFT: ' || upper(control)}} end
  ], lambda x: x is not null) as _ev from cl1)
select symbol, ts, cast(unnest(range(len(_ev))) as integer) as seq, unnest(_ev).level as level, unnest(_ev).message as message from cl2"""

# ------------------------------------------------------- sets and top-k
ORACLE["sort_time"] = f"with {BARS_ORD}\n" + bars_out("bars_ord order by symbol, ts")
ORACLE["topk_latest_row"] = f"with {BARS_ORD}\n" + bars_out("(select * from bars_ord qualify row_number() over (partition by symbol order by ts desc) = 1)")
ORACLE["topk_tail_n"] = f"with {TICKS},\n{BARS_1H}\n" + bars_out("(select * from bars_1h qualify row_number() over (partition by symbol order by ts desc) <= 180)")
ORACLE["set_union_symbols"] = (f"with {TICKS},\n{BARS_1H},\n{BARS_LI},\n{BARS_ORD}\n"
                               + bars_out("(select * from bars_1h union all select * from bars_li union all select * from bars_ord)"))
HIST_LIVE = f"""{BASE_1H},
hist as (select * from frame_1h where dayofmonth(ts) % 2 = 0 or hour(ts) % 7 = 0),
live as (select symbol, ts, case when hour(ts) % 7 = 0 then price + 1 else price end as price, volume from frame_1h
         where dayofmonth(ts) % 2 = 1 or hour(ts) % 7 = 0)"""
ORACLE["set_merge_precedence"] = (
    f"with {HIST_LIVE},\nu as (select *, 0 as _rank from hist union all select *, 1 as _rank from live),\n"
    "b as (select * from u qualify row_number() over (partition by symbol, ts order by _rank desc) = 1),\n"
    "t as (select * from b qualify row_number() over (partition by symbol order by ts desc) <= 180)\n"
    f"select symbol, ts, {r6('price')} as price, {r6('volume')} as volume, case when _rank = 1 then 'live' else 'history' end as source from t")
ORACLE["set_source_fallback"] = (
    f"with {HIST_LIVE},\nlv as (select * from live where symbol <> 'XRP-USD')\n"
    f"select symbol, ts, {r6('price')} as price, {r6('volume')} as volume, 'live' as data_mode from lv union all "
    f"select symbol, ts, {r6('price')} as price, {r6('volume')} as volume, 'historical' as data_mode from hist "
    "where symbol not in (select distinct symbol from lv)")
ORACLE["split_train_validation"] = (
    f"with {BARS_LI},\nq as (select symbol, ts, close, row_number() {W()} as _i, count(*) over (partition by symbol) as _n from bars_li)\n"
    f"select symbol, ts, {r6('close')} as close, case when _i <= floor(_n * {1.0 - 0.2!r}) then 'train' else 'validation' end as split from q")


# ------------------------------------------------------- sources / feeds
ORACLE["src_ticker_json"] = f"with {TICKS}\n" + (
    "select seq, lower(regexp_replace(symbol, '-USD$', 'USDT')) as symbol, epoch_ms(epoch_us(ts) // 1000) as ts, "
    f"{r6('case when seq % 13 = 0 then null else price end')} as price, {r6('price * 1.01')} as high, {r6('price * 0.99')} as low, "
    f"{r6('volume')} as volume, {r6('price * volume')} as quote_volume from ticks where seq % 17 <> 0 and not (seq % 2 = 0 and seq % 11 = 0)")
ORACLE["src_trade_json"] = f"with {TICKS}\n" + (
    f"select seq, ts, split_part(symbol, '-', 1) as symbol, {r6('case when seq % 23 = 0 then 0.0 else price end')} as price, "
    f"{r6('coalesce(volume, 0.0)')} as volume from ticks where seq % 7 <> 0 and seq % 19 <> 0")
ORACLE["src_kline_array"] = f"with {TICKS},\n{BARS_1H}\n" + (
    f"select symbol, ts, {r6('open')} as open, {r6('high')} as high, {r6('low')} as low, {r6('close')} as close, "
    f"{r6('case when hour(ts) = 5 then null else volume end')} as volume, {r6('close')} as price from bars_1h")
ORACLE["src_order_book_ladder"] = f"""with {TICKS},
t as (select symbol, date_trunc('hour', ts) as ts, seq, price, volume / 100.0 as qty from ticks),
b as (select symbol, ts, 'bid' as side, row_number() over (partition by symbol, ts order by price desc, seq) as level, price, qty from t qualify level <= 10),
a as (select symbol, ts, price, qty, row_number() over (partition by symbol, ts order by price asc, seq) as r, count(*) over (partition by symbol, ts) as n from t),
a2 as (select symbol, ts, 'ask' as side, least(n, 10) - r + 1 as level, price, qty from a where r <= 10),
lad as (select * from b union all select * from a2)
select symbol, ts, side, cast(level as integer) as level, {r6('price')} as price, {r6('qty')} as qty,
  least(100, cast(trunc(qty * 40.0) as integer)) as fill from lad"""
_CANON = "case when upper(trim(raw)) like '%-%' then upper(trim(raw)) else regexp_replace(upper(trim(raw)), 'USDT$', '-USD') end"
ORACLE["src_symbol_normalize"] = f"""with {TICKS},
r as (select symbol as raw from ticks union select regexp_replace(upper(symbol), '-USD$', 'USDT') from ticks
      union select lower(regexp_replace(upper(symbol), '-USD$', 'USDT')) from ticks),
c as (select raw, {_CANON} as canonical from r)
select raw, canonical, regexp_replace(upper(canonical), '-USD$', 'USDT') as exchange, lower(regexp_replace(upper(canonical), '-USD$', 'USDT')) as stream from c"""
ORACLE["src_daily_dialect"] = f"with {BARS_LI}\n" + (
    f"select ts as timestamp, symbol, {r6('close')} as price, {r6('volume')} as volume, {r6('open')} as Open, {r6('high')} as High, "
    f"{r6('low')} as Low, {r6('close')} as Close from bars_li")
ORACLE["src_coerce_types"] = (
    "select l_orderkey, l_linenumber, date_trunc('day', l_shipdate) as shipdate, "
    f"{r6('case when l_linenumber = 7 then null else l_quantity end')} as quantity, {r6('l_extendedprice')} as extendedprice from lineitem")
ORACLE["src_bars_file"] = f"with {BARS_ORD}\n" + bars_out("bars_ord")

# ------------------------------------------------------------ anomaly model
ORACLE["ml_scale"] = f"with {BASE_1H},\n{ENGINE_SQL},\nef as (select symbol, ts, " + ", ".join(
    f"cast(coalesce({c}, 0) as double) as {c}" for c in _ENG_F) + " from e2)\nselect symbol, ts, " + ", ".join(
    r6(f"({c} - avg({c}) over ()) / (case when stddev_pop({c}) over () = 0 then 1.0 else stddev_pop({c}) over () end)") + f" as {c}"
    for c in _ENG_F) + " from ef"



def forest_sql(src: str, cols: list[str], trees: int = 100, psi: int = 256, seed: int = 42, asked: str | None = None) -> str:
    """Isolation forest over ``src`` (symbol, ts, columns): ``zs`` (scaled rows), ``nodes``, and ``scores`` of the rows of ``asked`` (``src``).

    Unrolled to the depth of a full sample, all rows of a node by one window."""
    depth = 8
    z = [f"coalesce({sround(f'({c} - m{i}) / (case when s{i} = 0 then 1.0 else s{i} end)', 9)}, 0.0) as x{i}" for i, c in enumerate(cols)]
    stat = ", ".join(f"avg({c}) as m{i}, stddev_pop({c}) as s{i}" for i, c in enumerate(cols))
    xs = [f"x{i}" for i in range(len(cols))]
    hexa = lambda text, at: f"cast('0x' || substr(md5({text}), {at}, 13) as bigint)"
    out = [f"""zstat as materialized (select count(*) as n, {stat} from {src})""",
           f"""zs as materialized (select symbol, ts, row_number() over (order by symbol, ts) as rid, n, {', '.join(z)} from {src}, zstat)""",
           f"""za as materialized (select symbol, ts, row_number() over (order by symbol, ts) as rid, n, {', '.join(z)} from {asked or src}, zstat)""",
           f"""hs as (select *, {hexa(f"symbol || '|' || cast(ts as varchar) || '|{seed}'", 1)} as ha, {hexa(f"symbol || '|' || cast(ts as varchar) || '|{seed}'", 14)} as hb from zs)""",
           f"""lv0 as materialized (select tree_id, rid, {', '.join(xs)}, 0 as node, least(n, {psi}) as psi from hs, (select unnest(range({trees})) as tree_id)
  qualify row_number() over (partition by tree_id order by (ha + tree_id * hb) % 4503599627370496, symbol, ts) <= least(n, {psi}))"""]
    told = []
    for d in range(depth + 1):
        ext = ", ".join(f"min({x}) over w as lo{i}, max({x}) over w as hi{i}" for i, x in enumerate(xs))
        usable = "list_filter([" + ", ".join(f"case when hi{i} > lo{i} then {i} end" for i in range(len(xs))) + "], lambda k: k is not null)"
        name = f"'{seed}:' || cast(tree_id as varchar) || ':' || cast(node as varchar)"
        lo, hi, own = ("[" + ", ".join(f"{p}{i}" for i in range(len(xs))) + "]" for p in ("lo", "hi", "x"))
        out.append(f"st{d} as (select *, count(*) over w as size, {ext} from lv{d} window w as (partition by tree_id, node))")
        out.append(f"us{d} as (select *, {usable} as us, {hexa(name, 1)} / 4503599627370496.0 as u1, {hexa(name, 14)} / 4503599627370496.0 as u2 from st{d})")
        out.append(f"lf{d} as (select *, {d} >= ceil(log2(greatest(psi, 2))) or len(us) = 0 as is_leaf, us[cast(floor(u1 * len(us)) as integer) + 1] as f from us{d})")
        out.append(f"th{d} as materialized (select *, {lo}[f + 1] + u2 * ({hi}[f + 1] - {lo}[f + 1]) as t, {own}[f + 1] as own from lf{d})")
        out.append(f"lv{d + 1} as (select tree_id, rid, {', '.join(xs)}, case when own < t then node * 2 + 1 else node * 2 + 2 end as node, psi from th{d} where not is_leaf)")
        told.append(f"select distinct tree_id, node, case when is_leaf then -1 else f end as feature, case when is_leaf then 0.0 else t end as threshold, size, {d} as depth, is_leaf from th{d}")
    out.append("nodes as materialized (" + " union all ".join(told) + ")")
    cfac = lambda n: f"(case when {n} > 2 then 2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n} when {n} = 2 then 1.0 else 0.0 end)"
    out.append(f"wk0 as (select z.rid, z.n, {', '.join('z.' + x for x in xs)}, nd.* from za z, nodes nd where nd.node = 0)")
    for d in range(depth):
        own = "[" + ", ".join(f"w.{x}" for x in xs) + "]"
        out.append(f"wk{d + 1} as (select w.rid, w.n, {', '.join('w.' + x for x in xs)}, nd.* from wk{d} w join nodes nd on nd.tree_id = w.tree_id "
                   f"and nd.node = case when {own}[w.feature + 1] < w.threshold then w.node * 2 + 1 else w.node * 2 + 2 end where not w.is_leaf)")
    ends = " union all ".join(f"select rid, n, depth + {cfac('size')} as h from wk{d} where is_leaf" for d in range(depth + 1))
    out.append(f"scores as materialized (select z.symbol, z.ts, power(2.0, -avg(h) / {cfac(f'least(any_value(e.n), {psi})')}) as anomaly_score "
               f"from ({ends}) e join za z using (rid) group by z.symbol, z.ts)")
    return ",\n".join(out)


FOREST = f"with {BASE_1H},\n{ENGINE_SQL},\nef as materialized (select symbol, ts, price, volume, " + ", ".join(
    f"cast(coalesce({c}, 0) as double) as {c}" for c in _ENG_F) + " from e2),\n" + forest_sql("ef", _ENG_F) + f""",
scored as materialized (select ef.*, anomaly_score, greatest(0.0, least(100.0, case when max(anomaly_score) {W(-99, 0)} - min(anomaly_score) {W(-99, 0)} > 0
    then (anomaly_score - min(anomaly_score) {W(-99, 0)}) / (max(anomaly_score) {W(-99, 0)} - min(anomaly_score) {W(-99, 0)}) * 100.0 else 50.0 end)) as risk_percentage
  from ef join scores using (symbol, ts))"""
ORACLE["ml_iforest_fit"] = FOREST + f"""
select cast(tree_id as integer) as tree_id, cast(node as integer) as node_id, cast(case when is_leaf then -1 else node * 2 + 1 end as integer) as "left",
  cast(case when is_leaf then -1 else node * 2 + 2 end as integer) as "right", cast(feature as integer) as feature, {r6('threshold')} as threshold,
  cast(size as integer) as size, cast(depth as integer) as depth, is_leaf from nodes"""
ORACLE["ml_iforest_score"] = FOREST + f"\nselect symbol, ts, {r6('anomaly_score')} as anomaly_score from scored"
ORACLE["ml_latest_risk"] = FOREST + (f"\nselect symbol, ts, {r6('anomaly_score')} as anomaly_score, {r6('risk_percentage')} as risk_percentage from scored "
                                     "qualify row_number() over (partition by symbol order by ts desc) = 1")
ORACLE["ml_score_table"] = FOREST + "\nselect symbol, ts, " + ", ".join(
    f"{r6(c)} as {c}" for c in ["price", "volume"] + _ENG_F + ["anomaly_score", "risk_percentage"]) + f", {band_model_sql('risk_percentage')} as risk_level from scored"
ORACLE["snk_model"] = ORACLE["ml_iforest_fit"]
_PCT = f"""greatest(0.0, least(100.0, case when max(anomaly_score) {W(-99, 0)} - min(anomaly_score) {W(-99, 0)} > 0
    then (anomaly_score - min(anomaly_score) {W(-99, 0)}) / (max(anomaly_score) {W(-99, 0)} - min(anomaly_score) {W(-99, 0)}) * 100.0 else 50.0 end))"""
ORACLE["ml_retrain_job"] = f"with {BASE_1H},\n{TICK_SQL},\nef as materialized (select symbol, ts, " + ", ".join(
    f"cast(coalesce({c}, 0) as double) as {c}" for c in _ENG_F) + f""" from t2),
cutoff as (select symbol, floor(count(*) * (1.0::double - 0.2::double)) as cut from ef group by symbol),
parts as materialized (select ef.*, row_number() over (partition by ef.symbol order by ts) <= cut as is_train from ef join cutoff using (symbol)),
tr as materialized (select * from parts where is_train), va as materialized (select * from parts where not is_train),
{forest_sql('tr', _ENG_F, asked='va')},
rp as materialized (select symbol, ts, anomaly_score, {_PCT} as pct from scores),
metric as (select count(*) as validation_samples, {r6('avg(cast(pct > 90 as double))')} as anomaly_rate, {r6('avg(pct)')} as mean_score,
  {r6('stddev_pop(pct)')} as std_score, cast(count_if(pct > 80) as bigint) as high_risk_count,
  {r6('avg(anomaly_score) filter (where anomaly_score >= (select quantile_cont(anomaly_score, 0.95) from scores)) - avg(anomaly_score)')} as margin from rp),
kept as (select cast(sum(least(n, 100)) as bigint) as kept_scores, count(*) as symbols, cast(sum(n) as bigint) as train_rows from (select symbol, count(*) as n from tr group by symbol))
select run, train_rows, symbols, validation_samples, anomaly_rate, mean_score, std_score, high_risk_count, (select count(*) from nodes) as n_nodes, kept_scores,
  0.0::double as reload_difference, margin, case when run = 2 then margin end as current_margin, run = 1 as promoted
from metric, kept, (select unnest([1, 2]) as run)"""
ORACLE["risk_snapshot_ml"] = (FOREST + f",{rt_sql('scored', 'risk_percentage')},\nlatest as (select * from rt qualify row_number() over (partition by symbol order by ts desc) = 1)\n"
                              + rt_flat_select("latest"))
ORACLE["str_score_window"] = FOREST + f"\nselect symbol, ts, {r6('anomaly_score')} as anomaly_score, {r6('risk_percentage')} as risk_percentage from scored"

# ------------------------------------------------------------------ sinks (read-back equals the written query)
ORACLE["snk_features_partitioned"] = ORACLE["feat_core"]
ORACLE["snk_table"] = ORACLE["lbl_trap"]

ORACLE["src_require_columns"] = f"with {TICKS},\n{BARS_1H}\n" + bars_out("bars_1h")

# ------------------------------------------------- streaming (batch twins)
_TICK_COLS = f"symbol, ts, seq, {r6('price')} as price, {r6('volume')} as volume"
ORACLE["src_stream_files"] = f"with {TICKS}\nselect {_TICK_COLS} from ticks"
ORACLE["str_dedup"] = f"with {TICKS}\nselect {_TICK_COLS} from ticks"
ORACLE["str_bars"] = f"with {TICKS},\n{BARS_1H}\n" + bars_out(
    "(select * from bars_1h where ts + interval 1 hour <= (select max(ts) from ticks) - interval 10 minute)")
ORACLE["str_volume_delta"] = ORACLE["win_diff_clip"]
ORACLE["str_smoothed_risk_stream"] = MARKET + ",\n" + smooth_sql("mk") + "\n" + out_select(
    "sm", ["symbol", "ts", "streak", "crossed_above", "is_critical"], ["risk_score", "smoothed_risk"], fill=False)
ORACLE["str_micro_batch_scoring"] = RT + (
    "select symbol, ts, " + r6("risk_score") + " as risk_score, risk_level, trap_type, control, "
    + ", ".join(f"{r6(c)} as {c}" for c in COMPS) + ", "
    + ", ".join(f"_chosen[{i}].r as reason_{i}, case when _chosen[{i}].c is not null then "
                f"{sround(f'greatest(0.0, least(1.0, _chosen[{i}].c)) * 100.0', 1)} end as confidence_{i}" for i in (1, 2, 3))
    + " from rt where ts + interval 1 hour <= (select max(ts) from ticks) - interval 10 minute")

# realtime reasons with the per-asset score as the anomaly input (defined after ASSET_RISK)
ORACLE["risk_reasons_rt"] = (
    f"with {BASE_1H},\n{ASSET_RISK.replace(TICKS + ',', '', 1).replace(BARS_1H + ',', '', 1)},\n"
    "fa as (select f.symbol, f.ts, f.price, f.volume, least(ar.trap_risk_score, 100.0) as anom from frame_1h f "
    f"join ar on f.symbol = ar.symbol and f.ts = ar.ts),{rt_sql('fa', 'anom')}\n" + (
    "select symbol, ts, cast(pos as integer) as pos, x.r as reason, "
    f"{sround('greatest(0.0, least(1.0, x.c)) * 100.0', 1)} as confidence from "
    "(select symbol, ts, unnest(range(len(_chosen))) as pos, unnest(_chosen) as x from rt)"))
