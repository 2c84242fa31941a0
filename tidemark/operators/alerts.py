"""Alert rules, risk smoothing (streak / crossing) and event logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import series as S
from tidemark.functions.scalar import band_display, fixed, truth
from tidemark.plans.partitioning import Series, over_series, running_totals
from tidemark.plans.recurrence import Ema, with_emas

# Alert type names, message and event texts, the smoothing constants.
ALERT_TYPES = ["high_risk", "price_spike", "volume_anomaly", "connection_lost", "trap_detected"]
ALERT_TEXT = ["High risk detected: ", "Price spike detected: ", "Unusual volume detected: "]
EVENT_TEXT = ["TRAP DETECTED: ", "ELEVATED RISK: ", "BIAS SHIFT: "]
CHAT_COLORS = ["good", "warning", "danger"]
EMBED_COLORS = [0x00FF00, 0xFFAA00, 0xFF0000]
EMA_ALPHA = 0.35
CRITICAL_THRESHOLD = 70.0
CRITICAL_STREAK_UPDATES = 3


def market_rows(bars: DataFrame, **plan) -> DataFrame:
    """Per bar: realtime risk fields, change % and the per-asset trap score
    (capped at 100) as ``risk_score``, the raw risk that drives alerts and
    events. One pass over the series makes all of them; ``bar_no`` is the
    bar's position in its series, so later passes need not number it again."""
    from tidemark.operators import features as FT
    from tidemark.operators import risk as R
    from tidemark.operators.params import PARAM_COLUMNS, with_asset_params

    def build(d, s: Series):
        d = d.withColumn("change", S.pct_change("close", s) * 100.0)
        d = FT.asset_cols(d, s)
        d = d.withColumn("asset", F.struct(*[F.col(c) for c in FT.ASSET_OUT]))
        d = d.drop(*[c for c in FT.ASSET_OUT if c not in FT.BAR_COLS], *[c for c in PARAM_COLUMNS if c != "symbol"])
        return R.rt_cols(d.withColumn("price", F.col("close")), s)

    out = R.rt_score_cols(over_series(with_asset_params(bars.select(*FT.BAR_COLS)), build, halo=48, **plan))
    shown = ["price", "volume", "bar_no", "trap_type", "main_reason", "control", "change"]
    rt = F.struct(*[F.col(c) for c in shown], F.col("risk_score").alias("rt_score"))
    feats = out.select("symbol", "ts", rt.alias("rt"), *[F.col(f"asset.{c}").alias(c) for c in FT.ASSET_OUT if c not in ("symbol", "ts")])
    asset = R.asset_report(FT._fill(feats, FT.ASSET_OUT))
    return asset.select("symbol", "ts", "rt.*", F.least(F.col("trap_risk_score"), F.lit(100.0)).alias("risk_score"))


def alert_rules(df: DataFrame, high_risk: float = 80.0, price_spike: float = 5.0, volume_limit: float = 1_000_000.0,
                risk: str = "risk_score", change: str = "change", volume: str = "volume") -> DataFrame:
    """0..3 alerts per row: high risk, price spike (|change %|), volume."""
    r, c, v = F.col(risk), F.col(change), F.col(volume)
    cands = F.array(
        F.when(r >= high_risk, F.struct(F.lit(ALERT_TYPES[0]).alias("alert_type"),
                                        F.concat(F.lit(ALERT_TEXT[0]), fixed(r, 1), F.lit("%")).alias("message"))),
        F.when(F.abs(c) >= price_spike, F.struct(
            F.lit(ALERT_TYPES[1]).alias("alert_type"),
            F.concat(F.lit(ALERT_TEXT[1]), fixed(F.abs(c), 2), F.lit("% "),
                     F.when(c > 0, "up").otherwise("down")).alias("message"))),
        F.when(v > volume_limit, F.struct(F.lit(ALERT_TYPES[2]).alias("alert_type"),
                                          F.concat(F.lit(ALERT_TEXT[2]), F.format_number(v, 0)).alias("message"))),
    )
    keep = [x for x in df.columns if x not in ("alert_type", "message")]
    return df.select(*keep, F.explode(F.array_compact(cands)).alias("_a")).select(*keep, "_a.alert_type", "_a.message")


def volume_multiple_alerts(bars: DataFrame, k: float = 3.0, window: int = 20, **plan) -> DataFrame:
    """Volume above k x its trailing mean (previous ``window`` bars)."""
    def build(d, s: Series):
        return d.withColumn("volume_mean", S.rolling_prev(F.avg, "volume", window, s))
    out = over_series(bars.select("symbol", "ts", "volume"), build, halo=window, **plan)
    hit = out.filter(F.col("volume") > F.lit(k) * F.col("volume_mean"))
    return hit.select("symbol", "ts", "volume", "volume_mean", F.lit(ALERT_TYPES[2]).alias("alert_type"),
                      F.concat(F.lit(ALERT_TEXT[2]), F.format_number("volume", 0)).alias("message"))


def smoothed_cols(df: DataFrame, s: Series, raw: str, alpha: float, threshold: float, streak_n: int,
                  live: str | None = None) -> DataFrame:
    """Per-symbol smoothing state as columns (batch twin of the keyed state).

    A state of 0 means "unset": the first score after it is shown as it is.
    Rows that are not ``live`` show their raw score, raise no crossing and
    unset the whole state (smoothed value, last value, streak).
    """
    df = with_emas(df, s, [Ema("smoothed_risk", raw, alpha, live, zero_unset=True, before="_last")])
    df = df.withColumn("_pos", s.position())
    above = F.col("smoothed_risk") >= threshold
    if live:
        above = above & F.col(live)
    df = running_totals(df, s, {"_last_below": F.when(~truth(above), F.col("_pos").cast("double"))}, how="max")
    streak = (F.col("_pos") - F.coalesce(F.col("_last_below"), F.lit(0.0))).cast("long")
    return (
        df.withColumn("streak", streak)
        .withColumn("crossed_above", truth((F.col("_last") < threshold) & above))
        .withColumn("is_critical", F.col("streak") >= streak_n)
        .drop("_last", "_pos", "_last_below")
    )


def smoothed_risk(df: DataFrame, raw: str = "risk_score", alpha: float = EMA_ALPHA, threshold: float = CRITICAL_THRESHOLD,
                  streak_n: int = CRITICAL_STREAK_UPDATES, live: str | None = None, written: bool = False, **plan) -> DataFrame:
    """EMA-smoothed risk, streak of updates >= threshold, upward crossing,
    critical flag and display level, per symbol in time order. The chunks are
    read twice; ``written`` says that ``df`` is a written table with its row
    numbers (``index``), so they need not be written again."""
    out = over_series(df, lambda d, s: smoothed_cols(d, s, raw, alpha, threshold, streak_n, live),
                      halo=0, checkpoint=not (written or plan.get("plain", False)), **plan)
    return out.withColumn("display_level", band_display("streak", F.round("smoothed_risk", 1)))  # the shown value decides


def threshold_cross_events(sm: DataFrame) -> DataFrame:
    """A trap event whenever the smoothed risk crosses the threshold upwards."""
    return sm.filter("crossed_above").select(
        "symbol", "ts", F.round("price", 2).alias("price"), F.round("smoothed_risk", 1).alias("trap_risk_pct"),
        "trap_type", "main_reason",
    )


def top_events(events: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` events overall (partial top-n per task, then merged)."""
    return events.orderBy(F.col("ts").desc(), F.col("symbol")).limit(n)


def change_log(sm: DataFrame, **plan) -> DataFrame:
    """Event log: trap detected on an upward crossing, otherwise elevated
    risk on entry to the elevated log level; bias shift whenever the
    control label changes (and on the first row)."""
    def build(d, s: Series):
        shown = F.round("smoothed_risk", 1)  # bands are taken on the value as shown
        lvl = F.when(shown >= 70, "CRITICAL").when(shown >= 40, "ELEVATED").otherwise("NORMAL")
        d = d.withColumn("_lvl", lvl)
        prev_lvl, prev_ctl = S.lag("_lvl", s), S.lag("control", s)
        risk_ev = (
            F.when(F.col("crossed_above"), F.struct(F.lit("error").alias("level"), F.concat(
                F.lit(EVENT_TEXT[0]), F.col("trap_type"), F.lit(" ("), F.col("risk_score").cast("string"), F.lit("%)")).alias("message")))
            .when((shown > 40) & ~prev_lvl.eqNullSafe(F.lit("ELEVATED")), F.struct(
                F.lit("warning").alias("level"), F.concat(F.lit(EVENT_TEXT[1]), F.col("trap_type"), F.lit(" ("),
                                                         F.round("smoothed_risk", 1).cast("string"), F.lit("%)")).alias("message")))
        )
        ctl_ev = F.when(~prev_ctl.eqNullSafe(F.col("control")), F.struct(
            F.lit("info").alias("level"), F.concat(F.lit(EVENT_TEXT[2]), F.upper("control")).alias("message")))
        return d.withColumn("_ev", F.array_compact(F.array(risk_ev, ctl_ev)))
    out = over_series(sm, build, halo=1, **plan)
    return out.select("symbol", "ts", F.posexplode("_ev").alias("seq", "e")).select("symbol", "ts", "seq", "e.level", "e.message")


def alert_payload(alerts: DataFrame, sender: str = "Market alerts", channel: str = "#alerts") -> DataFrame:
    """Delivery-ready fields and texts of each alert: severity colours (70 / 40
    bands), title, formatted score and time, mail subject and body, console
    text, and the JSON bodies of a chat message and of an embed."""
    r = F.col("risk_score")
    upper = F.upper("symbol")
    out = alerts.select(
        "symbol", "ts", "alert_type", "message", "risk_score",
        F.when(r >= 70, CHAT_COLORS[2]).when(r >= 40, CHAT_COLORS[1]).otherwise(CHAT_COLORS[0]).alias("chat_color"),
        F.when(r >= 70, F.lit(EMBED_COLORS[2])).when(r >= 40, F.lit(EMBED_COLORS[1])).otherwise(F.lit(EMBED_COLORS[0])).alias("embed_color"),
        F.concat(F.lit("Alert: "), upper).alias("title"),
        F.concat(fixed(r, 1), F.lit("%")).alias("risk_text"),
        F.date_format("ts", "HH:mm:ss").alias("time_text"),
        F.concat(F.lit("Market alert: "), upper, F.lit(" - "), F.col("alert_type")).alias("subject"),
    )
    when = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    facts = [("Symbol", upper), ("Type", F.col("alert_type")), ("Message", F.col("message")), ("Risk Score", F.col("risk_text")), ("Time", when)]
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in facts]
    shown = [("Type", F.col("alert_type")), ("Risk Score", F.col("risk_text")), ("Time", F.col("time_text"))]

    def fields(name: str, short: str):
        return F.array(*[F.struct(F.lit(n).alias(name), v.alias("value"), F.lit(True).alias(short)) for n, v in shown]).alias("fields")

    attachment = F.struct(F.col("chat_color").alias("color"), "title", F.col("message").alias("text"), fields("title", "short"))
    embed = F.struct("title", F.col("message").alias("description"), F.col("embed_color").alias("color"), fields("name", "inline"),
                     F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    return out.withColumns({
        "mail_body": F.concat_ws("\n", F.lit(sender), F.lit(""), *lines, F.lit(""), F.lit("This is an automated alert.")),
        "console_text": F.concat_ws("\n", F.concat(F.lit("ALERT ["), when, F.lit("] "), upper), *[F.concat(F.lit("   "), x) for x in lines[1:4]]),
        "payload": F.to_json(F.struct(F.lit(channel).alias("channel"), F.lit(sender).alias("username"), F.array(attachment).alias("attachments"))),
        "embed_payload": F.to_json(F.struct(F.lit(sender).alias("username"), F.array(embed).alias("embeds"))),
    })


def alert_history(alerts: DataFrame, n: int = 50) -> DataFrame:
    """Newest ``n`` alerts (the read side of the alert history)."""
    return alerts.orderBy(F.col("ts").desc(), F.col("symbol"), F.col("alert_type")).limit(n)
