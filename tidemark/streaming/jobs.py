"""Streaming counterparts of the batch operators.

Sources are file streams (``readStream.schema(..).parquet(dir)`` with
``maxFilesPerTrigger``); the same code takes ``format("kafka")`` in
production. Row windows (lag, rolling) are not allowed on streams, so:
bars are a watermarked windowed aggregate; sequential per-symbol state
(cumulative volume, smoothed risk, score windows) is keyed state in event time
(``event_time``) holding a bounded value per symbol; full
feature scoring runs in ``foreachBatch`` over closed bars plus a bounded
per-symbol history table.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.alerts import CRITICAL_STREAK_UPDATES, CRITICAL_THRESHOLD, EMA_ALPHA
from tidemark.operators.bars import ohlcv_bars
from tidemark.plans.recurrence import ema_path
from tidemark.session import ensure_checkpoint_dir
from tidemark.sinks import append_alert_history, finished_versions, remove_versions
from tidemark.sources.fixtures import events_to_ticks
from tidemark.streaming.event_time import end_marker, in_event_time, run_with_late

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


FILE_ROWS = 1_000_000  # rows of a replayed file


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never machine-local)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize_in_order(df: DataFrame, path: str, order: str = "ts", files: int = 4) -> str:
    """Write ``df`` as time-ordered appends of one file each (``files`` or, at
    more than ``FILE_ROWS`` rows a file, more) so a file stream replays it in
    event-time order (one file per trigger). Files hold about equally many rows
    whatever the times; rows without a time are files of their own and come
    first, as in a sort; an empty table is an empty folder."""
    spark = df.sparkSession
    df.write.parquet(f"{path}-rows")
    rows = spark.read.schema(df.schema).parquet(f"{path}-rows")
    n = rows.count()
    if not n:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
        return path
    ties = [F.col(c) for c in ("seq", "event_id") if c in df.columns]
    parts = (rows.repartitionByRange(max(files, -(-n // FILE_ROWS)), F.col(order), *ties, F.xxhash64(*df.columns))
             .withColumn("_timed", F.col(order).isNotNull().cast("int")).withColumn("_part", F.spark_partition_id()))
    parts.write.partitionBy("_timed", "_part").parquet(f"{path}-parts")
    for timed, part in sorted(tuple(r) for r in spark.read.parquet(f"{path}-parts").select("_timed", "_part").distinct().collect()):
        one = spark.read.schema(df.schema).parquet(f"{path}-parts/_timed={timed}/_part={part}")
        one.coalesce(1).write.mode("append").parquet(path)
    return path


def tick_stream(spark: SparkSession, src_dir: str, glob: str = "events.parquet", max_files: int = 1) -> DataFrame:
    raw = (spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", glob)
           .option("maxFilesPerTrigger", max_files).parquet(src_dir))
    return events_to_ticks(raw)


def file_stream(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def run_available_now(sdf: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything available, into a Parquet sink under
    the checkpoint dir; return the sink read back as a batch DataFrame."""
    spark = sdf.sparkSession
    base = scratch(spark, name)
    q = (sdf.writeStream.format("parquet").option("path", f"{base}/data")
         .option("checkpointLocation", f"{base}/_checkpoint").outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(sdf.schema).parquet(f"{base}/data")


# ------------------------------------------------------------------ bars
def stream_bars(ticks: DataFrame, seconds: int = 3600, watermark: str = "10 minutes") -> DataFrame:
    """Live tumbling OHLCV; append mode emits a window once the watermark
    passes its end. A late tick is judged by the watermark of the batch before
    its own: it is dropped if that one has passed the window's end, and still
    joins a window that is not put out yet."""
    return ohlcv_bars(ticks.withWatermark("ts", watermark), seconds)


def stream_dedup(ticks: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Drop re-polled rows: one row per (symbol, ts) within the watermark."""
    return ticks.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["symbol", "ts"])


# ------------------------------------------------------------ keyed state
DELTA_OUT = "symbol string, ts timestamp, seq long, volume double, volume_delta double"


def _volume_step(rows: pd.DataFrame, carry: tuple | None) -> tuple[pd.DataFrame, tuple]:
    before = np.nan if carry is None or carry[0] is None else carry[0]
    v = rows["volume"].to_numpy(dtype="float64")
    step = np.diff(v, prepend=before)
    return rows.assign(volume_delta=np.fmax(np.nan_to_num(step, nan=0.0), 0.0)), (float(v[-1]),)


def stream_volume_delta(cumulative: DataFrame, watermark: str = "10 minutes", ttl: str | None = None) -> DataFrame:
    """Cumulative (24 h style) volume -> increments, per symbol in event time;
    state is the last cumulative value (lag() is not available on streams)."""
    rows = cumulative.select("symbol", "ts", "seq", "volume")
    return in_event_time(rows, _volume_step, DELTA_OUT, "last double", ["ts", "seq"], watermark, ttl)


SMOOTH_OUT = "symbol string, ts timestamp, risk_score double, smoothed_risk double, streak long, crossed_above boolean, is_critical boolean"


def _smooth_step(rows: pd.DataFrame, carry: tuple | None) -> tuple[pd.DataFrame, tuple]:
    held, run = carry if carry is not None else (0.0, 0)
    live = rows["is_live"].astype(bool).to_numpy() if "is_live" in rows.columns else np.ones(len(rows), bool)
    raw = rows["risk_score"].to_numpy(dtype="float64")
    shown, after = ema_path(raw, EMA_ALPHA, live, held or np.nan, zero_unset=True)
    after = np.nan_to_num(after)
    above = (shown >= CRITICAL_THRESHOLD) & live
    place = np.arange(1, len(rows) + 1)
    below = np.maximum.accumulate(np.where(above, 0, place))
    streak = place - below + np.where(below == 0, run, 0)
    crossed = above & (np.concatenate(([held], after[:-1])) < CRITICAL_THRESHOLD)
    return rows.assign(smoothed_risk=shown, streak=streak, crossed_above=crossed,
                       is_critical=streak >= CRITICAL_STREAK_UPDATES), (float(after[-1]), int(streak[-1]))


def stream_smoothed_risk(scored: DataFrame, watermark: str = "10 minutes", ttl: str | None = None) -> DataFrame:
    """EMA-smoothed risk, streak and upward crossing per symbol in event time
    (two numbers of state a symbol). An optional ``is_live`` column marks
    rows from a non-live source: they show their raw score, raise no crossing
    and unset the state."""
    cols = ["symbol", "ts", "risk_score"] + (["is_live"] if "is_live" in scored.columns else [])
    return in_event_time(scored.select(*cols), _smooth_step, SMOOTH_OUT, "smoothed double, streak long", ["ts"], watermark, ttl)


WINDOW_OUT = "symbol string, ts timestamp, anomaly_score double, risk_percentage double"


SCORE_WINDOW = 100


def _window_step(rows: pd.DataFrame, carry: tuple | None) -> tuple[pd.DataFrame, tuple]:
    """Position of each score between the extremes of the trailing window:
    rolling extremes over the carried scores and the new ones together."""
    carried = list(carry[0]) if carry is not None else []
    scores = pd.Series([*carried, *rows["anomaly_score"].astype("float64")])
    trailing = scores.rolling(SCORE_WINDOW, min_periods=1)
    low = trailing.min()
    spread = trailing.max() - low
    share = ((scores - low) / spread.where(spread > 0) * 100.0).fillna(50.0).clip(0.0, 100.0)
    return rows.assign(risk_percentage=share.to_numpy()[len(carried):]), (scores.iloc[-SCORE_WINDOW:].tolist(),)


def stream_score_window(scored: DataFrame, watermark: str = "10 minutes", ttl: str | None = None) -> DataFrame:
    """Rolling min-max risk % over each symbol's last 100 scores in event
    time (at most 100 doubles of state a symbol)."""
    rows = scored.select("symbol", "ts", "anomaly_score")
    return in_event_time(rows, _window_step, WINDOW_OUT, "scores array<double>", ["ts"], watermark, ttl)


WAVES = 2


def write_waves(df: DataFrame, path: str, order: str = "ts", waves: int = WAVES, closing: bool = True) -> str:
    """``df`` as ``waves`` folders of consecutive event time (rows without a
    time in the first), and with ``closing`` a last one with the end marker. The number of jobs
    does not grow with the data and no file is written by one task alone."""
    spark = df.sparkSession
    df.write.parquet(f"{path}-rows")
    rows = spark.read.schema(df.schema).parquet(f"{path}-rows")
    at = F.unix_micros(F.col(order).cast("timestamp"))
    cuts = rows.agg(F.percentile_approx(at, [(i + 1) / waves for i in range(waves - 1)])).first()[0] or []
    wave = sum([F.coalesce((at > c).cast("int"), F.lit(0)) for c in cuts], F.lit(0))
    rows.withColumn("_wave", wave).write.partitionBy("_wave").parquet(path)
    if closing:
        end_marker(df, time=order).write.parquet(f"{path}/_wave={waves}")
    return path


def waves(spark: SparkSession, path: str, schema, count: int = WAVES):
    """The stream over the first folder of ``write_waves``, over the first two, and so on."""
    for k in range(count):
        seen = ",".join(map(str, range(k + 1)))
        yield spark.readStream.schema(schema).parquet(f"{path}/_wave={{{seen}}}")


def run_waves(spark: SparkSession, path: str, schema, build, name: str, count: int = WAVES) -> tuple[DataFrame, DataFrame]:
    """Run ``build(stream)`` over the folders of ``write_waves``, a restart from
    the checkpoint after each: results in time, and late rows."""
    base = scratch(spark, name)
    for raw in waves(spark, path, schema, count + 1):
        out = run_with_late(build(raw), name, base)
    return out


# ------------------------------------------------------ micro-batch scoring
def micro_batch_scorer(spark: SparkSession, ticks: DataFrame, history_rows: int = 180, seconds: int = 3600,
                  watermark: str = "10 minutes", interval: str | None = None, base: str | None = None,
                  alerts_path: str | None = None):
    """ticks -> closed bars -> (bounded history + new bars) -> realtime
    risk per new bar, appended to a table; with ``alerts_path`` the alert
    rules run on the new bars and their alerts go to the alert history
    (newest 1000, one version per epoch).

    ``interval=None`` runs everything available and returns the table as a
    DataFrame; ``interval="2 seconds"`` starts a continuous query on that
    processing-time trigger and returns the running query."""
    from tidemark.operators.risk import SNAPSHOT_LOOKBACK, rt_frame

    if history_rows < SNAPSHOT_LOOKBACK:
        raise ValueError(f"history_rows of {history_rows}: a new bar needs the {SNAPSHOT_LOOKBACK} bars before it")
    base = base or scratch(spark, "micro-batch-scorer")
    hist_path, out_path = f"{base}/history", f"{base}/snapshots"
    bars = stream_bars(ticks, seconds, watermark).select("symbol", "ts", F.col("close").alias("price"), "volume")

    def previous_history(epoch: int):
        """Newest history version written by an earlier epoch, found by a
        directory listing (no data read), so a retried or restarted epoch
        sees the same input; versions older than that one are removed."""
        numbers = sorted(int(n.split("=", 1)[1]) for n in finished_versions(spark, hist_path, "epoch="))
        older = [e for e in numbers if e < epoch]
        if not older:
            return None
        remove_versions(spark, hist_path, [f"epoch={e}" for e in older[:-1]])  # bounded history
        return spark.read.parquet(f"{hist_path}/epoch={older[-1]}")

    def on_batch(new: DataFrame, epoch: int):
        # idempotent per epoch: outputs overwrite their own epoch partition
        new = new.persist()
        if new.isEmpty():
            new.unpersist()
            return
        prev = previous_history(epoch)
        frame = (new if prev is None else prev.unionByName(new)).persist()
        scored = rt_frame(frame).join(new.select("symbol", "ts"), ["symbol", "ts"], "left_semi")
        (scored.drop("diagnostics", "components", "bar_no").write.mode("overwrite")
         .parquet(f"{out_path}/epoch={epoch}"))
        if alerts_path:
            from tidemark.functions.series import pct_change
            from tidemark.operators.alerts import alert_rules
            from tidemark.plans.partitioning import Series

            sp = Series()
            chg = frame.withColumn("change", F.coalesce(pct_change("price", sp) * 100.0, F.lit(0.0))).select(
                "symbol", "ts", "change")
            rows = scored.select("symbol", "ts", "risk_score", "volume").join(chg, ["symbol", "ts"])
            append_alert_history(alert_rules(rows), alerts_path, version=f"e{epoch:012d}")
        w = Window.partitionBy("symbol").orderBy(F.col("ts").desc())
        keep = frame.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= history_rows).drop("_rn")
        keep.write.mode("overwrite").parquet(f"{hist_path}/epoch={epoch}")
        frame.unpersist()
        new.unpersist()

    w = bars.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{base}/_checkpoint").outputMode("append")
    if interval:
        return w.trigger(processingTime=interval).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if not finished_versions(spark, out_path, "epoch="):  # no bar was closed
        return rt_frame(spark.createDataFrame([], bars.schema)).drop("diagnostics", "components", "bar_no")
    return spark.read.parquet(out_path).drop("epoch")
