"""Bar building and series aggregations (ticks -> OHLCV and friends)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, TimestampType


# fixed values of the packed order key: the step of its first column, and numbers below all times and below all longs
STEP, BELOW_TIMES, BELOW_LONGS = "20000000000000000000", "-4000000000000000000", "-9223372036854775809"


def order_key(df: DataFrame, order: tuple) -> Column:
    """One value that sorts as the ``order`` columns do, nulls first.

    A time and a whole number make a fixed-width decimal, so min_by / max_by
    keep it in a hash aggregate; a struct would force a sort aggregate. Other
    columns stay a struct."""
    types = [df.schema[c].dataType for c in order]
    if not (len(order) == 2 and isinstance(types[0], TimestampType) and isinstance(types[1], (LongType, IntegerType))):
        return F.struct(*[F.col(c) for c in order])
    wide = "decimal(20,0)"
    time = F.coalesce(F.unix_micros(order[0]).cast(wide), F.lit(BELOW_TIMES).cast(wide))
    number = F.coalesce(F.col(order[1]).cast(wide), F.lit(BELOW_LONGS).cast(wide))
    return ((time * F.lit(STEP).cast(wide)).cast("decimal(38,0)") + number).cast("decimal(38,0)")


def ohlcv_bars(ticks: DataFrame, seconds: int = 60, key: str = "symbol", ts: str = "ts",
               order: tuple = ("ts", "seq"), price: str = "price", volume: str = "volume") -> DataFrame:
    """Tumbling candles: open = first, high = max, low = min, close = last,
    volume = sum, per (key, floor(ts / seconds) * seconds).

    One hash aggregate on (key, window) with map-side partial aggregation:
    a hot symbol is reduced to one row per window per task before the shuffle.
    """
    by = order_key(ticks, order)
    return (
        ticks.groupBy(F.col(key), F.window(F.col(ts), f"{int(seconds)} seconds").alias("_w"))
        .agg(
            F.min_by(F.col(price), by).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(F.col(price), by).alias("close"),
            F.sum(volume).cast("double").alias("volume"),
        )
        .select(key, F.col("_w.start").alias("ts"), "open", "high", "low", "close", "volume")
    )


def latest_ticks(ticks: DataFrame, n: int = 500, min_ticks: int = 20, key: str = "symbol",
                 order: tuple = ("ts", "seq")) -> DataFrame:
    """Newest ``n`` ticks per key, only for keys holding at least ``min_ticks``.

    ``row_number() <= n`` becomes a WindowGroupLimit: every task keeps its own
    top n per key before the shuffle, so a hot key ships n rows per task.
    """
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    counts = ticks.groupBy(key).agg(F.count(F.lit(1)).alias("_cnt"))
    newest = ticks.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
    ok = counts.filter(F.col("_cnt") >= min_ticks).select(key)
    return newest.join(ok, key, "left_semi")


def latest_bars(ticks: DataFrame, n: int = 500, min_ticks: int = 20, seconds: int = 60) -> DataFrame:
    """Bars over the newest ``n`` ticks of each key with >= ``min_ticks``."""
    return ohlcv_bars(latest_ticks(ticks, n, min_ticks), seconds)


def resample_minute(ticks: DataFrame, seconds: int = 60, key: str = "symbol", order: tuple = ("ts", "seq"),
                    price: str = "price", delta: str = "volume_delta") -> DataFrame:
    """Resample to fixed windows: last price, sum of volume increments.

    Empty windows never materialise (the ``dropna`` of the source system).
    """
    by = order_key(ticks, order)
    return (
        ticks.groupBy(F.col(key), F.window("ts", f"{int(seconds)} seconds").alias("_w"))
        .agg(F.max_by(F.col(price), by).alias("price"), F.sum(delta).cast("double").alias("volume"))
        .select(key, F.col("_w.start").alias("ts"), "price", "volume")
    )


def feed_health(ticks: DataFrame, as_of, fresh_seconds: int = 30, key: str = "symbol") -> DataFrame:
    """Per key: buffered tick count, last-seen age in seconds, fresh flag."""
    as_of = F.lit(as_of).cast("timestamp") if not hasattr(as_of, "alias") else as_of
    agg = ticks.groupBy(key).agg(F.count(F.lit(1)).alias("ticks"), F.max("ts").alias("last_ts"))
    age = (F.unix_micros(as_of) - F.unix_micros(F.col("last_ts"))) / F.lit(1e6)
    return agg.select(key, "ticks", "last_ts", age.alias("age_seconds"), (age < fresh_seconds).alias("is_fresh"))
