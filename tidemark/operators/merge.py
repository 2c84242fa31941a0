"""Set operations, top-k and source precedence over per-symbol series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.partitioning import over_series


def tail_n(df: DataFrame, n: int, key: str = "symbol", ts: str = "ts") -> DataFrame:
    """Newest ``n`` rows per key (per-task group limit before the shuffle)."""
    w = Window.partitionBy(key).orderBy(F.col(ts).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def merge_precedence(history: DataFrame, live: DataFrame, n: int | None = 180, key: str = "symbol",
                     ts: str = "ts") -> DataFrame:
    """Union history (rank 0) and live (rank 1); per (key, ts) keep the
    highest rank; then the newest ``n`` rows per key."""
    u = history.withColumn("_rank", F.lit(0)).unionByName(live.withColumn("_rank", F.lit(1)))
    w = Window.partitionBy(key, ts).orderBy(F.col("_rank").desc())
    best = u.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    best = best.withColumn("source", F.when(F.col("_rank") == 1, "live").otherwise("history")).drop("_rank")
    return tail_n(best, n, key, ts) if n else best


def source_fallback(live: DataFrame, history: DataFrame, key: str = "symbol") -> DataFrame:
    """Per key: live rows when the key has any, else history; ``data_mode``
    records which. Non-live rows must not drive alert state."""
    have_live = live.select(key).distinct()
    return live.withColumn("data_mode", F.lit("live")).unionByName(
        history.join(have_live, key, "left_anti").withColumn("data_mode", F.lit("historical")))


def split_by_time(df: DataFrame, fraction: float = 0.2, key: str = "symbol", ts: str = "ts") -> DataFrame:
    """First floor(n * (1 - fraction)) rows of each key (by time) are
    ``train``, the rest ``validation``."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    idx = over_series(df, lambda d, s: d, halo=0, key=key, order=(ts,), keep_index="_i")
    cut = F.floor(F.col("_n") * F.lit(1.0 - fraction))
    return idx.join(n, key).withColumn("split", F.when(F.col("_i") <= cut, "train").otherwise("validation")).drop("_n", "_i")
