"""Aggregations and summaries over scored series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import band_model
from tidemark.plans.partitioning import Series, over_series


def centered_band(df: DataFrame, value: str, max_window: int = 20, k: float = 1.5, key: str = "symbol",
                  ts: str = "ts") -> DataFrame:
    """Centered rolling mean / std band, window w = min(max_window, max(1, n // 2))
    per key (n = the key's row count); significant = |x - mean| > k * std.

    One frame of the widest window is gathered a row (at most ``max_window``
    values) and the key's own window is cut out of it, so a row costs one
    frame, not one for each width. The deviation is taken from the mean of the
    values less the first of them, so a constant series gives exactly 0.
    """
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    base = df.join(n, key).withColumn("_w", F.least(F.lit(max_window), F.greatest(F.lit(1), F.floor(F.col("_n") / 2))).cast("int"))
    left, right = max(max_window // 2, 1), max((max_window - 1) // 2, 1)

    def build(d, s: Series):
        near = F.collect_list(F.struct(F.col(value).cast("double").alias("x"))).over(s.rows(-left, right))
        place = F.least(s.position(), F.lit(left + 1)).cast("int")  # of the row in its frame, from 1
        return d.withColumn("_near", near).withColumn("_at", place)

    out = over_series(base, build, halo=left, lookahead=right, key=key, order=(ts,))
    single = F.col("_n") <= F.col("_w")
    before = F.when(single, 1).otherwise(F.floor(F.col("_w") / 2)).cast("int")
    after = F.when(single, 1).otherwise(F.floor((F.col("_w") - 1) / 2)).cast("int")
    first = F.greatest(F.col("_at") - before, F.lit(1))
    own = F.slice("_near", first, F.col("_at") + after - first + 1)
    out = out.withColumn("_own", F.transform(F.filter(own, lambda v: v["x"].isNotNull()), lambda v: v["x"])).withColumn("_many", F.size("_own"))
    base_value = F.get("_own", F.lit(0))
    shift = F.aggregate("_own", F.lit(0.0), lambda s, v: s + (v - base_value)) / F.col("_many")
    out = out.withColumn("_shift", F.when(F.col("_many") > 0, shift))
    spread = F.aggregate("_own", F.lit(0.0), lambda s, v: s + (v - base_value - F.col("_shift")) * (v - base_value - F.col("_shift")))
    out = out.withColumn("band_mean", base_value + F.col("_shift")).withColumn(
        "band_std", F.when(single, F.lit(0.0)).when(F.col("_many") > 1, F.sqrt(spread / (F.col("_many") - 1))))
    x, m, sd = F.col(value), F.col("band_mean"), F.col("band_std")
    return out.select(
        key, ts, value, "band_mean", "band_std",
        (m + k * sd).alias("band_upper"), (m - k * sd).alias("band_lower"),
        F.coalesce(F.abs(x - m) > k * sd, F.lit(False)).alias("significant"),
    )


def risk_distribution(df: DataFrame, pct: str) -> DataFrame:
    """Rows per model risk band (NULL band for exact 0 kept as its own row)."""
    return df.groupBy(band_model(pct).alias("risk_level")).agg(F.count(F.lit(1)).alias("n"))


def score_summary(df: DataFrame, score: str, pct: str | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.min(score).alias("min_score"),
            F.max(score).alias("max_score")]
    if pct:
        aggs.append(F.avg(pct).alias("mean_risk_pct"))
    return df.agg(*aggs)


def validation_metrics(df: DataFrame, pct: str, anomaly_pct: float = 90.0, high_pct: float = 80.0) -> DataFrame:
    """n, anomaly rate, mean, population std and high-risk count on risk %."""
    x = F.col(pct)
    return df.agg(
        F.count(F.lit(1)).alias("validation_samples"),
        F.avg((x > anomaly_pct).cast("double")).alias("anomaly_rate"),
        F.avg(x).alias("mean_score"),
        F.stddev_pop(x).alias("std_score"),
        F.count_if(x > high_pct).alias("high_risk_count"),
    )


def backtest_buckets(df: DataFrame, pct: str) -> DataFrame:
    x = F.col(pct)
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(x > 80).alias("high_risk_periods"),
        F.count_if((x > 40) & (x <= 80)).alias("medium_risk_periods"),
        F.count_if(x <= 40).alias("low_risk_periods"),
        F.avg(x).alias("mean_risk_score"),
        F.max(x).alias("max_risk_score"),
    )


def scaler_fit(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per feature: mean and population std (a zero std scales by 1).
    One row per feature (stack), one pass, partial aggregation."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    wide = df.agg(*aggs)
    stacked = F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"), F.col(f"m_{c}").alias("mean"),
                 F.when(F.col(f"s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"s_{c}")).alias("scale"))
        for i, c in enumerate(cols)
    ]))
    return wide.select(stacked)


def volume_cap(df: DataFrame, q: float = 0.95, key: str = "symbol", volume: str = "volume") -> DataFrame:
    cap = exact_quantile(df, q, key, volume, out="volume_cap")
    return df.join(cap, key, "left").withColumn("volume_plot", F.least(F.col(volume), F.col("volume_cap")))


def label_count(df: DataFrame) -> DataFrame:
    return df.agg(F.sum("label").cast("long").alias("positives"), F.count(F.lit(1)).alias("rows"))


def value_col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exact_quantile(df: DataFrame, q: float, key: str = "symbol", value: str = "volume", accuracy: int = 100_000,
                   out: str = "quantile") -> DataFrame:
    """Exact per-key quantile with linear interpolation (pandas default),
    without gathering a large key's values into one task.

    A GK sketch (``percentile_approx``, rank error <= n / accuracy) cuts each
    key's values into three cells around the target ranks. Exact cell counts
    tell which cell holds a rank, and only the distinct values of those cells
    are ranked: about 6 n / accuracy rows for a large key, as its ranks lie in
    the middle cell. A rank in an outer cell (short series, where the cuts
    fall on single values) is found in the same way.
    """
    from pyspark.sql import Window

    eps = 1.0 / accuracy
    v = F.col(value).cast("double")
    base = df.select(F.col(key), v.alias("_v")).filter(F.col("_v").isNotNull())
    st = base.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", [max(0.0, q - 3 * eps), min(1.0, q + 3 * eps)], accuracy).alias("_cut"),
    )
    cell = F.when(F.col("_v") < F.col("_cut")[0], 0).when(F.col("_v") <= F.col("_cut")[1], 1).otherwise(2)
    celled = base.join(st.select(key, "_cut"), key).select(key, "_v", cell.alias("_cell"))
    before = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = celled.groupBy(key, "_cell").agg(F.count(F.lit(1)).alias("_size"))
    cells = cells.withColumn("_off", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    pos = (F.col("_n") - 1) * F.lit(float(q))
    ranks = st.select(key, (pos - F.floor(pos)).alias("_frac"),
                      F.explode(F.array_distinct(F.array(F.floor(pos), F.ceil(pos)))).alias("_rank"))
    want = ranks.join(cells, key).filter((F.col("_rank") >= F.col("_off")) & (F.col("_rank") < F.col("_off") + F.col("_size")))
    # equal values are one row each before anything is ranked
    held = celled.join(want.select(key, "_cell").distinct(), [key, "_cell"], "left_semi")
    values = held.groupBy(key, "_cell", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(key, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("_end", F.sum("_c").over(upto))
    inside = F.col("_rank") - F.col("_off")
    hit = want.join(values, [key, "_cell"]).filter((inside < F.col("_end")) & (inside >= F.col("_end") - F.col("_c")))
    # the two ranks are neighbours: the smaller value belongs to the lower rank
    ends = hit.groupBy(key).agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"), F.max("_frac").alias("_frac"))
    return ends.select(key, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_frac")).alias(out))
