"""Per-asset parameter registry as a small broadcast dimension table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_SYMBOL = "BTC-USD"

PARAM_COLUMNS = [
    "symbol", "breakout_lookback", "breakout_threshold", "absorption_window", "momentum_window",
    "momentum_threshold", "reversal_window", "compression_window",
    "w_structure", "w_volume", "w_momentum", "w_anomaly",
    "breakout_reason", "volume_reason", "momentum_reason",
]

# The per-asset registry (windows, thresholds in %, weights,
# reason templates). Unknown symbols use the BTC-USD row.
ASSET_ROWS = [
    ("BTC-USD", 20, 0.5, 10, 5, 3.0, 3, 20, 0.40, 0.25, 0.20, 0.15,
     "Price broke the {lookback}-bar high with declining volume and reversed within {reversal} candles.",
     "Volume rose but price stalled over {window} bars, suggesting absorption.",
     "Fast {threshold}% move faded quickly, indicating exhaustion."),
    ("ETH-USD", 15, 1.0, 8, 4, 4.0, 2, 15, 0.35, 0.30, 0.20, 0.15,
     "Price broke resistance by {threshold}% without volume support and snapped back within {reversal} bars.",
     "Volume spiked {window} bars ago but price failed to follow through.",
     "Momentum peaked at {threshold}% and collapsed, showing exhaustion."),
    ("SOL-USD", 10, 2.0, 6, 3, 6.0, 2, 10, 0.30, 0.35, 0.25, 0.10,
     "Price surged {threshold}% above recent highs and reversed in {reversal} bars.",
     "Absorption signal: high volume but price compressed over {window} bars.",
     "Explosive {threshold}% move collapsed within {window} bars."),
    ("BNB-USD", 18, 0.8, 9, 4, 3.5, 2, 18, 0.38, 0.28, 0.22, 0.12,
     "Breakout above {lookback}-bar high faded in {reversal} bars with weak volume.",
     "Volume rose {window} bars ago but price stalled, indicating absorption.",
     "Momentum peaked at {threshold}% and faded quickly."),
    ("XRP-USD", 12, 1.2, 7, 3, 4.5, 2, 12, 0.33, 0.32, 0.23, 0.12,
     "Price broke {lookback}-bar resistance and reversed within {reversal} bars.",
     "Absorption over {window} bars: volume up, price flat.",
     "Fast {threshold}% move collapsed, showing exhaustion."),
]

WINDOW_PARAMS = ["breakout_lookback", "absorption_window", "momentum_window", "reversal_window", "compression_window"]


def asset_params(spark: SparkSession) -> DataFrame:
    """The registry (5 rows): a literal table, so its size is fixed."""
    schema = (
        "symbol string, breakout_lookback int, breakout_threshold double, absorption_window int, "
        "momentum_window int, momentum_threshold double, reversal_window int, compression_window int, "
        "w_structure double, w_volume double, w_momentum double, w_anomaly double, "
        "breakout_reason string, volume_reason string, momentum_reason string"
    )
    return spark.createDataFrame(ASSET_ROWS, schema)


def distinct_values(name: str) -> list:
    i = PARAM_COLUMNS.index(name)
    return sorted({r[i] for r in ASSET_ROWS})


def with_asset_params(df: DataFrame, key: str = "symbol") -> DataFrame:
    """Attach parameters by symbol; unknown symbols take the default row.

    The registry is a fixed 5-row literal, so the broadcast is size-bounded.
    """
    p = asset_params(df.sparkSession)
    cols = [c for c in PARAM_COLUMNS if c != "symbol"]
    default = dict(zip(PARAM_COLUMNS, next(r for r in ASSET_ROWS if r[0] == DEFAULT_SYMBOL)))
    known = F.broadcast(p.select(F.col("symbol").alias("_p_sym"), *[F.col(c).alias("_p_" + c) for c in cols]))
    out = df.join(known, F.col(key) == F.col("_p_sym"), "left")
    return out.select(
        *df.columns, *[F.coalesce(F.col("_p_" + c), F.lit(default[c])).alias(c) for c in cols]
    )


def supported(df: DataFrame, key: str = "symbol") -> DataFrame:
    """Semi-join to the supported symbols (broadcast of the fixed registry)."""
    p = F.broadcast(asset_params(df.sparkSession).select(F.col("symbol").alias("_s")))
    return df.join(p, F.col(key) == F.col("_s"), "left_semi")


def fill_template(tpl: Column, **values: Column) -> Column:
    """Replace ``{name}`` placeholders with the string form of the values."""
    out = tpl
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), v.cast("string"))
    return out
