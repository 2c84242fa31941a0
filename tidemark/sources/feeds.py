"""Record normalisers for raw market feeds (batch or streaming frames).

Each takes a frame with a raw text column and returns canonical rows. JSON
is parsed JVM-side (``json_tuple`` / ``from_json``); numbers arrive as
strings and go through ``try_cast`` so a bad number becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.params import ASSET_ROWS

TICK_FIELDS = ["e", "E", "s", "c", "h", "l", "v", "q"]


def exchange_symbol(canonical: Column) -> Column:
    """BTC-USD -> BTCUSDT."""
    return F.regexp_replace(F.upper(canonical), "-USD$", "USDT")


def canonical_symbol(raw: Column) -> Column:
    """btcusdt / BTCUSDT / BTC-USD -> BTC-USD."""
    u = F.upper(F.trim(raw))
    return F.when(u.contains("-"), u).otherwise(F.regexp_replace(u, "USDT$", "-USD"))


def normalize_symbols(df: DataFrame, raw: str = "raw") -> DataFrame:
    c = canonical_symbol(F.col(raw))
    return df.select(raw, c.alias("canonical"), exchange_symbol(c).alias("exchange"), F.lower(exchange_symbol(c)).alias("stream"))


def stream_symbols(spark: SparkSession) -> DataFrame:
    """Lower-case exchange symbols of the registry (fixed 5 rows)."""
    return spark.createDataFrame([(r[0],) for r in ASSET_ROWS], "canonical string").select(
        F.lower(exchange_symbol(F.col("canonical"))).alias("symbol"))


def normalize_ticker_json(raw: DataFrame, value: str = "value") -> DataFrame:
    """Exchange ticker events, bare or wrapped as ``{"stream", "data"}``.

    Keeps ``@ticker`` streams and bare ``24hrTicker`` events of supported
    symbols; symbol lower-cased; ``E`` (ms) becomes the event time.
    """
    keep = [c for c in raw.columns if c != value]
    # field names differ only by case ("e" / "E"): alias by position
    top = raw.select(*keep, F.json_tuple(value, "stream", "data", *TICK_FIELDS).alias(
        "stream", "data", *[f"t_{i}" for i in range(len(TICK_FIELDS))]))
    inner = top.select("*", F.json_tuple("data", *TICK_FIELDS).alias(*[f"d_{i}" for i in range(len(TICK_FIELDS))]))
    g = {f: F.when(F.col("data").isNotNull(), F.col(f"d_{i}")).otherwise(F.col(f"t_{i}")) for i, f in enumerate(TICK_FIELDS)}
    wrapped_ok = F.col("stream").contains("@ticker") & F.col("data").isNotNull()
    bare_ok = F.col("stream").isNull() & (F.col("t_0") == "24hrTicker")
    out = inner.filter(wrapped_ok | bare_ok).select(
        *keep,
        F.lower(g["s"]).alias("symbol"),
        F.timestamp_millis(g["E"].try_cast("long")).alias("ts"),
        g["c"].try_cast("double").alias("price"),
        g["h"].try_cast("double").alias("high"),
        g["l"].try_cast("double").alias("low"),
        g["v"].try_cast("double").alias("volume"),
        g["q"].try_cast("double").alias("quote_volume"),
    )
    return out.join(F.broadcast(stream_symbols(raw.sparkSession)), "symbol", "left_semi")


def normalize_trade_json(raw: DataFrame, value: str = "value", arrival: str = "arrival_ts") -> DataFrame:
    """Index-feed trades: keep TYPE "5" with a non-empty FROMSYMBOL; a
    missing or bad price / volume reads as 0; time is the arrival time."""
    keep = [c for c in raw.columns if c not in (value,)]
    t = raw.select(*keep, F.json_tuple(value, "TYPE", "FROMSYMBOL", "PRICE", "VOLUME").alias("type", "sym", "p", "v"))
    return t.filter((F.col("type") == "5") & (F.coalesce(F.length("sym"), F.lit(0)) > 0)).select(
        *[c for c in keep if c != arrival], F.col(arrival).alias("ts"), F.col("sym").alias("symbol"),
        F.coalesce(F.col("p").try_cast("double"), F.lit(0.0)).alias("price"),
        F.coalesce(F.col("v").try_cast("double"), F.lit(0.0)).alias("volume"),
    )


def normalize_klines(raw: DataFrame, value: str = "value") -> DataFrame:
    """12-field positional kline arrays (ms open time first) -> bars."""
    keep = [c for c in raw.columns if c != value]
    rows = raw.select(*keep, F.explode(F.from_json(value, "array<array<string>>")).alias("k"))
    num = lambda i: F.try_element_at("k", F.lit(i)).try_cast("double")
    return rows.select(
        *keep, F.timestamp_millis(F.try_element_at("k", F.lit(1)).try_cast("long")).alias("ts"),
        num(2).alias("open"), num(3).alias("high"), num(4).alias("low"), num(5).alias("close"), num(6).alias("volume"),
    ).withColumn("price", F.col("close"))


def daily_dialect(df: DataFrame, symbol) -> DataFrame:
    """Date/Open/High/Low/Close/Volume dialect -> canonical daily rows
    (timestamp, symbol, price = Close, volume = Volume, Open..Close)."""
    sym = F.col(symbol) if isinstance(symbol, str) and symbol in df.columns else F.lit(symbol)
    return df.select(F.col("Date").cast("timestamp").alias("timestamp"), sym.alias("symbol"), F.col("Close").alias("price"),
                     F.col("Volume").alias("volume"), "Open", "High", "Low", "Close")


def coerce_types(df: DataFrame, timestamps: list[str], numbers: list[str]) -> DataFrame:
    """Text columns -> timestamp / double; unparsable values become NULL."""
    sel = []
    for c in df.columns:
        if c in timestamps:
            sel.append(F.try_to_timestamp(F.col(c)).alias(c))
        elif c in numbers:
            sel.append(F.col(c).try_cast("double").alias(c))
        else:
            sel.append(F.col(c))
    return df.select(*sel)


def order_book_ladder(book: DataFrame, levels: int = 10) -> DataFrame:
    """Book of bids / asks arrays of (price, qty) -> one row per level and
    side; asks reversed for display; fill bar = min(100, int(qty * 40))."""
    keep = [c for c in book.columns if c not in ("bids", "asks")]
    bids = book.select(*keep, F.lit("bid").alias("side"), F.posexplode(F.slice("bids", 1, levels)).alias("pos", "lv"))
    asks = book.select(*keep, F.lit("ask").alias("side"), F.posexplode(F.reverse(F.slice("asks", 1, levels))).alias("pos", "lv"))
    out = bids.unionByName(asks)
    return out.select(*keep, "side", (F.col("pos") + 1).alias("level"), F.col("lv.price").alias("price"),
                      F.col("lv.qty").alias("qty"), F.least(F.lit(100), (F.col("lv.qty") * 40.0).cast("int")).alias("fill"))


BAR_FILE_SCHEMA = "symbol string, ts timestamp, open double, high double, low double, close double, volume double"


def read_bars(spark: SparkSession, path: str, fmt: str = "csv", schema: str = BAR_FILE_SCHEMA, header: bool = True) -> DataFrame:
    """Bar file with an explicit schema (no inference pass over the data)."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        r = r.option("header", header)
    return r.format(fmt).load(path)
