"""Canonical market views over the driver tables (see FIXTURES.md).

``events`` becomes a tick stream of five symbols; ``lineitem`` and
``orders`` become long daily bar series. Parquet timestamps arrive as
``timestamp_ntz``; they are cast to ``timestamp`` (session zone UTC) so the
same views feed watermarks in streaming jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import ohlcv_bars

# Event type -> symbol mapping of the test fixture.
EVENT_SYMBOLS = {
    "click": "BTC-USD",
    "view": "ETH-USD",
    "purchase": "SOL-USD",
    "signup": "BNB-USD",
}
OTHER_SYMBOL = "XRP-USD"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_to_ticks(ev: DataFrame) -> DataFrame:
    sym = F.lit(OTHER_SYMBOL)
    for et, s in reversed(list(EVENT_SYMBOLS.items())):
        sym = F.when(F.col("event_type") == et, F.lit(s)).otherwise(sym)
    return ev.select(
        sym.alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("volume"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, ts, seq, price, volume."""
    return events_to_ticks(table(spark, sf_dir, "events"))


def bars_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlcv_bars(ticks(spark, sf_dir), 3600)


def bars_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlcv_bars(ticks(spark, sf_dir), 86400)


def frame_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-hour bars as a (symbol, ts, price, volume) frame."""
    return bars_1h(spark, sf_dir).select("symbol", "ts", F.col("close").alias("price"), "volume")


LI_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def bars_daily_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars from lineitem: symbol = returnflag, price = extprice / qty."""
    li = table(spark, sf_dir, "lineitem")
    t = li.select(
        F.col("l_returnflag").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("volume"),
        *LI_ORDER,
    )
    by = F.struct(*[F.col(c) for c in LI_ORDER])
    return t.groupBy("symbol", "ts").agg(
        F.min_by("price", by).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", by).alias("close"),
        F.sum("volume").cast("double").alias("volume"),
    )


def bars_daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars from orders: symbol = priority, price = totalprice."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").cast("timestamp").alias("ts")).agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    )


def history_live(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping sources: history = even days, live = odd days, plus
    every 7th hour in both, where live carries price + 1."""
    b = frame_1h(spark, sf_dir)
    day = F.dayofmonth("ts")
    seventh = (F.hour("ts") % 7) == 0
    hist = b.filter((day % 2 == 0) | seventh)
    live = b.filter((day % 2 == 1) | seventh).withColumn(
        "price", F.when(seventh, F.col("price") + 1).otherwise(F.col("price"))
    )
    return hist, live


def cumulative_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks whose volume is a running 24h-style total per symbol and day."""
    from tidemark.plans.partitioning import segment_totals

    return segment_totals(ticks(spark, sf_dir), ["symbol", F.to_date("ts")], ("ts", "seq"), F.coalesce("volume", F.lit(0.0)), "volume", 60)


# ---------------------------------------------------------- raw feed text
def raw_ticker_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker JSON built from ticks: even seq wrapped, odd seq bare; every
    11th wrapped one is a trade stream, every 13th price is bad text and
    every 17th symbol is not supported."""
    t = ticks(spark, sf_dir)
    seq = F.col("seq")
    sym = F.when(seq % 17 == 0, F.lit("DOGEUSDT")).otherwise(F.regexp_replace("symbol", "-USD$", "USDT"))
    data = F.struct(
        F.lit("24hrTicker").alias("e"), F.unix_millis("ts").alias("E"), sym.alias("s"),
        F.when(seq % 13 == 0, F.lit("n/a")).otherwise(F.col("price").cast("string")).alias("c"),
        (F.col("price") * 1.01).cast("string").alias("h"), (F.col("price") * 0.99).cast("string").alias("l"),
        F.col("volume").cast("string").alias("v"), (F.col("price") * F.col("volume")).cast("string").alias("q"),
    )
    stream = F.concat(F.lower(sym), F.when(seq % 11 == 0, F.lit("@trade")).otherwise(F.lit("@ticker")))
    value = F.when(seq % 2 == 0, F.to_json(F.struct(stream.alias("stream"), data.alias("data")))).otherwise(F.to_json(data))
    return t.select("seq", value.alias("value"))


def raw_trade_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir)
    seq = F.col("seq")
    msg = F.to_json(F.struct(
        F.when(seq % 7 == 0, F.lit("999")).otherwise(F.lit("5")).alias("TYPE"),
        F.when(seq % 19 == 0, F.lit("")).otherwise(F.split("symbol", "-").getItem(0)).alias("FROMSYMBOL"),
        F.when(seq % 23 != 0, F.col("price")).alias("PRICE"),
        F.col("volume").alias("VOLUME"),
    ))
    return t.select("seq", F.col("ts").alias("arrival_ts"), msg.alias("value"))


def raw_kline_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON array of 1-hour klines per symbol and day (24 entries)."""
    b = bars_1h(spark, sf_dir)
    ms = F.unix_millis("ts")
    k = F.array(
        ms.cast("string"), F.col("open").cast("string"), F.col("high").cast("string"), F.col("low").cast("string"),
        F.col("close").cast("string"),
        F.when(F.hour("ts") == 5, F.lit("bad")).otherwise(F.col("volume").cast("string")),
        (ms + 3599999).cast("string"), F.lit("0"), F.lit("0"), F.lit("0"), F.lit("0"), F.lit("0"),
    )
    return b.groupBy("symbol", F.to_date("ts").alias("day")).agg(F.to_json(F.collect_list(k)).alias("value"))


def order_book(spark: SparkSession, sf_dir: str, depth: int = 10) -> DataFrame:
    """Per symbol and hour: bids = the ``depth`` highest ticks, asks = the
    ``depth`` lowest, each as an array of (price, qty = volume / 100)."""
    from pyspark.sql import Window

    t = ticks(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts")).withColumn("qty", F.col("volume") / 100.0)
    hi = Window.partitionBy("symbol", "ts").orderBy(F.col("price").desc(), "seq")
    lo = Window.partitionBy("symbol", "ts").orderBy(F.col("price").asc(), "seq")
    side = lambda w, n: (t.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= depth)
                         .groupBy("symbol", "ts").agg(F.array_sort(F.collect_list(F.struct("_r", "price", "qty"))).alias("_l"))
                         .select("symbol", "ts", F.transform("_l", lambda x: F.struct(x["price"].alias("price"), x["qty"].alias("qty"))).alias(n)))
    return side(hi, "bids").join(side(lo, "asks"), ["symbol", "ts"])


def raw_lineitem_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipdate"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")).alias("quantity"),
        F.col("l_extendedprice").cast("string").alias("extendedprice"),
    )
