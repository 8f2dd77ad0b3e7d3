"""Candles: open, high, low, close and volume per benchmark and interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import order_key, present, rounded, truncated
from tickloom.operators.ordered import (
    CHUNK,
    EVENT_ORDER,
    HALO,
    running,
    scan,
    with_chunk,
    with_halo,
)
from tickloom.session import lookup

KEY = ["benchmark"]
ATR_CANDLES = 14


def ohlc(order_by: Sequence[str] = EVENT_ORDER) -> list[Column]:
    """First, highest, lowest and last price; mergeable, so Spark aggregates before the shuffle."""
    key = order_key(order_by)
    return [
        F.min_by("price", key).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", key).alias("close"),
    ]


def ohlcv(order_by: Sequence[str] = EVENT_ORDER) -> list[Column]:
    traded = F.sum(F.col("price") * F.col("volume")).alias("pv")
    return [*ohlc(order_by), F.sum("volume").alias("volume"), traded, F.count("*").alias("tick_count")]


def calendar_chunk(df: DataFrame, time: str = "time") -> DataFrame:
    """Days as chunks: a day has at most 1,440 minute candles per benchmark."""
    return df.withColumn(CHUNK, F.unix_date(F.to_date(time)).cast("long"))


def with_candle_minute(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Add the minute of the candle a tick falls into.

    In event order that is the tick's own minute. In arrival order a late tick joins the candle
    that is open, so it is the latest minute seen so far.
    """
    minute = truncated(ticks, "time", "minute")
    if order_by[0] == "time":
        return ticks.withColumn("candle", minute)
    return running(with_chunk(ticks, order_by), KEY, order_by, maxes={"candle": minute})


def open_candles(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """All minute candles with their sums, the last one of each benchmark included."""
    candles = with_candle_minute(ticks, order_by).groupBy("benchmark", "candle").agg(*ohlcv(order_by))
    return candles.withColumnRenamed("candle", "time")


def close_candles(candles: DataFrame, include_open: bool = False) -> DataFrame:
    """Keep the candles that a later one closed and set their average price.

    Without volume the average is the price of the tick that closed the candle, which opens the
    next one. The last candle of a benchmark is still open and only kept on request.
    """
    # the ticks are aggregated once; what is looked at twice are the few candles
    day = calendar_chunk(lookup(candles))
    order = ["time"]
    haloed = with_halo(day, KEY, order, 1, ["open"], reverse=True)
    following = F.lag("open").over(scan(KEY, order, reverse=True))
    closed = haloed.withColumn("_next", following).where(~F.col(HALO)).drop(HALO, CHUNK)
    if not include_open:
        closed = closed.where(F.col("_next").isNotNull())
    vwap = F.coalesce(F.try_divide("pv", present(F.col("volume"))), F.col("_next"))
    return closed.select(
        "time", "benchmark", "open", "high", "low", "close", "volume", vwap.alias("vwap"),
        F.col("tick_count").cast("int").alias("tick_count"),
    )


def candles_1m(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER, include_open: bool = False) -> DataFrame:
    """Minute candles as a feed closes them: empty minutes give none, late ticks fold forward."""
    return close_candles(open_candles(ticks, order_by), include_open)


def windowed_ohlcv(ticks: DataFrame, interval: str) -> DataFrame:
    """Event-time candles with sums; runs on tables and, behind a watermark, on streams."""
    return ticks.groupBy(F.window("time", interval), "benchmark").agg(*ohlcv())


def candles_5m(ticks: DataFrame, interval: str = "5 minutes") -> DataFrame:
    """Five-minute candles; without volume the average price is the close."""
    vwap = F.when(F.col("volume") > 0, F.try_divide("pv", present(F.col("volume")))).otherwise(F.col("close"))
    return windowed_ohlcv(ticks, interval).select(
        "benchmark",
        F.unix_millis(F.col("window.start").cast("timestamp")).alias("window_start"),
        F.unix_millis(F.col("window.end").cast("timestamp")).alias("window_end"),
        "open", "high", "low", "close", "volume", rounded(vwap, 4).alias("vwap"), "tick_count",
    )


def five_minute_messages(candles: DataFrame) -> DataFrame:
    """Five-minute candles as JSON messages without a key."""
    return candles.select(F.to_json(F.struct(*candles.columns), {"ignoreNullFields": "false"}).alias("value"))


def candlestick(ticks: DataFrame, interval: str = "1 minute") -> DataFrame:
    """Open, high, low and close per event-time interval and benchmark; the last bucket is kept."""
    rows = ticks.groupBy(F.window("time", interval), "benchmark").agg(*ohlc())
    return rows.select(F.col("window.start").alias("time"), "benchmark", "open", "high", "low", "close")


def atr(candles: DataFrame, length: int = ATR_CANDLES) -> DataFrame:
    """Average true range: the mean over the last `length` candles, null before there are as many."""
    order = ["time"]
    spec = scan(KEY, order)
    haloed = with_halo(calendar_chunk(lookup(candles)), KEY, order, length, ["high", "low", "close"])
    previous = F.col("_prev_close")
    true_range = F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - previous), F.abs(F.col("low") - previous)
    )
    frame = spec.rowsBetween(1 - length, 0)
    full = F.count("_range").over(frame) == length
    return (
        haloed.withColumn("_prev_close", F.lag("close").over(spec))
        .withColumn("_range", true_range)
        .withColumn("atr_14", F.when(full, F.avg("_range").over(frame)))
        .where(~F.col(HALO))
        .select("time", "benchmark", "atr_14")
    )
