"""Dashboard panels and ad-hoc queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import moment, order_key, rounded
from tickloom.operators.ordered import EVENT_ORDER
from tickloom.operators.rollups import rollup_hourly
from tickloom.plans.staging import between


def latest_price(ticks: DataFrame, benchmark: str) -> DataFrame:
    """Newest price of one benchmark; one row, by a mergeable aggregate behind a pushed filter."""
    own = ticks.where(F.col("benchmark") == benchmark)
    key = order_key(EVENT_ORDER)
    found = own.agg(F.max_by("time", key).alias("time"), F.max_by("price", key).alias("price"))
    return found.where(F.col("time").isNotNull()).select(F.lit(benchmark).alias("benchmark"), "time", "price")


def latest_ticks(ticks: DataFrame, count: int = 9) -> DataFrame:
    return ticks.orderBy(F.desc("time"), F.desc("event_id")).limit(count).select("benchmark", "price", "time")


def latest_candles(candles: DataFrame, count: int = 10) -> DataFrame:
    newest = candles.orderBy(F.desc("time"), "benchmark").limit(count)
    return newest.select("time", "benchmark", "open", "high", "low", "close", "volume", "vwap")


def recent_alerts(alerts: DataFrame, count: int = 20) -> DataFrame:
    """The newest alerts with the percent move to two places."""
    newest = alerts.orderBy(F.desc("time"), F.desc("event_id"), F.desc("rule")).limit(count)
    return newest.select(
        "time", "benchmark", "alert_type", "price", rounded(F.col("delta_pct"), 2).alias("pct"), "severity", "message"
    )


def price_history(ticks: DataFrame, start: datetime, end: datetime, benchmarks=("WTI", "BRENT", "DUBAI")) -> DataFrame:
    """Average price per 30 seconds of the shown benchmarks, all series in one pass."""
    shown = between(ticks, start, end).where(F.col("benchmark").isin(*benchmarks))
    return (
        shown.groupBy(F.window("time", "30 seconds"), "benchmark")
        .agg(F.avg("price").alias("price"))
        .select(F.col("window.start").alias("time"), "benchmark", "price")
        .orderBy("time", "benchmark")
    )


def vwap_vs_price(candles: DataFrame, benchmark: str = "WTI") -> DataFrame:
    own = candles.where(F.col("benchmark") == benchmark)
    return own.select("time", F.col("close").alias("price"), "vwap").orderBy("time")


def hourly_vwap_recent(rollup: DataFrame, as_of: datetime, hours: int = 6) -> DataFrame:
    """Hourly average prices of buckets after `as_of` - `hours`, newest first."""
    recent = rollup.where(F.col("bucket") > moment(rollup, "bucket", as_of - timedelta(hours=hours)))
    return recent.select("bucket", "benchmark", "vwap", "volume").orderBy(F.desc("bucket"), "benchmark")


def hourly_vwap_of_ticks(ticks: DataFrame, as_of: datetime, hours: int = 6) -> DataFrame:
    """The same without a stored rollup; only the ticks of the shown buckets are read."""
    late = ticks.where(F.col("time") > moment(ticks, "time", as_of - timedelta(hours=hours)))
    return hourly_vwap_recent(rollup_hourly(late), as_of, hours)


def minute_summary(ticks: DataFrame, as_of: datetime, hours: int = 1) -> DataFrame:
    """Average price and volume per minute and benchmark after `as_of` - `hours`."""
    recent = ticks.where(F.col("time") > moment(ticks, "time", as_of - timedelta(hours=hours)))
    return (
        recent.groupBy(F.window("time", "1 minute"), "benchmark")
        .agg(F.avg("price").alias("avg_price"), F.sum("volume").alias("total_volume"))
        .select(F.col("window.start").alias("minute"), "benchmark", "avg_price", "total_volume")
        .orderBy(F.desc("minute"), "benchmark")
    )


def tick_count(ticks: DataFrame) -> DataFrame:
    return ticks.agg(F.count("*").alias("count"))
