"""The staging view and the filters on ticks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import moment, region_of, truncated

STAGED_DAYS = 30


def last_days(ticks: DataFrame, as_of: datetime, days: int = STAGED_DAYS, time: str = "time") -> DataFrame:
    """Rows of the last `days` days; the bound is a literal, so it reaches the scan."""
    return ticks.where(F.col(time) >= moment(ticks, time, as_of - timedelta(days=days)))


def between(df: DataFrame, start: datetime, end: datetime, time: str = "time") -> DataFrame:
    """Rows of a dashboard's time range, both ends included."""
    return df.where(F.col(time).between(moment(df, time, start), moment(df, time, end)))


def stg_ticks(ticks: DataFrame, as_of: datetime, days: int = STAGED_DAYS) -> DataFrame:
    """Typed ticks of the last days with quote spread, region and hour and day buckets."""
    recent = last_days(ticks, as_of, days)
    numbers = [F.col(c).cast("double").alias(c) for c in ("price", "volume", "bid", "ask")]
    return recent.select(
        "event_id", F.col("time").alias("tick_time"), "benchmark", "exchange", *numbers,
        (F.col("ask") - F.col("bid")).alias("spread"),
        region_of().alias("region"),
        "source",
        truncated(recent, "time", "hour").alias("hour_bucket"),
        truncated(recent, "time", "day").alias("day_bucket"),
    )
