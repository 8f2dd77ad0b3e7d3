"""Hourly and daily rollups and their incremental refresh."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions.columns import moment, present
from tickloom.operators.candles import ohlcv
from tickloom.session import lookup

HOUR, DAY = timedelta(hours=1), timedelta(days=1)
# How far back and how near a refresh reaches.
HOURLY_REFRESH = (timedelta(hours=3), timedelta(minutes=1))
DAILY_REFRESH = (timedelta(days=3), timedelta(hours=1))
_EPOCH = datetime(1970, 1, 1)


def _rollup(ticks: DataFrame, interval: str, *extra) -> DataFrame:
    rows = ticks.groupBy(F.window("time", interval), "benchmark").agg(*ohlcv(), *extra)
    return rows.withColumns(
        {"bucket": F.col("window.start"), "vwap": F.try_divide("pv", present(F.col("volume")))}
    )


def rollup_hourly(ticks: DataFrame) -> DataFrame:
    """Hourly candles with average price; an hour without volume has none."""
    return _rollup(ticks, "1 hour").select(
        "bucket", "benchmark", "open", "high", "low", "close", "volume", "vwap", "tick_count"
    )


def rollup_daily(ticks: DataFrame) -> DataFrame:
    """Daily candles with average price and sample deviation of the price."""
    return _rollup(ticks, "1 day", F.stddev_samp("price").alias("daily_volatility")).select(
        "bucket", "benchmark", "open", "high", "low", "close", "volume", "vwap", "daily_volatility", "tick_count"
    )


def write_rollup(rollup: DataFrame, path: str) -> None:
    """Store a rollup by date of its buckets, replacing only the dates it holds."""
    dated = rollup.withColumn("date", F.to_date("bucket"))
    (
        dated.repartition("date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def whole_buckets(as_of: datetime, reach: tuple[timedelta, timedelta], width: timedelta) -> tuple[datetime, datetime]:
    """First and end moment of the buckets that lie wholly in [as_of - start, as_of - end]."""
    start, end = as_of - reach[0] - _EPOCH, as_of - reach[1] - _EPOCH
    return _EPOCH + -(-start // width) * width, _EPOCH + (end // width) * width


def read_rollup(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields]).add("date", "date")).parquet(path)


def refresh_rollup(
    ticks: DataFrame, path: str, as_of: datetime, rollup=rollup_hourly, reach=HOURLY_REFRESH, width: timedelta = HOUR
) -> None:
    """Recompute the buckets in reach of `as_of` and keep all others.

    Only the dates the reach touches are read and rewritten, and only their ticks are scanned. A date
    that is left without buckets loses its stored rows.
    """
    low, high = whole_buckets(as_of, reach, width)
    if low >= high:
        return
    fresh = rollup(ticks.where((F.col("time") >= moment(ticks, "time", low)) & (F.col("time") < moment(ticks, "time", high))))
    try:
        stored = read_rollup(ticks.sparkSession, path, fresh.schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        write_rollup(fresh, path)  # the first refresh builds the table
        return
    touched = F.col("date").between(F.lit(low.date()), F.lit((high - timedelta(microseconds=1)).date()))
    outside = (F.col("bucket") < moment(stored, "bucket", low)) | (F.col("bucket") >= moment(stored, "bucket", high))
    # a few buckets per benchmark, used twice
    now = lookup(stored.where(touched & outside).drop("date").unionByName(fresh))
    emptied = stored.where(touched).select("date").distinct().join(
        now.select(F.to_date("bucket").alias("date")).distinct(), "date", "left_anti"
    )
    gone = [row["date"] for row in emptied.collect()]  # dates in reach
    write_rollup(now, path)
    for day in gone:
        now.limit(0).write.mode("overwrite").parquet(f"{path.rstrip('/')}/date={day}")
