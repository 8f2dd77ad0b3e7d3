"""The `events` table seen as price ticks (FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.columns import micros
from tickloom.operators.quotes import derive_quotes

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
BASE_MICROS = 1_704_067_200_000_000  # 2024-01-01
SQUEEZE = 60


def _benchmark() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "click", "WTI")
        .when(kind == "view", "BRENT")
        .when(kind == "purchase", "DUBAI")
        .when(kind == "signup", "URALS")
        .when(kind == "error", "OPEC_BASKET")
    )


def _exchange() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "click", "NYMEX").when(kind == "view", "ICE").when(kind == "purchase", "ADNOC").otherwise("OTHER")
    )


def _price() -> Column:
    """78 + value / 40 rounded half up to three places, in whole numbers so that no tie is lost."""
    cents = F.floor(F.col("value") * 100 + 0.5)
    return (F.lit(78_000) + F.floor((cents + 2) / 4)) / F.lit(1000.0)


def _volume() -> Column:
    """The number in `{"k": 69}`; the text has this one shape, so it is cut rather than parsed."""
    return F.substring_index(F.substring_index("props", ":", -1), "}", 1).cast("double")


def _squeezed() -> Column:
    """Time compressed sixty-fold towards the base, in whole microseconds."""
    return F.timestamp_micros(F.expr(f"{BASE_MICROS} + (unix_micros(cast(ts as timestamp)) - {BASE_MICROS}) div {SQUEEZE}"))


def _as_ticks(events: DataFrame, time: Column, price: Column) -> DataFrame:
    base = events.select(
        "event_id",
        time.cast(events.schema["ts"].dataType).alias("time"),
        _benchmark().alias("benchmark"),
        _exchange().alias("exchange"),
        price.alias("price"),
        _volume().alias("volume"),
    )
    quoted = derive_quotes(base)
    gap = F.col("event_id") % 10 == 0
    return quoted.select(
        *base.columns,
        F.when(~gap, F.col("bid")).alias("bid"),
        F.when(~gap, F.col("ask")).alias("ask"),
        F.lit("replay").alias("source"),
    )


def read_events(spark: SparkSession, sf_dir: str, streamed: bool = False) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    if not streamed:
        return spark.read.parquet(path)
    # a stream wants a folder or a pattern; this one fits the single file and a folder of files
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")


def ticks(spark: SparkSession, sf_dir: str, streamed: bool = False) -> DataFrame:
    return _as_ticks(read_events(spark, sf_dir, streamed), F.col("ts"), _price())


def ticks_dense(spark: SparkSession, sf_dir: str, streamed: bool = False) -> DataFrame:
    return _as_ticks(read_events(spark, sf_dir, streamed), _squeezed(), _price())


def ticks_raw_price(spark: SparkSession, sf_dir: str, streamed: bool = False) -> DataFrame:
    return _as_ticks(read_events(spark, sf_dir, streamed), F.col("ts"), F.col("value"))


def ticks_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_ticks(read_events(spark, sf_dir), F.date_trunc("minute", _squeezed()), _price())


def with_arrival(dense: DataFrame) -> DataFrame:
    """Add the arrival position of a jittered feed: up to 19 seconds late."""
    return dense.withColumn("arrival_us", micros("time") + (F.col("event_id") * 7919 % 20) * 1_000_000)
