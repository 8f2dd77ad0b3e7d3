"""Live views: newest state per benchmark, the last hour, update events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import iso_text, moment, order_key, present, rounded
from tickloom.operators.ordered import EVENT_ORDER
from tickloom.operators.returns import KEY, simple_return, session_vwap
from tickloom.schemas import MIN_VOL_TICKS, ROLLING_TICKS
from tickloom.session import lookup

LIVE_SECONDS, SERIES_SECONDS = 60, 3600


def tail(ticks: DataFrame, rows: int = ROLLING_TICKS, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """The newest `rows` ticks per benchmark.

    Both steps are top-k windows that Spark cuts per input partition; the first one, per day,
    keeps the rows that reach the second one few however many partitions there are.
    """
    newest = [F.desc(c) for c in order_by]
    day = Window.partitionBy(*KEY, F.to_date("time")).orderBy(*newest)
    daily = ticks.withColumn("back", F.row_number().over(day)).where(F.col("back") <= rows).drop("back")
    whole = Window.partitionBy(*KEY).orderBy(*newest)
    return daily.withColumn("back", F.row_number().over(whole)).where(F.col("back") <= rows)


def live_state(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Newest time and price, session average price and rolling volatility per benchmark.

    At the newest tick the session sums are plain totals and the volatility needs 30 ticks only,
    so no per-tick scan is run.
    """
    key = order_key(order_by)
    pv = F.sum(F.col("price") * F.col("volume"))
    totals = ticks.groupBy(*KEY).agg(
        F.max_by("time", key).alias("time"),
        F.max_by("price", key).alias("price"),
        F.try_divide(pv, present(F.sum("volume"))).alias("vwap"),
    )
    along = Window.partitionBy(*KEY).orderBy(F.desc("back"))
    returns = tail(ticks, ROLLING_TICKS, order_by).withColumn(
        "ret", simple_return(F.col("price"), F.lag("price").over(along))
    )
    vol = returns.groupBy(*KEY).agg(
        F.when(F.count("price") >= MIN_VOL_TICKS, F.stddev_pop("ret")).alias("vol")
    )
    return totals.join(vol, KEY).select(*KEY, "time", "price", "vwap", "vol")


def live_prices(ticks: DataFrame, as_of: datetime | None = None, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """The live price entries; zero and missing values are left empty, entries end after 60 seconds."""
    state = live_state(ticks, order_by)
    if as_of is not None:
        state = state.where(F.col("time") > moment(state, "time", as_of - timedelta(seconds=LIVE_SECONDS)))
    return state.select(
        *KEY,
        rounded(F.col("price"), 3).alias("price"),
        rounded(present(F.col("vwap")), 3).alias("vwap"),
        rounded(present(F.col("vol")), 6).alias("vol"),
        iso_text("time").alias("ts"),
    )


def live_series(ticks: DataFrame, seconds: int = SERIES_SECONDS) -> DataFrame:
    """Distinct (time, price) points of the last hour before each benchmark's newest tick."""
    hour = F.make_dt_interval(secs=F.lit(seconds))
    newest = lookup(ticks.groupBy(*KEY).agg((F.max("time") - hour).alias("after")))
    # the earliest bound as a literal lets the scan skip older files
    earliest = newest.agg(F.min("after").cast("string").alias("after")).first()["after"]
    recent = ticks.where(F.col("time") > F.lit(earliest).cast(ticks.schema["time"].dataType))
    points = recent.join(newest, KEY).where(F.col("time") > F.col("after"))
    return points.select(*KEY, "time", "price").dropDuplicates()


def series_tail(points: DataFrame, rows: int = 10) -> DataFrame:
    """The last points of each series; ties in time by the text of the price, as a sorted set has it."""
    return tail(points.withColumn("member", F.col("price").cast("string")), rows, ("time", "member")).select(
        *KEY, "time", "price", "back"
    )


def tick_updates(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """One update message per tick: price, session average price or null, and time."""
    return update_messages(session_vwap(ticks, order_by)).select("event_id", "key", "value")


def update_messages(priced: DataFrame) -> DataFrame:
    """event_id, key, value of ticks whose session average price is known."""
    body = F.struct(
        "benchmark",
        rounded(F.col("price"), 3).alias("price"),
        rounded(present(F.col("session_vwap")), 3).alias("vwap"),
        iso_text("time").alias("ts"),
    )
    return priced.select("event_id", F.col("benchmark").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))
