"""Tick-to-tick moves and volatility of prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import micros, present, rounded, start_of
from tickloom.operators.ordered import (
    EVENT_ORDER,
    HALO,
    running,
    scan,
    with_chunk,
    with_halo,
    with_sequence,
)
from tickloom.schemas import MIN_VOL_TICKS, ROLLING_TICKS

KEY = ["benchmark"]
# Fixed value: half-second ticks of 252 trading days of 8 hours.
TICKS_PER_YEAR = 252 * 8 * 3600 * 2
PANE, PANE_SECONDS, SPAN = "5 minutes", 300, "1 hour"


def simple_return(price: Column, previous: Column) -> Column:
    """Relative change; null where the previous price is zero or missing."""
    return F.try_divide(price - previous, previous)


def moments(value: str) -> list[Column]:
    """Count, mean and sum of squared distances from it: parts that merge without large sums."""
    return [
        F.count(value).alias("n"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("m2"),
    ]


def merged_deviation(parts: Column) -> Column:
    """Population deviation of an array of such parts; null for no values.

    The common mean comes first and distances are taken from it, so nearly equal values far from zero
    keep their digits.
    """
    zero = F.lit(0.0)
    n = F.aggregate(parts, zero, lambda acc, p: acc + p["n"])
    # an offset of the first part's mean leaves the sum small
    first = F.coalesce(F.try_element_at(parts, F.lit(1))["mean"], zero)
    mean = _bound(first, lambda f: f + F.try_divide(F.aggregate(parts, zero, lambda acc, p: acc + p["n"] * (p["mean"] - f)), n))
    m2 = _bound(mean, lambda m: F.aggregate(parts, zero, lambda acc, p: acc + p["m2"] + p["n"] * (p["mean"] - m) * (p["mean"] - m)))
    return F.sqrt(F.try_divide(m2, n))


def _bound(value: Column, use) -> Column:
    """`use` of a value that is worked out once; written into a lambda, it would be for every element."""
    return F.transform(F.array(value), use)[0]


def with_previous(chunked: DataFrame, order_by: Sequence[str] = EVENT_ORDER, columns=("price",)) -> DataFrame:
    """Add `prev_<column>` of the tick before, per benchmark."""
    spec = scan(KEY, order_by)
    lagged = {f"prev_{c}": F.lag(c).over(spec) for c in columns}
    return with_halo(chunked, KEY, order_by, 1, columns).withColumns(lagged).where(~F.col(HALO)).drop(HALO)


def tick_returns(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Delta and percent delta to the tick before; null on the first tick of a benchmark."""
    moved = with_previous(with_chunk(ticks, order_by), order_by)
    delta = F.col("price") - F.col("prev_price")
    return moved.withColumns({"delta": delta, "delta_pct": F.try_divide(delta, F.col("prev_price")) * 100})


def with_rolling(haloed: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Add previous price and rolling volatility to a frame whose halo has 30 rows; keeps the halo."""
    spec = scan(KEY, order_by)
    enough = F.lag("price", MIN_VOL_TICKS - 1).over(spec).isNotNull()
    spread = F.stddev_pop("_ret").over(spec.rowsBetween(2 - ROLLING_TICKS, 0))
    return (
        haloed.withColumns({"prev_price": F.lag("price").over(spec), "prev_time": F.lag("time").over(spec)})
        .withColumn("_ret", simple_return(F.col("price"), F.col("prev_price")))
        .withColumn("rolling_std_30", F.when(enough, spread))
        .drop("_ret")
    )


def rolling_vol(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Population deviation of the returns among the last 30 prices; null below five prices."""
    haloed = with_halo(with_chunk(ticks, order_by), KEY, order_by, ROLLING_TICKS, ["price", "time"])
    return with_rolling(haloed, order_by).where(~F.col(HALO)).drop(HALO)


def volatility_sampled(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER, every: int = 10) -> DataFrame:
    """Rolling volatility of every tenth arriving tick, over all benchmarks, where it is not zero."""
    sampled = with_sequence(rolling_vol(ticks, order_by), order_by)
    return sampled.where((F.col("seq") % every == 0) & present(F.col("rolling_std_30")).isNotNull())


def session_vwap(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER, initial: DataFrame | None = None) -> DataFrame:
    """Volume-weighted average price since the start; null while no volume was seen."""
    return with_session_vwap(with_chunk(ticks, order_by), order_by, initial)


def with_session_vwap(
    chunked: DataFrame,
    order_by: Sequence[str],
    initial: DataFrame | None = None,
    summarize: DataFrame | None = None,
) -> DataFrame:
    sums = {"session_pv": F.col("price") * F.col("volume"), "session_volume": F.col("volume")}
    totals = running(chunked, KEY, order_by, sums=sums, initial=initial, summarize=summarize)
    return totals.withColumn("session_vwap", F.try_divide("session_pv", present(F.col("session_volume"))))


def volatility_1m_avg(sampled: DataFrame) -> DataFrame:
    """Average sampled volatility per minute and benchmark."""
    return (
        sampled.groupBy(F.window("time", "1 minute"), "benchmark")
        .agg(F.avg("rolling_std_30").alias("volatility"))
        .select(F.col("window.start").alias("time"), "benchmark", "volatility")
    )


def rolling_std_1m(ticks: DataFrame) -> DataFrame:
    """Population deviation of the returns of the 60 seconds that end with each traded second.

    Seconds are summed first, so a crowded second costs one row in the frame. Each hour also gets
    the last minute of the hour before it; a frame then never leaves its hour.
    """
    moved = with_previous(with_chunk(ticks.select(*EVENT_ORDER, *KEY, "price")))
    seconds = (
        moved.withColumn("_ret", simple_return(F.col("price"), F.col("prev_price")))
        .groupBy("benchmark", F.floor(micros("time") / 1_000_000).alias("second"))
        .agg(*moments("_ret"))
    )
    hour = F.floor(F.col("second") / 3600)
    late = F.when(F.col("second") % 3600 > 3540, F.array(hour, hour + 1)).otherwise(F.array(hour))
    frame = Window.partitionBy("benchmark", "_hour").orderBy("second").rangeBetween(-59, 0)
    # at most 60 parts
    parts = F.collect_list(F.when(F.col("n") > 0, F.struct("n", "mean", "m2"))).over(frame)
    framed = seconds.withColumn("_hour", F.explode(late)).withColumn("_parts", parts)
    return framed.where(F.col("_hour") == hour).select(
        F.timestamp_seconds("second").cast(ticks.schema["time"].dataType).alias("time"),
        "benchmark",
        merged_deviation(F.col("_parts")).alias("rolling_std_1m"),
    )


def pane_statistics(moved: DataFrame) -> DataFrame:
    """Moments of returns per five-minute pane and pane of the tick before.

    A return counts in the windows that hold both of its ticks. Windows start on pane borders, so
    the two panes decide that, and the moments can be merged in any order.
    """
    change = simple_return(F.col("price"), F.col("prev_price"))
    kind = moved.schema["time"].dataType
    paned = moved.select(
        "benchmark",
        start_of("time", PANE_SECONDS).cast(kind).alias("pane"),
        start_of("prev_time", PANE_SECONDS).cast(kind).alias("prev_pane"),
        change.alias("_ret"),
    )
    return paned.groupBy("benchmark", "pane", "prev_pane").agg(F.count("*").alias("ticks"), *moments("_ret"))


def realized_from_panes(panes: DataFrame) -> DataFrame:
    """Combine the panes of each sliding hour; rows here are panes, not ticks."""
    placed = panes.select("*", F.window("pane", SPAN, PANE))
    inside = (F.col("prev_pane") >= F.col("window.start")) & (F.col("prev_pane") < F.col("window.end")) & (F.col("n") > 0)
    # at most 12 panes, each with the panes of the ticks before that the hour holds too
    parts = F.collect_list(F.when(inside, F.struct("n", "mean", "m2")))
    sums = placed.groupBy("window", "benchmark").agg(F.sum("ticks").alias("tick_count"), parts.alias("parts"))
    # a column of its own, as it is shown in two units
    spread = sums.withColumn("std", merged_deviation(F.col("parts")))
    return spread.select(
        "benchmark",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        rounded(F.col("std"), 6).alias("realized_vol"),
        rounded(F.col("std") * (TICKS_PER_YEAR**0.5), 4).alias("annualized_vol"),
        "tick_count",
    )


def realized_vol(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Realized volatility of each hour, sliding by five minutes; null below two prices."""
    narrow = ticks.select(*dict.fromkeys([*order_by, "time", *KEY, "price"]))
    moved = with_previous(with_chunk(narrow, order_by), order_by, ("price", "time"))
    return realized_from_panes(pane_statistics(moved))
