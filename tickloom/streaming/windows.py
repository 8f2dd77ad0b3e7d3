"""Event-time windows over tick streams, behind a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import rounded
from tickloom.operators import asof, candles
from tickloom.operators.returns import PANE, SPAN, TICKS_PER_YEAR
from tickloom.streaming.state import tick_returns

LATENESS = "5 seconds"


def watermarked(ticks: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Ticks that may come up to `lateness` out of order; later ones are dropped by the windows."""
    return ticks.withWatermark("time", lateness)


def candles_5m(ticks: DataFrame) -> DataFrame:
    """Five-minute candles, each emitted once its window is past the watermark."""
    return candles.candles_5m(watermarked(ticks))


def spread_5m(ticks: DataFrame) -> DataFrame:
    """Five-minute spreads of the three majors; one grouped window instead of stream joins."""
    return asof.spread_5m(watermarked(ticks))


def realized_vol(ticks: DataFrame) -> DataFrame:
    """Realized volatility of each hour, sliding by five minutes, emitted once the hour is past the watermark.

    Two stateful steps in one stream: the return to the tick before, then the windows. A return counts
    in the windows that hold both of its ticks.
    """
    placed = tick_returns(watermarked(ticks)).select("*", F.window("time", SPAN, PANE))
    inside = F.when(F.col("prev_time") >= F.col("window.start"), F.col("ret"))
    rows = placed.groupBy("window", "benchmark").agg(F.stddev_pop(inside).alias("std"), F.count("*").alias("tick_count"))
    return rows.select(
        "benchmark",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        rounded(F.col("std"), 6).alias("realized_vol"),
        rounded(F.col("std") * (TICKS_PER_YEAR**0.5), 4).alias("annualized_vol"),
        "tick_count",
    )
