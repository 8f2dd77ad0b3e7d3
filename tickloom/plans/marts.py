"""Analytic marts on the staged ticks: daily statistics and hourly spreads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import order_key, present, region_of, rounded
from tickloom.operators.ordered import CHUNK, HALO, scan, with_halo
from tickloom.session import lookup

DAY_KEY = ["day_bucket", "benchmark"]
STAGED_ORDER = ("tick_time", "event_id")
SPREAD_ROWS = 168
MAJORS = {"WTI": "wti", "BRENT": "brent", "DUBAI": "dubai"}


def daily_stats(staged: DataFrame) -> DataFrame:
    """Statistics per day and benchmark.

    Every window function of the daily statistics spans the whole day, so a mergeable
    aggregate gives the same values without sorting the ticks of a day.
    """
    key = order_key(STAGED_ORDER)
    traded = F.sum(F.col("price") * F.col("volume"))
    return staged.groupBy(*DAY_KEY).agg(
        F.min_by("price", key).alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", key).alias("close_price"),
        F.sum("volume").alias("total_volume"),
        F.try_divide(traded, present(F.sum("volume"))).alias("vwap"),
        F.stddev_samp("price").alias("price_volatility"),
        F.count("*").alias("tick_count"),
        F.avg("spread").alias("avg_spread"),
    )


def daily_stats_window(staged: DataFrame) -> DataFrame:
    """Every tick with the statistics of its day; the few day rows are looked up, not windowed."""
    ticks = staged.select(*DAY_KEY, "region", "event_id", "tick_time")
    return ticks.join(lookup(daily_stats(staged)), DAY_KEY)


def distinct_on(df: DataFrame, keys: list[str], order_by) -> DataFrame:
    """The first row of each key in the given order.

    The winning position of each key comes from a hash aggregate over keys and positions alone; only then
    are the rows at those positions fetched. Rows that tie in key and position are one.
    """
    place, at = order_key(order_by), "_first"
    first = df.groupBy(*keys).agg(F.min(place).alias(at)).withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = place.eqNullSafe(first[at])
    for k in keys:
        same = same & df[k].eqNullSafe(first[f"_key_{k}"])
    return df.join(first, same, "left_semi").dropDuplicates(keys)


def daily_analytics(staged: DataFrame) -> DataFrame:
    """The daily mart: candle, average price, volatility and change to the day before."""
    by_day = Window.partitionBy("benchmark").orderBy("day_bucket")  # one row per calendar day
    close = F.col("close_price")
    pct = F.try_divide(F.col("change"), present(F.col("prev_close"))) * 100
    changed = (
        daily_stats(staged)
        .withColumn("prev_close", F.lag("close_price").over(by_day))
        .withColumn("change", close - F.col("prev_close"))
        .withColumn("pct", pct)
    )
    size = F.abs("pct")
    return changed.select(
        *DAY_KEY,
        region_of().alias("region"),
        rounded(F.col("open_price"), 3).alias("open"),
        rounded(F.col("high_price"), 3).alias("high"),
        rounded(F.col("low_price"), 3).alias("low"),
        rounded(close, 3).alias("close"),
        rounded(F.col("vwap"), 3).alias("vwap"),
        rounded(F.col("total_volume"), 0).alias("total_volume"),
        rounded(F.col("price_volatility"), 4).alias("daily_volatility"),
        rounded(F.col("avg_spread"), 4).alias("avg_spread"),
        rounded(F.col("change"), 3).alias("price_change"),
        rounded(F.col("pct"), 4).alias("pct_change"),
        "tick_count",
        F.when(size > 3, "HIGH").when(size > 1.5, "MEDIUM").otherwise("NORMAL").alias("volatility_regime"),
    ).orderBy(F.desc("day_bucket"), "benchmark")


def hourly_prices(staged: DataFrame) -> DataFrame:
    """Average, lowest and highest price per hour and benchmark."""
    return staged.groupBy("hour_bucket", "benchmark").agg(
        F.avg("price").alias("avg_price"), F.min("price").alias("min_price"), F.max("price").alias("max_price")
    )


def _major(benchmark: str) -> Column:
    return F.max(F.when(F.col("benchmark") == benchmark, F.col("avg_price")))


def spread_analysis(staged: DataFrame) -> DataFrame:
    """The spread mart: one row per hour in which exactly three benchmarks traded.

    Any three benchmarks pass, so one of the named prices can be missing. The moving average
    goes over 168 rows, not over seven days.
    """
    hours = (
        hourly_prices(staged)
        .groupBy("hour_bucket")
        .agg(*[_major(b).alias(name) for b, name in MAJORS.items()], F.count_distinct("benchmark").alias("n"))
        .where(F.col("n") == 3)
        .withColumn("gap", F.col("wti") - F.col("brent"))
    )
    wti, brent, dubai = (F.col(name) for name in MAJORS.values())
    order = ["hour_bucket"]
    months = hours.withColumn(CHUNK, (F.year("hour_bucket") * 12 + F.month("hour_bucket")).cast("long"))
    haloed = with_halo(months, [], order, SPREAD_ROWS - 1, ["gap"])
    moving = F.avg("gap").over(scan([], order).rowsBetween(1 - SPREAD_ROWS, 0))
    size = F.abs("gap")
    return (
        haloed.withColumn("moving", moving)
        .where(~F.col(HALO))
        .select(
            "hour_bucket",
            rounded(wti, 3).alias("wti_price"),
            rounded(brent, 3).alias("brent_price"),
            rounded(dubai, 3).alias("dubai_price"),
            rounded(F.col("gap"), 3).alias("wti_brent_spread"),
            rounded(brent - dubai, 3).alias("brent_dubai_spread"),
            rounded(wti - dubai, 3).alias("wti_dubai_spread"),
            F.when(size > 5, "WIDE").when(size > 3, "MODERATE").otherwise("NORMAL").alias("spread_regime"),
            F.col("moving").alias("wti_brent_7d_avg_spread"),
        )
        .orderBy(F.desc("hour_bucket"))
    )
