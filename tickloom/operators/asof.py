"""Joins along time: latest price of another benchmark, equal-time pairs, aligned spreads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import order_key
from tickloom.operators.ordered import EVENT_ORDER, running, with_chunk


def price_of(benchmark: str) -> Column:
    return F.when(F.col("benchmark") == benchmark, F.col("price"))


def asof_price(
    ticks: DataFrame, left: str = "WTI", right: str = "BRENT", order_by: Sequence[str] = EVENT_ORDER
) -> DataFrame:
    """Each tick of `left` with the latest price of `right` at that moment (column `asof_price`).

    Both sides pass one ordered scan as one frame, so nothing is joined pairwise.
    """
    pair = with_chunk(ticks.where(F.col("benchmark").isin(left, right)), order_by)
    seen = running(pair, [], order_by, lasts={"asof_price": price_of(right)})
    return seen.where(F.col("benchmark") == left)


def asof_spread(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Signed spread of each WTI tick to the latest BRENT price; null before the first one."""
    return asof_price(ticks, "WTI", "BRENT", order_by).select(
        "event_id", "time", F.col("price").alias("wti_price"), F.col("asof_price").alias("brent_price"),
        (F.col("price") - F.col("asof_price")).alias("spread"),
    )


def latest_spread(ticks: DataFrame) -> DataFrame:
    """Latest WTI price minus latest BRENT price: both in one pass, one row out."""
    key = order_key(EVENT_ORDER)
    last = {b: F.max_by("price", F.when(F.col("benchmark") == b, key)) for b in ("WTI", "BRENT")}
    pair = ticks.where(F.col("benchmark").isin("WTI", "BRENT"))
    return pair.agg((last["WTI"] - last["BRENT"]).alias("value"))


def spread_heatmap(ticks: DataFrame, interval: str = "5 minutes") -> DataFrame:
    """Average absolute WTI/BRENT spread over all ticks at moments where both traded.

    The two look-ups at equal time become one grouping by time; a moment counts once per tick.
    """
    key = order_key(EVENT_ORDER)
    moments = ticks.groupBy("time").agg(
        F.count("*").alias("n"),
        *[F.max_by(price_of(b), F.when(F.col("benchmark") == b, key)).alias(b) for b in ("WTI", "BRENT")],
    )
    both = moments.where(F.col("WTI").isNotNull() & F.col("BRENT").isNotNull())
    gap = F.abs(F.col("WTI") - F.col("BRENT"))
    return (
        both.groupBy(F.window("time", interval))
        .agg((F.sum(gap * F.col("n")) / F.sum("n")).alias("wti_brent_spread"))
        .select(F.col("window.start").alias("time"), "wti_brent_spread")
    )


def spread_5m(ticks: DataFrame, interval: str = "5 minutes") -> DataFrame:
    """Closing prices and spreads of WTI, BRENT and DUBAI per window; runs on streams as well."""
    key = order_key(EVENT_ORDER)
    names = {"WTI": "wti", "BRENT": "brent", "DUBAI": "dubai"}
    closes = [
        F.max_by("price", F.when(F.col("benchmark") == b, key)).alias(name) for b, name in names.items()
    ]
    rows = ticks.where(F.col("benchmark").isin(*names)).groupBy(F.window("time", interval)).agg(*closes)
    wti, brent, dubai = F.col("wti"), F.col("brent"), F.col("dubai")
    return rows.select(
        F.col("window.start").alias("time"), "wti", "brent", "dubai",
        (wti - brent).alias("wti_brent_spread"),
        (brent - dubai).alias("brent_dubai_spread"),
        (wti - dubai).alias("wti_dubai_spread"),
    )
