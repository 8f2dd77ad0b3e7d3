"""Projections of single ticks: quotes, limits, bands, dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import rounded
from tickloom.schemas import markets

# Limits of a derived quote.
PRICE_FLOOR, PRICE_CEILING = 30.0, 200.0
VOLUME_FLOOR, OPEN_INTEREST_FLOOR = 100.0, 500_000.0
SPREAD_PCT = 0.001


def derive_quotes(ticks: DataFrame, spread_pct: float = SPREAD_PCT) -> DataFrame:
    """Bid and ask half a spread away from the price, to three places."""
    half = F.col("price") * spread_pct / 2
    return ticks.withColumns({"bid": rounded(F.col("price") - half, 3), "ask": rounded(F.col("price") + half, 3)})


def clamp_market(ticks: DataFrame) -> DataFrame:
    """Force price, volume and (when there) open interest into the market's limits."""
    limits = {
        "price": rounded(F.least(F.greatest("price", F.lit(PRICE_FLOOR)), F.lit(PRICE_CEILING)), 3),
        "volume": rounded(F.greatest("volume", F.lit(VOLUME_FLOOR)), 1),
    }
    if "open_interest" in ticks.columns:
        limits["open_interest"] = rounded(F.greatest("open_interest", F.lit(OPEN_INTEREST_FLOOR)), 0)
    return ticks.withColumns(limits)


def price_band(ticks: DataFrame) -> DataFrame:
    """Colour band of a price: from 0 red, from 60 yellow, from 75 green."""
    price = F.col("price")
    return ticks.withColumn("band", F.when(price >= 75, "green").when(price >= 60, "yellow").when(price >= 0, "red"))


def enrich_benchmark(ticks: DataFrame) -> DataFrame:
    """Look up exchange, region and volatility of the market; the dimension has three fixed rows."""
    return ticks.join(F.broadcast(markets(ticks.sparkSession)), "benchmark", "left")
