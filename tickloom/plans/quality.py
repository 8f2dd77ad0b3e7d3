"""Data-quality checks: each returns one row per check with the number of failing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import ALERT_TYPES, BENCHMARKS

# Required columns per table and the accepted price range.
REQUIRED = {
    "ticks": ["time", "benchmark", "price", "volume"],
    "candles": ["time", "benchmark", "open", "close"],
    "alerts": ["time"],
    "staged": ["tick_time", "benchmark", "price"],
    "daily": ["day_bucket", "benchmark"],
    "spread": ["hour_bucket"],
}
ACCEPTED = {"ticks": ("benchmark", BENCHMARKS), "alerts": ("alert_type", ALERT_TYPES)}
PRICE_RANGE = (0.0, 300.0)


def _failures(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """Count all checks of a table in one pass and turn them into rows."""
    counts = df.agg(*[F.count_if(failed).alias(name) for name, failed in checks.items()])
    rows = F.array(
        *[F.struct(F.lit(table).alias("table_name"), F.lit(n).alias("column_name"), F.col(n).alias("failures")) for n in checks]
    )
    return counts.select(F.inline(rows))


def not_null(df: DataFrame, table: str) -> DataFrame:
    return _failures(df, table, {c: F.col(c).isNull() for c in REQUIRED[table]})


def accepted_values(df: DataFrame, table: str) -> DataFrame:
    column, allowed = ACCEPTED[table]
    return _failures(df, table, {column: F.col(column).isNotNull() & ~F.col(column).isin(allowed)})


def accepted_range(df: DataFrame, table: str, column: str = "price", limits=PRICE_RANGE) -> DataFrame:
    return _failures(df, table, {column: ~F.col(column).between(*limits)})


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
