"""Small column expressions: time buckets, rounding, safe division, text forms."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def truncated(df: DataFrame, time: str, unit: str) -> Column:
    """`date_trunc` that keeps the timestamp kind of column `time` in `df`."""
    return F.date_trunc(unit, F.col(time)).cast(df.schema[time].dataType)


def moment(df: DataFrame, time: str, value: datetime) -> Column:
    """A literal point in time of the same kind as column `time`, so that the filter reaches the scan."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(df.schema[time].dataType)


def micros(time: str | Column) -> Column:
    """Microseconds since the epoch."""
    column = F.col(time) if isinstance(time, str) else time
    return F.unix_micros(column.cast("timestamp"))


def start_of(time: str | Column, seconds: int) -> Column:
    """Start of the epoch-aligned bucket of `seconds` that holds `time`."""
    at = micros(time)
    return F.timestamp_micros(at - F.pmod(at, F.lit(seconds * 1_000_000)))


def iso_text(time: str | Column) -> Column:
    """ISO 8601 in UTC; the fraction is left out when it is zero."""
    column = F.col(time) if isinstance(time, str) else time
    stamp = column.cast("timestamp")
    return F.when(
        F.unix_micros(stamp) % 1_000_000 == 0, F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ssxxx")
    ).otherwise(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def rounded(value: Column, places: int) -> Column:
    """Round half up on ten decimal places, which hides the noise of float summation order."""
    return F.round(value.cast("decimal(38,10)"), places).cast("double")


def present(value: Column) -> Column:
    """Null for zero and for null: both count as missing."""
    return F.when(value != 0, value)


#: More than the span of a long, so that the second order column never reaches into the first.
_SPAN = Decimal(2 * 10**19)


def order_key(order_by) -> Column:
    """One number that orders as the columns do: event times, positions, or a time and a position.

    A number fits in a hash aggregate's buffer; a struct would make Spark sort before it aggregates.
    Times of the years 1 to 9999 with any long position stay within 38 digits.
    """
    first, *rest = [micros(c) if c.endswith("time") else F.col(c) for c in order_by]
    if not rest:
        return first
    (second,) = rest
    return first.cast("decimal(18,0)") * F.lit(_SPAN) + second.cast("decimal(20,0)")


def region_of(benchmark: str | Column = "benchmark") -> Column:
    column = F.col(benchmark) if isinstance(benchmark, str) else benchmark
    # The reporting regions.
    return (
        F.when(column == "WTI", "NORTH_AMERICA")
        .when(column == "BRENT", "EUROPE")
        .when(column == "DUBAI", "MIDDLE_EAST")
        .otherwise("OTHER")
    )
