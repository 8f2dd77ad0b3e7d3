"""Table schemas, the market dimension and the fixed limits of the rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(required: dict, optional: dict) -> StructType:
    fields = [StructField(name, kind, False) for name, kind in required.items()]
    fields += [StructField(name, kind, True) for name, kind in optional.items()]
    return StructType(fields)


_STR, _DBL, _TS = StringType(), DoubleType(), TimestampType()

# Names and kinds of a tick's fields.
# One tick at rest. `event_id` is the arrival position (a log offset) and breaks ties in `time`.
TICK = _schema(
    {"event_id": LongType(), "time": _TS, "benchmark": _STR, "exchange": _STR, "price": _DBL, "volume": _DBL},
    {"bid": _DBL, "ask": _DBL, "source": _STR},
)

# One tick on the wire, `event_time` in epoch milliseconds.
WIRE_TICK = StructType(
    [
        StructField("event_time", LongType()),
        StructField("benchmark", _STR),
        StructField("exchange", _STR),
        StructField("price", _DBL),
        StructField("volume", _DBL),
        StructField("bid", _DBL),
        StructField("ask", _DBL),
        StructField("open_interest", _DBL),
        StructField("source", _STR),
        StructField("region", _STR),
    ]
)

# Accepted symbols, markets and rule limits.
BENCHMARKS = ["WTI", "BRENT", "DUBAI", "URALS", "OPEC_BASKET"]
ALERT_TYPES = ["SPIKE", "DROP", "SPREAD_WIDE", "VOLATILITY"]
MARKETS = [
    ("WTI", "NYMEX", "NORTH_AMERICA", 78.42, 0.28),
    ("BRENT", "ICE", "EUROPE", 82.15, 0.25),
    ("DUBAI", "ADNOC", "MIDDLE_EAST", 80.90, 0.22),
]
MOVE_PCT = 0.5
SPREAD_LIMIT = 5.0
VOL_LIMIT = 0.3
ROLLING_TICKS = 30
MIN_VOL_TICKS = 5

# The wire schema in Avro form.
AVRO_TICK = """
{"type": "record", "name": "Tick", "fields": [
  {"name": "event_time", "type": "long"},
  {"name": "benchmark", "type": {"type": "enum", "name": "Benchmark",
    "symbols": ["WTI", "BRENT", "DUBAI", "URALS", "OPEC_BASKET"]}},
  {"name": "exchange", "type": "string"},
  {"name": "price", "type": "double"},
  {"name": "volume", "type": "double"},
  {"name": "bid", "type": ["null", "double"], "default": null},
  {"name": "ask", "type": ["null", "double"], "default": null},
  {"name": "open_interest", "type": ["null", "double"], "default": null},
  {"name": "source", "type": "string", "default": "simulator"},
  {"name": "region", "type": {"type": "enum", "name": "Region",
    "symbols": ["NORTH_AMERICA", "EUROPE", "MIDDLE_EAST", "ASIA_PACIFIC"]}}
]}
"""


def markets(spark: SparkSession) -> DataFrame:
    """The market dimension: three fixed rows."""
    rows = ", ".join(str(row) for row in MARKETS)
    return spark.sql(
        f"SELECT benchmark, market_exchange, market_region, CAST(price AS DOUBLE) AS base_price, CAST(vol AS DOUBLE) AS sigma "
        f"FROM VALUES {rows} AS t(benchmark, market_exchange, market_region, price, vol)"
    )
