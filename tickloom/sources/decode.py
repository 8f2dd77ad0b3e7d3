"""Messages to ticks and back: JSON, Avro, external trade feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tickloom.functions.columns import micros, region_of
from tickloom.schemas import AVRO_TICK, WIRE_TICK

REGISTRY_HEADER = 5  # one format byte and a four-byte schema number
_CORRUPT = "_corrupt"


def _avro():
    try:
        from pyspark.sql.avro import functions
    except ImportError as error:  # pragma: no cover
        raise RuntimeError("Avro needs the spark-avro package on the class path") from error
    return functions


def _typed(parsed: DataFrame, message: str) -> DataFrame:
    """Fill defaults and name the fault of messages that are no usable tick."""
    kept = [c for c in parsed.columns if c not in (message, "value")]
    field = F.col(message)
    fault = (
        F.when(field.isNull() | field[_CORRUPT].isNotNull(), "unparsable")
        .when(field["price"].isNull() | field["volume"].isNull(), "incomplete")
    )
    return parsed.select(
        *kept,
        F.timestamp_millis(F.coalesce(field["event_time"], F.lit(0))).alias("time"),
        F.coalesce(field["benchmark"], F.lit("UNKNOWN")).alias("benchmark"),
        *[field[c].alias(c) for c in ("exchange", "price", "volume", "bid", "ask", "open_interest")],
        F.coalesce(field["source"], F.lit("simulator")).alias("source"),
        field["region"].alias("region"),
        fault.alias("fault"),
        F.col("value").alias("raw"),
    )


def decode_json(messages: DataFrame) -> DataFrame:
    """Decode column `value`; other columns are kept. `fault` is null for good ticks.

    Missing times become the epoch and missing benchmarks UNKNOWN; messages that do not parse or
    lack price or volume keep their text in `raw`.
    """
    schema = StructType([*WIRE_TICK.fields]).add(_CORRUPT, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    text = messages.withColumn("value", F.col("value").cast("string"))
    return _typed(text.withColumn("_message", F.from_json("value", schema, options)), "_message")


def decode_avro(messages: DataFrame) -> DataFrame:
    """Decode registry-framed Avro in column `value`; a message that does not decode gets a fault."""
    body = F.expr(f"substring(value, {REGISTRY_HEADER + 1})")
    decoded = messages.withColumn("_tick", _avro().from_avro(body, AVRO_TICK, {"mode": "PERMISSIVE"}))
    fields = [F.col("_tick")[f.name].alias(f.name) for f in WIRE_TICK.fields]
    message = F.when(F.col("_tick").isNotNull(), F.struct(*fields, F.lit(None).cast("string").alias(_CORRUPT)))
    return _typed(decoded.withColumn("_message", message).drop("_tick"), "_message")


def decode_ticks(messages: DataFrame, fmt: str = "json") -> DataFrame:
    return {"json": decode_json, "avro": decode_avro}[fmt](messages)


def good_ticks(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("fault").isNull()).drop("fault", "raw")


def dead_letters(decoded: DataFrame) -> DataFrame:
    """The messages that gave no tick, with the reason."""
    return decoded.where(F.col("fault").isNotNull()).select(
        *[c for c in decoded.columns if c in ("event_id", "offset", "partition")], "fault", "raw"
    )


def feed_adapter(messages: DataFrame, benchmark: str, exchange: str) -> DataFrame:
    """Map trade messages of one outside feed to ticks; numbers may come as text."""
    trade = F.from_json(F.col("value").cast("string"), "tradePrice string, tradeQuantity string, timestamp string")
    kept = [c for c in messages.columns if c != "value"]
    return messages.withColumn("_trade", trade).select(
        *kept,
        F.timestamp_millis(F.col("_trade.timestamp").try_cast("bigint")).alias("time"),
        F.lit(benchmark).alias("benchmark"),
        F.lit(exchange).alias("exchange"),
        F.col("_trade.tradePrice").try_cast("double").alias("price"),
        F.col("_trade.tradeQuantity").try_cast("double").alias("volume"),
    )


def _wire(ticks: DataFrame):
    known = set(ticks.columns)
    made = {
        "event_time": F.floor(micros("time") / 1000),
        # stored ticks have no region; a benchmark without a market of its own has none on the wire
        "region": F.col("region") if "region" in known else F.nullif(region_of(), F.lit("OTHER")),
    }
    fields = [
        made.get(f.name, F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in WIRE_TICK.fields
    ]
    return F.struct(*fields)


def framed(body: Column, schema_id: int) -> Column:
    """Avro bytes behind the registry's header: a zero byte and the schema's number."""
    return F.concat(F.unhex(F.lit(f"00{schema_id:08x}")), body)


def publish_ticks(ticks: DataFrame, fmt: str = "json", schema_id: int = 1) -> DataFrame:
    """Ticks as messages keyed by benchmark, so a keyed log keeps each benchmark's order.

    Avro is framed as `decode_avro` expects it; `schema_id` is the number that the registry gave the schema.
    """
    wire = _wire(ticks)
    value = F.to_json(wire, {"ignoreNullFields": "false"}) if fmt == "json" else framed(_avro().to_avro(wire, AVRO_TICK), schema_id)
    return ticks.select("event_id", F.col("benchmark").alias("key"), value.alias("value"))
