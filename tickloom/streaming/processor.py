"""The tick processor: candles, volatility, session price, alerts and live views of a stream.

Ticks count in the order of their arrival (event_id), within a batch as over batches, so results do
not depend on where a batch ends. What is known from earlier batches lives in Spark's state store
(`streaming.state`); each micro-batch of the enriched stream is written to several tables, each under
(date, batch), and then a commit row makes the batch count for readers. A batch that is run again after a
failure starts from the same state and replaces its own output.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickloom.functions.columns import iso_text, moment, order_key, present, rounded
from tickloom.operators.alerts import (
    alert_messages,
    fan_out,
    move_rule,
    newest_alerts,
    spread_rule,
    volatility_rule,
)
from tickloom.operators.candles import five_minute_messages
from tickloom.operators.ordered import with_chunk, with_sequence
from tickloom.plans.live import LIVE_SECONDS, SERIES_SECONDS, update_messages
from tickloom.sources.streams import write_topic
from tickloom.sources.tables import (
    Layout,
    commit_batch,
    dates_of,
    last_commit,
    newest_rows,
    read_batches,
    remove,
    write_batch,
)
from tickloom.streaming import windows
from tickloom.streaming.state import CANDLE_ROW, PAIR_ROW, TICK_ROW, enriched, state_partitions

CANDLE_TOPIC, ALERT_TOPIC, UPDATE_TOPIC, VWAP_TOPIC = "candles.1m", "alerts", "updates", "vwap"
FIVE_MINUTE_TOPIC = "candles.5m"
FLUSH = "2 seconds"
SAMPLE_EVERY = 10
HISTORY_ALERTS = 100
#: The rolling hour is stored in stretches of so many seconds, which are dropped whole.
STRETCH_SECONDS = 300

_ARRIVED = ("event_id",)
# Fields of the tables.
TABLES = {
    "ticks": "event_id bigint, time timestamp, benchmark string, exchange string, price double, volume double, bid double, ask double, source string",
    "candles_1m": (
        "time timestamp, benchmark string, open double, high double, low double, close double, volume double, vwap double, tick_count int"
    ),
    "alerts": (
        "event_id bigint, rule int, time timestamp, benchmark string, price double, alert_type string, "
        "delta double, delta_pct double, severity string, message string"
    ),
    "volatility": (
        "time timestamp, benchmark string, rolling_std_30 double, rolling_std_1m double, atr_14 double, realized_vol double"
    ),
    "live": "benchmark string, price double, vwap double, vol double, ts string, time timestamp, event_id bigint",
    "series": "benchmark string, time timestamp, price double",
}
DAYS = {"candles_1m": 7, "alerts": 7, "volatility": 7}


@dataclass
class TickProcessor:
    """Writes all outputs below `root`; topics go to `servers` when given, else to files."""

    spark: SparkSession
    root: str
    servers: str | None = None

    def start(self, ticks: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Run on a stream of good ticks. Offsets, state and batch numbers live in `checkpoint`."""
        writer = enriched(ticks).writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.run_batch)
        with state_partitions(self.spark):
            return writer.trigger(**(trigger or {"processingTime": FLUSH})).start()

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Write the independent outputs of an enriched micro-batch side by side, then commit it."""
        # a stream's session plans without AQE; the batch is a plain table and wants it back
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        rows = batch.withColumn("time", F.timestamp_micros("time_us")).drop("time_us").persist(StorageLevel.MEMORY_AND_DISK)
        ticks = rows.where(F.col("kind") == TICK_ROW).withColumn(
            "session_vwap", F.try_divide("session_pv", present(F.col("session_volume")))
        )
        try:
            count = ticks.count()
            seen = last_commit(self.spark, self.root, before=batch_id)[1]
            outputs = [
                lambda: self.write_ticks(ticks, batch_id),
                lambda: self.write_candles(rows.where(F.col("kind") == CANDLE_ROW), batch_id),
                lambda: self.write_alerts(ticks, rows.where(F.col("kind") == PAIR_ROW), batch_id),
                lambda: self.write_volatility(ticks, batch_id, seen),
                lambda: self.write_live(ticks, batch_id),
                lambda: self.write_updates(ticks, batch_id),
            ]
            with ThreadPoolExecutor(len(outputs)) as pool:
                for done in [pool.submit(write) for write in outputs]:
                    done.result()  # a failed output fails the batch, which is then run again
            commit_batch(self.spark, self.root, batch_id, seen + count)
        finally:
            rows.unpersist()

    def _write(self, rows: DataFrame, name: str, batch_id: int) -> None:
        write_batch(rows.select(*StructType.fromDDL(TABLES[name]).names), f"{self.root}/{name}", batch_id, DAYS.get(name, 1))

    def _topic(self, messages: DataFrame, topic: str, batch_id: int) -> None:
        if self.servers:
            write_topic(messages, topic, self.servers)
        else:
            timed = messages.withColumn("batch_id", F.lit(batch_id).cast("long"))
            writer = timed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("batch_id").json(f"{self.root}/topics/{topic}")

    def write_ticks(self, ticks: DataFrame, batch_id: int) -> None:
        self._write(ticks.withColumn("source", F.coalesce("source", F.lit("simulator"))), "ticks", batch_id)

    def write_candles(self, closed: DataFrame, batch_id: int) -> None:
        """The candles that the batch closed."""
        names = StructType.fromDDL(TABLES["candles_1m"]).names
        self._write(closed, "candles_1m", batch_id)
        self._topic(candle_messages(closed.select(*names)), CANDLE_TOPIC, batch_id)

    def write_alerts(self, ticks: DataFrame, pairs: DataFrame, batch_id: int) -> None:
        raised = fan_out(ticks, move_rule(), volatility_rule()).unionByName(fan_out(pairs, spread_rule()))
        filled = raised.withColumn("severity", F.coalesce("severity", F.lit("MEDIUM")))
        self._write(filled, "alerts", batch_id)
        self._topic(alert_messages(filled), ALERT_TOPIC, batch_id)

    def write_volatility(self, ticks: DataFrame, batch_id: int, seen: int) -> None:
        """Every tenth message with a volatility, counted over all batches; other measures stay empty."""
        numbered = with_sequence(with_chunk(ticks.select("event_id", "time", "benchmark", "rolling_std_30"), _ARRIVED), _ARRIVED)
        tenth = (F.col("seq") + seen) % SAMPLE_EVERY == 0
        sampled = numbered.where(tenth & present(F.col("rolling_std_30")).isNotNull())
        empty = {c: F.lit(None).cast("double") for c in ("rolling_std_1m", "atr_14", "realized_vol")}
        self._write(sampled.withColumns(empty), "volatility", batch_id)

    def write_live(self, ticks: DataFrame, batch_id: int) -> None:
        """The batch's newest arrival per benchmark, and its points of the rolling hour.

        Points an hour or more before their benchmark's newest tick of the batch are in no later hour either, as the
        newest time only rises; they are not stored, so files do not grow with the time that a batch spans.
        """
        key, shown = order_key(_ARRIVED), ("time", "price", "session_vwap", "rolling_std_30", "event_id")
        newest = ticks.groupBy("benchmark").agg(*[F.max_by(c, key).alias(c) for c in shown])
        state = newest.select(
            "benchmark",
            rounded(F.col("price"), 3).alias("price"),
            rounded(present(F.col("session_vwap")), 3).alias("vwap"),
            rounded(present(F.col("rolling_std_30")), 6).alias("vol"),
            iso_text("time").alias("ts"),
            "time",
            "event_id",
        )
        self._write(state, "live", batch_id)
        points = _last_seconds(ticks.select("benchmark", "time", "price"), SERIES_SECONDS).withColumns(
            {"stretch": _stretch(F.col("time")), "batch_id": F.lit(batch_id).cast("long")}
        )
        writer = points.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("stretch", "batch_id").parquet(f"{self.root}/series")

    def write_updates(self, ticks: DataFrame, batch_id: int) -> None:
        """Topics with one message per tick: the update event, and the session average price where there is one."""
        sent = ticks.select("event_id", "time", "benchmark", "price", "session_vwap")
        self._topic(update_messages(sent), UPDATE_TOPIC, batch_id)
        self._topic(vwap_messages(sent), VWAP_TOPIC, batch_id)

    # readers

    def committed(self) -> int:
        return last_commit(self.spark, self.root)[0]

    def read(self, name: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """A table's rows of committed batches."""
        schema, layout = StructType.fromDDL(TABLES[name]), Layout(DAYS.get(name, 1))
        rows = read_batches(self.spark, f"{self.root}/{name}", schema, self.committed(), layout, start, end)
        return rows.select(*schema.names)

    def topic(self, name: str) -> DataFrame:
        """Messages of committed batches; a batch that was run again stands there once."""
        rows = self.spark.read.schema("key string, value string, batch_id long").json(f"{self.root}/topics/{name}")
        return rows.where(F.col("batch_id") <= self.committed()).drop("batch_id")

    def live(self, as_of: datetime | None = None, seconds: int = LIVE_SECONDS) -> DataFrame:
        """The newest state per benchmark; with `as_of` entries older than a minute at that moment are gone."""
        after = None if as_of is None else as_of - timedelta(seconds=seconds)
        rows = self.read("live", after)
        if after is not None:
            rows = rows.where(F.col("time") > moment(rows, "time", after))
        fields = [c for c in rows.columns if c != "benchmark"]
        return rows.groupBy("benchmark").agg(*[F.max_by(c, "event_id").alias(c) for c in fields]).drop("event_id")

    def series(self, seconds: int = SERIES_SECONDS) -> DataFrame:
        """Distinct points of the last hour, or less, before each benchmark's newest tick."""
        if seconds > SERIES_SECONDS:
            raise ValueError(f"the series holds the last {SERIES_SECONDS} seconds")
        rows = self.spark.read.schema(f"{TABLES['series']}, stretch long, batch_id long").parquet(f"{self.root}/series")
        rows = rows.where(F.col("batch_id") <= self.committed())
        return _last_seconds(rows.select("benchmark", "time", "price"), seconds).dropDuplicates()

    def expire_series(self, as_of: datetime, seconds: int = SERIES_SECONDS) -> None:
        """Drop the stretches that end before the hour up to `as_of`; no row is written again.

        As each benchmark's hour counts from its own newest tick, `as_of` is that of the one furthest behind.
        """
        table = f"{self.root}/series"
        until = _stretch(F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp") - F.make_dt_interval(secs=F.lit(seconds)))
        stretches = self.spark.read.schema("stretch long").parquet(table).distinct()
        remove(self.spark, [f"{table}/stretch={r['stretch']}" for r in stretches.where(F.col("stretch") < until).collect()])

    def alert_history(self, count: int = HISTORY_ALERTS) -> DataFrame:
        """The newest alerts, read from the newest partitions alone."""
        schema = StructType.fromDDL(TABLES["alerts"])
        rows = read_batches(self.spark, f"{self.root}/alerts", schema, self.committed(), Layout(DAYS["alerts"]))
        order = [F.desc("time"), F.desc("event_id"), F.desc("rule")]
        found = newest_rows(rows.drop("batch_id"), dates_of(self.spark, f"{self.root}/alerts"), count, order)
        return newest_alerts(found, count).select(*schema.names)


@dataclass
class FiveMinutePublisher:
    """Publishes five-minute candles as their windows close; a stream of its own, with commits of its own."""

    spark: SparkSession
    root: str
    servers: str | None = None

    def start(self, ticks: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        writer = windows.candles_5m(ticks).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        with state_partitions(self.spark):
            return writer.foreachBatch(self.run_batch).trigger(**(trigger or {"processingTime": FLUSH})).start()

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        out = TickProcessor(self.spark, self.root, self.servers)
        out._topic(five_minute_messages(batch), FIVE_MINUTE_TOPIC, batch_id)
        commit_batch(self.spark, self.root, batch_id, 0)

    def messages(self) -> DataFrame:
        return TickProcessor(self.spark, self.root).topic(FIVE_MINUTE_TOPIC).select("value")


def _last_seconds(points: DataFrame, seconds: int) -> DataFrame:
    """The points of the last `seconds` before each benchmark's newest one."""
    hour = F.make_dt_interval(secs=F.lit(seconds))
    latest = points.groupBy("benchmark").agg((F.max("time") - hour).alias("after"))
    return points.join(latest, "benchmark").where(F.col("time") > F.col("after")).drop("after")


def _stretch(time: Column) -> Column:
    return F.floor(F.unix_seconds(time) / STRETCH_SECONDS) * STRETCH_SECONDS


def candle_messages(candles: DataFrame) -> DataFrame:
    """Closed candles as keyed JSON messages."""
    body = F.struct(iso_text("time").alias("time"), *[c for c in candles.columns if c != "time"])
    return candles.select(F.col("benchmark").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def vwap_messages(priced: DataFrame) -> DataFrame:
    """Session average prices as keyed JSON messages, where volume was seen."""
    body = F.struct("benchmark", rounded(F.col("session_vwap"), 4).alias("vwap"), iso_text("time").alias("time"))
    known = priced.where(F.col("session_vwap").isNotNull())
    return known.select(F.col("benchmark").alias("key"), F.to_json(body).alias("value"))
