"""Every operator as a query over the given tables.

Values that an operator leaves unrounded are rounded here to six places, so that the order of
float additions does not show; the reference SQL does the same.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions.columns import rounded
from tickloom.operators import alerts, asof, candles, quotes, returns, rollups
from tickloom.operators.ordered import ARRIVAL_ORDER, with_chunk, with_sequence
from tickloom.plans import dashboard, live, maintenance, marts, quality, staging, stored
from tickloom.schemas import TICK
from tickloom.session import lookup, prepare, scratch_path
from tickloom.sources import decode, replay, streams
from tickloom.sources.tables import LAYOUTS, exists, read_table, write_batch, write_table
from tickloom.streaming import processor, state, windows

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 1, 31)
DENSE_START, DENSE_END = datetime(2024, 1, 1), datetime(2024, 1, 1, 12)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def once_a_session(make):
    """Let queries that read the same written tables share them."""
    made = {}

    def shared(spark: SparkSession, sf_dir: str, *view):
        key = spark.sparkContext.applicationId, sf_dir, view
        if key not in made or not exists(spark, made[key].root):
            made[key] = make(spark, sf_dir, *view)
        return made[key]

    return shared


def six(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c), 6) for c in columns})


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_ticks(replay.ticks(spark, sf_dir), AS_OF)


# staging, marts


@query
def scan_ticks(spark, sf_dir):
    return replay.ticks(spark, sf_dir)


@query
def stg_ticks(spark, sf_dir):
    return six(_staged(spark, sf_dir), "spread")


@query
def ticks_last_n_days(spark, sf_dir):
    return staging.last_days(replay.ticks(spark, sf_dir), AS_OF, 15)


@query
def daily_analytics(spark, sf_dir):
    return marts.daily_analytics(_staged(spark, sf_dir))


@query
def daily_stats_window(spark, sf_dir):
    stats = marts.daily_stats_window(_staged(spark, sf_dir))
    return six(stats, "vwap", "price_volatility", "avg_spread")


@query
def distinct_on_latest(spark, sf_dir):
    columns = ["day_bucket", "benchmark", "region", "event_id", "tick_time", "price"]
    return marts.distinct_on(_staged(spark, sf_dir).select(*columns), marts.DAY_KEY, marts.STAGED_ORDER)


@query
def hourly_prices(spark, sf_dir):
    return six(marts.hourly_prices(_staged(spark, sf_dir)), "avg_price")


@query
def spread_analysis(spark, sf_dir):
    return six(marts.spread_analysis(_staged(spark, sf_dir)), "wti_brent_7d_avg_spread")


@query
def spread_analysis_majors(spark, sf_dir):
    majors = _staged(spark, sf_dir).where(F.col("benchmark").isin("WTI", "BRENT", "DUBAI"))
    return six(marts.spread_analysis(majors), "wti_brent_7d_avg_spread")


# rollups


@query
def rollup_hourly(spark, sf_dir):
    return six(rollups.rollup_hourly(replay.ticks(spark, sf_dir)), "vwap")


@query
def rollup_daily(spark, sf_dir):
    return six(rollups.rollup_daily(replay.ticks(spark, sf_dir)), "vwap", "daily_volatility")


# candles


@query
def candles_1m(spark, sf_dir):
    return six(candles.candles_1m(replay.ticks_dense(spark, sf_dir)), "vwap")


@query
def candles_1m_arrival(spark, sf_dir):
    arriving = replay.with_arrival(replay.ticks_dense(spark, sf_dir))
    return six(candles.candles_1m(arriving, ARRIVAL_ORDER), "vwap")


@query
def candles_5m(spark, sf_dir):
    return candles.candles_5m(replay.ticks_dense(spark, sf_dir))


@query
def candlestick_1m(spark, sf_dir):
    return candles.candlestick(replay.ticks_dense(spark, sf_dir))


@query
def candlestick_1s(spark, sf_dir):
    return candles.candlestick(replay.ticks_dense(spark, sf_dir), "1 second")


@query
def atr_14(spark, sf_dir):
    return six(candles.atr(candles.candles_1m(replay.ticks_dense(spark, sf_dir))), "atr_14")


# returns and volatility


@query
def tick_returns(spark, sf_dir):
    moved = returns.tick_returns(replay.ticks(spark, sf_dir))
    return six(moved, "delta", "delta_pct").select("event_id", "benchmark", "price", "prev_price", "delta", "delta_pct")


@query
def rolling_vol_30(spark, sf_dir):
    vol = returns.rolling_vol(replay.ticks(spark, sf_dir))
    return six(vol, "rolling_std_30").select("event_id", "time", "benchmark", "rolling_std_30")


@query
def rolling_std_1m(spark, sf_dir):
    return six(returns.rolling_std_1m(replay.ticks_dense(spark, sf_dir)), "rolling_std_1m")


@query
def session_vwap(spark, sf_dir):
    vwap = returns.session_vwap(replay.ticks(spark, sf_dir))
    return six(vwap, "session_vwap").select("event_id", "time", "benchmark", "session_vwap")


@query
def volatility_sampled(spark, sf_dir):
    sampled = returns.volatility_sampled(replay.ticks_dense(spark, sf_dir))
    return six(sampled, "rolling_std_30").select("event_id", "seq", "time", "benchmark", "rolling_std_30")


@query
def volatility_1m_avg(spark, sf_dir):
    sampled = returns.volatility_sampled(replay.ticks_dense(spark, sf_dir))
    return six(returns.volatility_1m_avg(sampled.where(F.col("benchmark") == "WTI")), "volatility")


@query
def realized_vol_1h(spark, sf_dir):
    return returns.realized_vol(replay.ticks_dense(spark, sf_dir))


# joins along time


@query
def asof_spread(spark, sf_dir):
    return six(asof.asof_spread(replay.ticks(spark, sf_dir)), "spread")


@query
def latest_spread(spark, sf_dir):
    return six(asof.latest_spread(replay.ticks(spark, sf_dir)), "value")


@query
def spread_heatmap(spark, sf_dir):
    return six(asof.spread_heatmap(replay.ticks_sync(spark, sf_dir)), "wti_brent_spread")


@query
def stream_spread_5m(spark, sf_dir):
    rows = asof.spread_5m(replay.ticks_dense(spark, sf_dir))
    return six(rows, "wti_brent_spread", "brent_dubai_spread", "wti_dubai_spread")


@query
def enrich_benchmark(spark, sf_dir):
    rich = quotes.enrich_benchmark(replay.ticks(spark, sf_dir))
    return rich.select("event_id", "benchmark", "market_exchange", "market_region", "base_price", "sigma")


# alerts


def _alert_rows(found: DataFrame) -> DataFrame:
    return six(found, "delta", "delta_pct")


@query
def alerts_price_move(spark, sf_dir):
    return _alert_rows(alerts.alerts_price_move(replay.ticks(spark, sf_dir)))


@query
def alerts_spread(spark, sf_dir):
    return _alert_rows(alerts.alerts_spread(replay.ticks(spark, sf_dir)))


@query
def alerts_volatility(spark, sf_dir):
    return _alert_rows(alerts.alerts_volatility(replay.ticks_raw_price(spark, sf_dir)))


@query
def alerts_all(spark, sf_dir):
    return _alert_rows(alerts.alerts_all(replay.ticks_raw_price(spark, sf_dir)))


@query
def alert_frequency(spark, sf_dir):
    return alerts.alert_frequency(alerts.alerts_all(replay.ticks(spark, sf_dir)))


@query
def alert_history(spark, sf_dir):
    return _alert_rows(alerts.newest_alerts(alerts.alerts_all(replay.ticks_raw_price(spark, sf_dir)), 100))


@query
def recent_alerts(spark, sf_dir):
    return dashboard.recent_alerts(alerts.alerts_all(replay.ticks(spark, sf_dir)))


@query
def alerts_json(spark, sf_dir):
    messages = alerts.alert_messages(alerts.alerts_all(replay.ticks(spark, sf_dir)))
    names = alerts.ALERT_COLUMNS
    parsed = messages.select("key", F.from_json("value", ", ".join(f"{n} {k}" for n, k in zip(names, _ALERT_KINDS))).alias("m"))
    return six(parsed.select("key", "m.*"), "delta", "delta_pct")


_ALERT_KINDS = ["string", "string", "string", "double", "double", "double", "string", "string"]


# quotes


@query
def derive_quotes(spark, sf_dir):
    base = replay.ticks_raw_price(spark, sf_dir).select("event_id", "benchmark", "price", "volume")
    market = base.withColumn("open_interest", F.col("price") * F.col("volume") * 100)
    return quotes.derive_quotes(quotes.clamp_market(market))


@query
def price_band(spark, sf_dir):
    return quotes.price_band(replay.ticks_raw_price(spark, sf_dir)).select("event_id", "price", "band")


# live views


@query
def live_prices(spark, sf_dir):
    return live.live_prices(replay.ticks(spark, sf_dir))


@query
def live_prices_ttl(spark, sf_dir):
    return live.live_prices(replay.ticks_dense(spark, sf_dir), datetime(2024, 1, 1, 12, 0, 0))


@query
def live_series_1h(spark, sf_dir):
    return live.live_series(replay.ticks_dense(spark, sf_dir))


@query
def series_tail(spark, sf_dir):
    return live.series_tail(live.live_series(replay.ticks_dense(spark, sf_dir)))


@query
def tick_updates(spark, sf_dir):
    events = live.tick_updates(replay.ticks(spark, sf_dir))
    parsed = F.from_json("value", "benchmark string, price double, vwap double, ts string").alias("m")
    return events.select("event_id", "key", parsed).select("event_id", "key", "m.*")


# dashboard


@query
def latest_price(spark, sf_dir):
    return dashboard.latest_price(replay.ticks(spark, sf_dir), "WTI")


@query
def latest_ticks(spark, sf_dir):
    return dashboard.latest_ticks(replay.ticks(spark, sf_dir))


@query
def latest_candles(spark, sf_dir):
    return six(dashboard.latest_candles(candles.candles_1m(replay.ticks_dense(spark, sf_dir))), "vwap")


# the newest rows of stored tables


@once_a_session
def _stored(spark: SparkSession, sf_dir: str, view=replay.ticks) -> stored.StoredTables:
    root = scratch_path(spark, "lake")
    maintenance.backfill(view(spark, sf_dir), root)
    return stored.StoredTables(spark, root)


@query
def stored_latest_price(spark, sf_dir):
    return _stored(spark, sf_dir).latest_price("WTI")


@query
def stored_latest_ticks(spark, sf_dir):
    return _stored(spark, sf_dir).latest_ticks()


@query
def stored_latest_candles(spark, sf_dir):
    return six(_stored(spark, sf_dir, replay.ticks_dense).latest_candles(), "vwap")


@query
def stored_recent_alerts(spark, sf_dir):
    return _stored(spark, sf_dir).recent_alerts()


@query
def stored_alert_history(spark, sf_dir):
    return _alert_rows(_stored(spark, sf_dir, replay.ticks_raw_price).alert_history())


@query
def price_history(spark, sf_dir):
    return six(dashboard.price_history(replay.ticks_dense(spark, sf_dir), DENSE_START, DENSE_END), "price")


@query
def vwap_vs_price(spark, sf_dir):
    return six(dashboard.vwap_vs_price(candles.candles_1m(replay.ticks_dense(spark, sf_dir))), "vwap")


@query
def hourly_vwap_recent(spark, sf_dir):
    return six(dashboard.hourly_vwap_of_ticks(replay.ticks(spark, sf_dir), AS_OF), "vwap")


@query
def minute_summary(spark, sf_dir):
    return six(dashboard.minute_summary(replay.ticks_dense(spark, sf_dir), DENSE_END, 12), "avg_price")


@query
def tick_count(spark, sf_dir):
    return dashboard.tick_count(replay.ticks(spark, sf_dir))


# data quality


@query
def dq_not_null(spark, sf_dir):
    ticks = replay.ticks(spark, sf_dir)
    staged = _staged(spark, sf_dir)
    checked = {
        "ticks": ticks,
        "candles": candles.candles_1m(replay.ticks_dense(spark, sf_dir)),
        "alerts": alerts.alerts_all(ticks),
        "staged": staged,
        "daily": marts.daily_analytics(staged),
        "spread": marts.spread_analysis(staged),
    }
    out = None
    for table, df in checked.items():
        rows = quality.not_null(df, table)
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def dq_accepted_values(spark, sf_dir):
    ticks = replay.ticks_raw_price(spark, sf_dir)
    return quality.accepted_values(ticks, "ticks").unionByName(quality.accepted_values(alerts.alerts_all(ticks), "alerts"))


@query
def dq_range(spark, sf_dir):
    return quality.accepted_range(replay.ticks_raw_price(spark, sf_dir), "ticks")


@query
def dq_unique(spark, sf_dir):
    """The daily mart has no copies; ticks cut to the minute do."""
    mart = quality.unique(marts.daily_analytics(_staged(spark, sf_dir)), ["day_bucket", "benchmark"])
    minutes = quality.unique(replay.ticks_sync(spark, sf_dir), ["time", "benchmark"])
    return mart.withColumnRenamed("day_bucket", "time").unionByName(minutes)


# messages


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick messages of which some are cut off, some lack benchmark and time, some the price."""
    sent = decode.publish_ticks(replay.ticks_dense(spark, sf_dir))
    n, text = F.col("event_id"), F.col("value")
    no_key = F.regexp_replace(F.regexp_replace(text, '"event_time":[0-9]+,', ""), '"benchmark":"[A-Z_]+",', "")
    damaged = (
        F.when(n % 13 == 0, F.substring(text, 1, 40))
        .when(n % 7 == 0, no_key)
        .when(n % 11 == 0, F.regexp_replace(text, '"price":[0-9.]+,', ""))
        .otherwise(text)
    )
    return sent.select("event_id", damaged.alias("value"))


def _unzoned(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns or ("time",)})


@query
def decode_ticks_json(spark, sf_dir):
    return _unzoned(decode.good_ticks(decode.decode_ticks(_messages(spark, sf_dir))))


@query
def dead_letters(spark, sf_dir):
    return decode.dead_letters(decode.decode_ticks(_messages(spark, sf_dir))).select("event_id", "fault")


@query
def publish_ticks(spark, sf_dir):
    sent = decode.publish_ticks(replay.ticks_dense(spark, sf_dir))
    fields = "event_time bigint, benchmark string, exchange string, price double, volume double, bid double, source string, region string"
    return sent.select("event_id", "key", F.from_json("value", fields).alias("m")).select("event_id", "key", "m.*")


@query
def feed_adapter(spark, sf_dir):
    ticks = replay.ticks(spark, sf_dir)
    trade = F.struct(
        F.col("price").cast("string").alias("tradePrice"),
        F.col("volume").alias("tradeQuantity"),
        F.unix_millis(F.col("time").cast("timestamp")).alias("timestamp"),
    )
    trades = ticks.select("event_id", F.to_json(trade).alias("value"))
    return _unzoned(decode.feed_adapter(trades, "WTI", "NYMEX"))


@query
def candles_1m_json(spark, sf_dir):
    messages = processor.candle_messages(candles.candles_1m(replay.ticks_dense(spark, sf_dir)))
    fields = (
        "time string, benchmark string, open double, high double, low double, close double, "
        "volume double, vwap double, tick_count int"
    )
    return six(messages.select("key", F.from_json("value", fields).alias("m")).select("key", "m.*"), "vwap")


def _five_minute_fields(messages: DataFrame) -> DataFrame:
    fields = (
        "benchmark string, window_start bigint, window_end bigint, open double, high double, low double, "
        "close double, volume double, vwap double, tick_count bigint"
    )
    return messages.select(F.from_json("value", fields).alias("m")).select("m.*")


@query
def candles_5m_json(spark, sf_dir):
    return _five_minute_fields(candles.five_minute_messages(candles.candles_5m(replay.ticks_dense(spark, sf_dir))))


# tables and upkeep


@query
def insert_ignore(spark, sf_dir):
    ticks = replay.ticks_sync(spark, sf_dir).select("event_id", "time", "benchmark", "price")
    stored = ticks.where(F.col("time") < F.lit("2024-01-01 04:00:00").cast("timestamp_ntz"))
    return maintenance.insert_ignore(ticks, stored, ["time", "benchmark"])


@query
def write_partitioned(spark, sf_dir):
    ticks = replay.ticks(spark, sf_dir)
    path = scratch_path(spark, "ticks")
    write_table(ticks, path, LAYOUTS["ticks"], "overwrite")
    return read_table(spark, path, ticks.schema, LAYOUTS["ticks"], start=datetime(2024, 1, 8), benchmark="BRENT")


def _compacted(spark, sf_dir, *parts: str):
    """Batches of the ticks by the given conditions, and a compaction after each but the last."""
    ticks = replay.ticks(spark, sf_dir)
    hot, cold = scratch_path(spark, "hot"), scratch_path(spark, "cold")
    for batch, part in enumerate(parts):
        write_batch(ticks.where(part), hot, batch)
        if batch < len(parts) - 1:
            maintenance.compact(spark, hot, cold, ticks.schema, AS_OF)
    return hot, cold, ticks.schema


@query
def compact(spark, sf_dir):
    """All rows, the old ones from one compaction."""
    hot, cold, schema = _compacted(spark, sf_dir, "event_id >= 0", "event_id < 0")
    return maintenance.read_hot_and_cold(spark, hot, cold, schema)


@query
def compact_late_rows(spark, sf_dir):
    """All rows with the place they are read from: late ones of compacted dates wait in the batches."""
    hot, cold, schema = _compacted(spark, sf_dir, "event_id % 10 > 1", "event_id % 10 = 1", "event_id % 10 = 0")
    return maintenance.read_hot_and_cold(spark, hot, cold, schema, origin="stored")


@query
def storage_report(spark, sf_dir):
    """Per date: fewer and smaller files after the compaction, none left in the batches, rows before and after."""
    ticks = replay.ticks(spark, sf_dir)
    hot, cold = scratch_path(spark, "hot"), scratch_path(spark, "cold")
    for batch in range(4):
        write_batch(ticks.where(F.col("event_id") % 4 == batch), hot, batch)
    rows = spark.read.parquet(hot).groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("rows_before"))
    before = [lookup(df) for df in (maintenance.storage_report(spark, hot), rows)]
    maintenance.compact(spark, hot, cold, ticks.schema, AS_OF)
    report = maintenance.compaction_report(before[0], maintenance.storage_report(spark, cold))
    left = maintenance.storage_report(spark, hot).select("date", F.lit(True).alias("waiting"))
    after = spark.read.parquet(cold).groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("rows_after"))
    joined = report.join(before[1], "date").join(after, "date", "left").join(left, "date", "left")
    return joined.select(
        "date", "rows_before", F.coalesce("rows_after", F.lit(0)).alias("rows_after"),
        F.coalesce(F.col("files_after") < F.col("files_before"), F.lit(False)).alias("fewer_files"),
        F.coalesce(F.col("bytes_after") > 0, F.lit(False)).alias("compacted"), F.coalesce("waiting", F.lit(False)).alias("waiting"),
    )


@query
def retained_ticks(spark, sf_dir):
    return maintenance.retained_ticks(replay.ticks(spark, sf_dir), datetime(2024, 2, 10))


def _refreshed(spark, sf_dir, rollup, until, as_of, **reach):
    """A rollup stored at one moment and refreshed at a later one."""
    ticks = replay.ticks(spark, sf_dir)
    path = scratch_path(spark, "rollup")
    early = rollup(ticks.where(F.col("time") < F.lit(str(until)).cast("timestamp_ntz")))
    rollups.write_rollup(early, path)
    rollups.refresh_rollup(ticks, path, as_of, rollup, **reach)
    return rollups.read_rollup(spark, path, early.schema).drop("date")


@query
def refresh_rollup(spark, sf_dir):
    stored = _refreshed(spark, sf_dir, rollups.rollup_hourly, datetime(2024, 1, 20, 10, 30), datetime(2024, 1, 20, 12, 30))
    return six(stored, "vwap")


@query
def refresh_rollup_daily(spark, sf_dir):
    stored = _refreshed(
        spark, sf_dir, rollups.rollup_daily, datetime(2024, 1, 20, 10, 30), datetime(2024, 1, 22, 12, 30),
        reach=rollups.DAILY_REFRESH, width=rollups.DAY,
    )
    return six(stored, "vwap", "daily_volatility")


@query
def build_models(spark, sf_dir):
    """Rows of all three models, as they were published."""
    maintenance.build_models(replay.ticks(spark, sf_dir), AS_OF, "built_", scratch_path(spark, "models"))

    def shown(model: str, time: str, name, *values: str) -> DataFrame:
        one, two = (rounded(F.col(v), 4) for v in values)
        return spark.table(f"built_{model}").select(
            F.lit(model).alias("model"), F.col(time).cast("string").alias("time"), name.alias("name"), one.alias("one"), two.alias("two")
        )

    name = F.col("benchmark")
    daily = shown("daily_analytics", "day_bucket", name, "close", "price_change")
    spread = shown("spread_analysis", "hour_bucket", F.col("spread_regime"), "wti_brent_spread", "wti_dubai_spread")
    return daily.unionByName(spread).unionByName(shown("stg_ticks", "tick_time", name, "price", "volume"))


@query
def backfill(spark, sf_dir):
    """The contents of all tables after a rebuild from stored ticks, over an earlier rebuild of fewer ticks."""
    root, ticks = scratch_path(spark, "lake"), replay.ticks_dense(spark, sf_dir)
    maintenance.backfill(ticks.where("event_id % 3 = 0"), root)
    maintenance.backfill(ticks, root)
    tables = stored.StoredTables(spark, root)
    values = {
        "ticks": ("price", "volume"), "candles_1m": ("close", "vwap"), "candles_5m": ("close", "vwap"),
        "alerts": ("price", "delta"), "volatility": ("rolling_std_30", "realized_vol"),
    }
    out = None
    for name, (one, two) in values.items():
        rows = tables.rows(name).select(
            F.lit(name).alias("table_name"), "time", "benchmark", rounded(F.col(one), 5).alias("one"), rounded(F.col(two), 5).alias("two")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


# streams: the events table read as a stream, until it is used up


def _zoned(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("time", F.col("time").cast("timestamp"))


#: Micro-batches of a replay.
BATCHES = 4


def _in_batches(ticks: DataFrame, run) -> None:
    """Let `run` use up a stream of the ticks that grows by one of BATCHES parts, by event_id, before each start."""
    spark = ticks.sparkSession
    staged, feed = scratch_path(spark, "staged"), scratch_path(spark, "feed")
    ticks = _zoned(ticks).select(*TICK.names)
    borders = ticks.approxQuantile("event_id", [i / BATCHES for i in range(1, BATCHES)], 0.01)
    part = F.lit(0)
    for border in borders:
        part = part + (F.col("event_id") >= border).cast("int")
    ticks.withColumn("part", part).write.partitionBy("part").parquet(staged)
    parts = spark.read.schema(StructType([*TICK.fields]).add("part", "integer")).parquet(staged)
    for number in range(BATCHES):
        parts.where(F.col("part") == number).drop("part").write.mode("append").parquet(feed)
        run(streams.read_tick_files(spark, feed, files_per_trigger=None))


def _drained(ticks: DataFrame, windowed, label: str) -> DataFrame:
    """Run a stream of closed windows to its end, in batches with a restart after each, and read what it wrote."""
    spark = ticks.sparkSession
    path, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    kinds = []

    def run(source: DataFrame) -> None:
        df = windowed(source)
        kinds.append(df.schema)
        sink = df.writeStream.outputMode("append").format("parquet").option("path", path)
        with state.state_partitions(spark):
            running = sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        running.awaitTermination()

    _in_batches(ticks, run)
    return spark.read.schema(kinds[-1]).parquet(path)


@query
def replay_candles_5m(spark, sf_dir):
    return _drained(replay.ticks_dense(spark, sf_dir), windows.candles_5m, "candles_5m")


@query
def replay_spread_5m(spark, sf_dir):
    rows = _unzoned(_drained(replay.ticks_dense(spark, sf_dir), windows.spread_5m, "spread_5m"))
    return six(rows, "wti_brent_spread", "brent_dubai_spread", "wti_dubai_spread")


@query
def replay_realized_vol(spark, sf_dir):
    rows = _drained(replay.ticks_dense(spark, sf_dir), windows.realized_vol, "realized_vol")
    return _unzoned(rows, "window_start", "window_end")


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jittered feed; event_id is the position of arrival."""
    ticks = replay.with_arrival(replay.ticks_dense(spark, sf_dir))
    numbered = with_sequence(with_chunk(ticks, ARRIVAL_ORDER), ARRIVAL_ORDER)
    return numbered.withColumn("event_id", F.col("seq").cast("long"))


@once_a_session
def _processed(spark: SparkSession, sf_dir: str, view=replay.ticks_dense) -> processor.TickProcessor:
    """The processor after the ticks came in BATCHES parts, by arrival, with a restart after each."""
    root, checkpoint = scratch_path(spark, "processed"), scratch_path(spark, "processor-checkpoint")
    run = processor.TickProcessor(spark, root)
    _in_batches(view(spark, sf_dir), lambda source: run.start(source, checkpoint, {"availableNow": True}).awaitTermination())
    return run


@query
def replay_ticks(spark, sf_dir):
    return _unzoned(_processed(spark, sf_dir).read("ticks"))


@query
def replay_candles_1m(spark, sf_dir):
    return six(_unzoned(_processed(spark, sf_dir).read("candles_1m")), "vwap")


@query
def replay_alerts(spark, sf_dir):
    return _alert_rows(_unzoned(_processed(spark, sf_dir, replay.ticks_raw_price).read("alerts")))


@query
def replay_volatility(spark, sf_dir):
    return six(_unzoned(_processed(spark, sf_dir).read("volatility")), "rolling_std_30")


@query
def replay_live_prices(spark, sf_dir):
    return _processed(spark, sf_dir).live().drop("time")


@query
def replay_series_1h(spark, sf_dir):
    return _unzoned(_processed(spark, sf_dir).series())


@query
def replay_alert_history(spark, sf_dir):
    return _alert_rows(_unzoned(_processed(spark, sf_dir, replay.ticks_raw_price).alert_history()))


@query
def replay_updates(spark, sf_dir):
    fields = "benchmark string, price double, vwap double, ts string"
    sent = _processed(spark, sf_dir).topic(processor.UPDATE_TOPIC)
    return sent.select("key", F.from_json("value", fields).alias("m")).select("key", "m.*")


@query
def replay_vwap(spark, sf_dir):
    sent = _processed(spark, sf_dir).topic(processor.VWAP_TOPIC)
    return sent.select("key", F.from_json("value", "benchmark string, vwap double, time string").alias("m")).select("key", "m.*")


@query
def replay_candles_5m_json(spark, sf_dir):
    root, checkpoint = scratch_path(spark, "processed"), scratch_path(spark, "five-minute-checkpoint")
    run = processor.FiveMinutePublisher(spark, root)
    _in_batches(
        replay.ticks_dense(spark, sf_dir), lambda source: run.start(source, checkpoint, {"availableNow": True}).awaitTermination()
    )
    return _five_minute_fields(run.messages())


@query
def replay_candles_1m_arrival(spark, sf_dir):
    return six(_unzoned(_processed(spark, sf_dir, _arriving).read("candles_1m")), "vwap")


@query
def replay_alerts_arrival(spark, sf_dir):
    return _alert_rows(_unzoned(_processed(spark, sf_dir, _arriving).read("alerts")))
