"""Streams against the same operators on the whole table, over several micro-batches."""

from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tickloom.operators import alerts, asof, candles, returns
from tickloom.plans import live
from tickloom.sources import decode, replay, streams
from tickloom.streaming import processor, state, windows

PARTS = 4


@pytest.fixture(scope="module")
def ticks(spark):
    dense = replay.ticks_dense(spark, SMALL)
    return dense.withColumn("time", F.col("time").cast("timestamp")).cache()


@pytest.fixture(scope="module")
def folder(spark, ticks, tmp_path_factory):
    """The ticks as four files in time order."""
    path = str(tmp_path_factory.mktemp("ticks"))
    size = ticks.count() // PARTS
    for part in range(PARTS):
        inside = F.col("event_id").between(part * size, (part + 1) * size - 1)
        ticks.where(inside).coalesce(1).write.mode("append").parquet(path)
    return path


def drain(df, out, checkpoint):
    writer = df.writeStream.outputMode("append").format("parquet").option("path", out)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def assert_same(found, want, *inexact):
    columns = sorted(want.columns)
    tidy = [F.round(c, 9).alias(c) if c in inexact else F.col(c) for c in columns]
    a, b = found.select(tidy), want.select(tidy)
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def newest(ticks):
    return ticks.agg(F.max("time") - F.expr("interval 5 seconds")).first()[0]


def test_five_minute_candles(spark, ticks, folder, tmp_path):
    found = drain(windows.candles_5m(streams.read_tick_files(spark, folder)), f"{tmp_path}/out", f"{tmp_path}/ck")
    limit = ticks.agg(F.unix_millis(F.max("time")) - 5000).first()[0]
    assert_same(found, candles.candles_5m(ticks).where(F.col("window_end") <= limit))


def test_five_minute_spread(spark, ticks, folder, tmp_path):
    found = drain(windows.spread_5m(streams.read_tick_files(spark, folder)), f"{tmp_path}/out", f"{tmp_path}/ck")
    end = F.col("time") + F.expr("interval 5 minutes")
    assert_same(found, asof.spread_5m(ticks).where(end <= F.lit(newest(ticks))))


def test_realized_volatility(spark, ticks, folder, tmp_path):
    """Two stateful steps in one stream, over four batches."""
    found = drain(windows.realized_vol(streams.read_tick_files(spark, folder)), f"{tmp_path}/out", f"{tmp_path}/ck")
    assert_same(found, returns.realized_vol(ticks).where(F.col("window_end") <= F.lit(newest(ticks))))


@pytest.fixture(scope="module")
def processed(spark, folder, tmp_path_factory):
    """The processor stopped after two batches and started again."""
    root, checkpoint = (str(tmp_path_factory.mktemp(n)) for n in ("out", "ck"))
    source = streams.read_tick_files(spark, folder)
    run = processor.TickProcessor(spark, root)
    first = run.start(source, checkpoint, {"processingTime": "0 seconds"})
    while not (first.lastProgress and first.lastProgress["batchId"] >= 1):
        first.awaitTermination(1)
    first.stop()
    run.start(source, checkpoint, {"availableNow": True}).awaitTermination()
    return run


def test_processor_equals_the_table_operators(spark, ticks, processed):
    assert processed.committed() >= PARTS - 1
    assert_same(processed.read("ticks"), ticks)
    assert_same(processed.read("candles_1m"), candles.candles_1m(ticks), "vwap")
    assert_same(processed.read("alerts"), alerts.alerts_all(ticks), "delta", "delta_pct")
    sampled = returns.volatility_sampled(ticks).select("time", "benchmark", "rolling_std_30")
    assert_same(processed.read("volatility").select(*sampled.columns), sampled, "rolling_std_30")


def test_processor_live_views(spark, ticks, processed):
    assert_same(processed.live().drop("time"), live.live_prices(ticks))
    assert_same(processed.series(), live.live_series(ticks))
    assert_same(processed.alert_history(), alerts.newest_alerts(alerts.alerts_all(ticks), 100), "delta", "delta_pct")
    late = ticks.agg(F.max("time")).first()[0]
    assert processed.live(late + timedelta(seconds=1)).count() == live.live_prices(ticks, late + timedelta(seconds=1)).count() > 0
    assert processed.live(late + timedelta(days=1)).count() == 0


def test_the_rolling_hour_is_dropped_in_whole_stretches(spark, ticks, processed):
    # each benchmark's hour counts from its own newest tick
    late = ticks.groupBy("benchmark").agg(F.max("time").alias("time")).agg(F.min("time")).first()[0]
    stored = spark.read.parquet(f"{processed.root}/series")
    before, files = stored.count(), set(stored.inputFiles())
    processed.expire_series(late)
    left = spark.read.parquet(f"{processed.root}/series")
    assert left.count() < before and set(left.inputFiles()) < files
    assert_same(processed.series(), live.live_series(ticks))


def test_processor_topics(spark, ticks, processed):
    assert_same(processed.topic(processor.ALERT_TOPIC), alerts.alert_messages(alerts.alerts_all(ticks)))
    assert processed.topic(processor.CANDLE_TOPIC).count() == candles.candles_1m(ticks).count()
    assert processed.topic(processor.UPDATE_TOPIC).count() == ticks.count()


def streamed(spark, full, borders, rows, path):
    """The processor after batches that end at the given event ids, with a restart after each."""
    run = processor.TickProcessor(spark, f"{path}/out")
    for low, high in zip([0, *borders], [*borders, rows]):
        part = full.where(f"event_id >= {low} and event_id < {high}")
        part.coalesce(1).write.mode("append").parquet(f"{path}/in")
        source = streams.read_tick_files(spark, f"{path}/in", files_per_trigger=None)
        run.start(source, f"{path}/ck", {"availableNow": True}).awaitTermination()
    return run


def stream_ticks(rows):
    return rows.selectExpr("*", "1D bid", "2D ask", "'s' source").withColumn("time", F.col("time").cast("timestamp"))


def test_a_failed_batch_leaves_nothing_visible(spark, make_ticks, tmp_path, monkeypatch):
    """The second batch fails after some of its outputs are written; it is run again and counts once."""
    rows = [(30 * i, ("WTI", "BRENT")[i % 3 == 1], 80 + (i * 7) % 5 * 1.5) for i in range(24)]
    full = stream_ticks(make_ticks(rows))
    run = streamed(spark, full, [], 12, tmp_path)
    before = {n: run.read(n).collect() for n in ("ticks", "alerts", "candles_1m", "volatility")}
    right = processor.TickProcessor.write_alerts

    def broken(self, *args):
        right(self, *args)
        raise OSError("lost")

    full.where("event_id >= 12").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = streams.read_tick_files(spark, f"{tmp_path}/in", files_per_trigger=None)
    monkeypatch.setattr(processor.TickProcessor, "write_alerts", broken)
    with pytest.raises(Exception, match="lost"):
        run.start(source, f"{tmp_path}/ck", {"availableNow": True}).awaitTermination()
    written = spark.read.parquet(f"{run.root}/alerts").count()
    assert written > len(before["alerts"])  # the failed batch did write
    assert {n: run.read(n).collect() for n in before} == before
    monkeypatch.setattr(processor.TickProcessor, "write_alerts", right)
    run.start(source, f"{tmp_path}/ck", {"availableNow": True}).awaitTermination()
    assert_same(run.read("ticks").select("event_id"), full.select("event_id"))
    assert_same(run.read("alerts"), alerts.alerts_all(full, ("event_id",)), "delta", "delta_pct")


@pytest.mark.parametrize("borders", [[2], [], [1, 2, 3]])
def test_late_tick_folds_into_the_open_candle(spark, make_ticks, tmp_path, borders):
    """A tick from before the open candle, wherever the batches end."""
    rows = make_ticks([(5, "WTI", 80), (65, "WTI", 81), (30, "WTI", 90), (130, "WTI", 82)])
    run = streamed(spark, stream_ticks(rows), borders, 4, tmp_path)
    found = run.read("candles_1m").orderBy("time").collect()
    assert [(r["open"], r["high"], r["close"], r["tick_count"]) for r in found] == [(80.0, 80.0, 80.0, 1), (81.0, 90.0, 90.0, 2)]


@pytest.mark.parametrize("borders", [[7], [2, 3, 11]])
def test_alerts_do_not_depend_on_where_batches_end(spark, make_ticks, tmp_path, borders):
    """Late ticks, as they arrive, against the table operators in the order of arrival."""
    rows = make_ticks([(60 * i - 200 * (i % 3 == 2), ("WTI", "BRENT")[i % 4 == 1], 80 + (i * 7) % 5 * 1.5) for i in range(16)])
    full = stream_ticks(rows)
    run = streamed(spark, full, borders, 16, tmp_path)
    assert_same(run.read("alerts"), alerts.alerts_all(full, ("event_id",)), "delta", "delta_pct")
    assert_same(run.live().drop("time"), live.live_prices(full, order_by=("event_id",)))


def test_stored_points_do_not_grow_with_the_time_of_a_batch(spark, make_ticks, tmp_path):
    """A batch of two days stores each benchmark's last hour alone; points from before it come in no series."""
    rows = make_ticks([(1800 * i - (7200 if i % 7 == 3 else 0), ("WTI", "BRENT")[i % 3 == 1], 80 + i % 5) for i in range(96)])
    full = stream_ticks(rows)
    run = streamed(spark, full, [60], 96, tmp_path)
    assert spark.read.parquet(f"{run.root}/series").select("stretch", "batch_id").distinct().count() <= 2 * 2 * 3
    assert_same(run.series(), live.live_series(full))
    assert_same(run.series(600), live.live_series(full, 600))
    with pytest.raises(ValueError, match="3600"):
        run.series(7200)
    assert run.read("ticks").count() == 96  # the ticks themselves are all stored


def test_ticks_reach_the_state_in_few_rows(spark):
    """Spark hands rows to a processor one by one, so a batch's ticks of a benchmark come as one row of arrays."""
    big = 2**60 + 1
    rows = spark.range(3000, -1, -1, 1).selectExpr(
        f"if(id = 7, null, id + {big}) event_id", "if(id = 9, null, timestamp_micros(id)) time", "nullif(concat('B', id % 3), 'B2') benchmark",
        "if(id % 5 = 0, null, 'X') exchange", "if(id % 4 = 0, null, double(id)) price", "1D volume", "1D bid", "2D ask", "string(null) source",
    )
    lists = state.packed(rows, state._TICK_FIELDS).toPandas()
    assert sorted(lists["benchmark"].fillna("-")) == ["-", "B0", "B1"]
    found = state.unpacked(iter([lists[lists["benchmark"] == "B0"]]), state._TICK_FIELDS)
    ids = [i for i in range(0, 3001, 3)]
    assert found["event_id"].tolist() == [i + big for i in ids]
    assert found["time_us"].tolist() == [state.NO_TIME if i == 9 else i for i in ids]
    assert found["exchange"].tolist() == [None if i % 5 == 0 else "X" for i in ids]
    assert [None if np.isnan(p) else p for p in found["price"]] == [None if i % 4 == 0 else float(i) for i in ids]
    other = state.unpacked(iter([lists[lists["benchmark"] == "B1"]]), state._TICK_FIELDS)["event_id"]  # one is missing
    assert other.iloc[0] == big + 1 and pd.isna(other.iloc[-1]) and len(other) == 1000


class Held:
    """A state variable of one key."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    put = update


class Handle:
    def getListState(self, *_):
        return Held()

    getValueState = getListState


def test_the_state_gives_its_rows_in_blocks(monkeypatch):
    """No Arrow batch that leaves the state holds a whole micro-batch."""
    monkeypatch.setattr(state, "BLOCK", 4)
    ids = np.arange(10)
    parts = [
        pd.DataFrame({
            "benchmark": name, "event_id": [2 * ids + at], "time_us": [ids * 30_000_000], "exchange": [np.full(10, "X", object)],
            "price": [80.0 + ids], "volume": [np.ones(10)], "bid": [np.ones(10)], "ask": [np.ones(10)], "source": [np.full(10, None)],
        })
        for at, name in enumerate(("WTI", "BRENT"))
    ]
    own, pair = state.TickState(), state.PairState()
    own.init(Handle())
    pair.init(Handle())
    found = list(own.handleInputRows(("WTI",), iter(parts[:1]), None))
    assert [(f["kind"].iloc[0], len(f)) for f in found] == [("tick", 4), ("tick", 4), ("tick", 2), ("candle", 4)]
    both = list(pair.handleInputRows(("WTI/BRENT",), iter(parts), None))
    assert [len(f) for f in both] == [4, 4, 2]
    assert pd.concat(both)["brent_price"].tolist()[1:] == [80.0 + i for i in range(9)]


def test_windows_drop_what_the_watermark_passed(spark, make_ticks, tmp_path):
    """The late tick comes one batch after its window was closed; Spark filters by the batch before."""
    rows = make_ticks([(10, "WTI", 80), (700, "WTI", 81), (1400, "WTI", 82), (20, "WTI", 99)])
    full = rows.selectExpr("*", "1D bid", "2D ask", "'s' source").withColumn("time", F.col("time").cast("timestamp"))
    for part in ("event_id < 2", "event_id = 2", "event_id = 3"):
        full.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = streams.read_tick_files(spark, f"{tmp_path}/in")
    found = drain(windows.candles_5m(source), f"{tmp_path}/out", f"{tmp_path}/ck").orderBy("window_start").collect()
    assert [(r["high"], r["tick_count"]) for r in found] == [(80.0, 1), (81.0, 1)]


def test_bad_messages_leave_the_stream_running(spark, ticks, tmp_path):
    good = decode.publish_ticks(ticks).limit(3)
    bad = spark.createDataFrame([(7, "WTI", "{broken"), (8, "WTI", '{"price": 1}')], "event_id long, key string, value string")
    good.unionByName(bad).coalesce(1).write.parquet(f"{tmp_path}/in")
    decoded = decode.decode_ticks(streams.read_message_files(spark, f"{tmp_path}/in"))
    kept = drain(decode.good_ticks(decoded), f"{tmp_path}/good", f"{tmp_path}/ck1")
    dead = drain(decode.dead_letters(decoded), f"{tmp_path}/dead", f"{tmp_path}/ck2")
    assert kept.count() == 3
    assert {(r["event_id"], r["fault"]) for r in dead.collect()} == {(7, "unparsable"), (8, "incomplete")}
