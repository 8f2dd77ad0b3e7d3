"""Layouts, upkeep, decoding and the plans that carry them."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from tests.conftest import SMALL, START
from tickloom.functions.columns import order_key
from tickloom.operators import alerts, asof, candles, returns, rollups
from tickloom.plans import live, maintenance, marts, staging, stored
from tickloom.sources import decode, replay
from tickloom.sources.tables import (
    LAYOUTS,
    commit_batch,
    last_commit,
    read_batches,
    read_table,
    write_batch,
    write_table,
)


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 5000)
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table"))
    write_table(replay.ticks(spark, SMALL), path, LAYOUTS["ticks"], "overwrite")
    return path


def test_table_scan_prunes_partitions_and_pushes_filters(spark, table):
    schema = replay.ticks(spark, SMALL).schema
    rows = read_table(spark, table, schema, LAYOUTS["ticks"], datetime(2024, 1, 5), datetime(2024, 1, 6), "WTI")
    text = plan(rows.select("price"))
    assert "PartitionFilters: [isnotnull(date" in text and "space" in text.split("PartitionFilters")[1]
    assert "EqualTo(benchmark,WTI)" in text and "GreaterThanOrEqual(time" in text
    assert "ReadSchema: struct<time:timestamp_ntz,benchmark:string,price:double>" in text
    want = replay.ticks(spark, SMALL).where("benchmark = 'WTI'")
    assert rows.count() == staging.between(want, datetime(2024, 1, 5), datetime(2024, 1, 6)).count()


def test_staging_filter_reaches_the_scan(spark):
    text = plan(staging.stg_ticks(replay.ticks(spark, SMALL), datetime(2024, 1, 31)))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in text


def test_recent_hours_read_recent_ticks(spark):
    assert "GreaterThan(ts,2024-01-30T18:00)" in plan(QUERIES["hourly_vwap_recent"](spark, SMALL))


@pytest.mark.parametrize("operator", [asof.asof_spread, alerts.alerts_all, returns.rolling_vol, candles.candles_1m, live.live_state])
def test_no_pairwise_join_and_no_unbounded_key_window(spark, operator):
    text = plan(operator(replay.ticks(spark, SMALL)))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_ordered_scan_shuffles_the_rows_once(spark):
    ticks = replay.ticks(spark, SMALL)
    assert plan(alerts.alerts_all(ticks)).count("REPARTITION_BY_COL") == 1
    assert plan(returns.rolling_vol(ticks)).count("WindowGroupLimit") == 2


def test_rollups_aggregate_before_the_shuffle(spark):
    text = plan(candles.candles_5m(replay.ticks(spark, SMALL)))
    assert text.count("partial_max_by") == 1 and text.count("Exchange") == 1


def test_overwrite_replaces_only_its_partitions(spark, tmp_path):
    ticks = replay.ticks(spark, SMALL)
    write_table(ticks, str(tmp_path), LAYOUTS["candles_1m"], "overwrite")
    early = ticks.where(F.col("time") < F.lit("2024-01-04").cast("timestamp_ntz"))
    write_table(early, str(tmp_path), LAYOUTS["candles_1m"], "overwrite")
    kept = spark.read.parquet(str(tmp_path))
    assert {str(r["date"]) for r in kept.select("date").distinct().collect()} == {
        "2023-12-28", "2024-01-04", "2024-01-11", "2024-01-18", "2024-01-25",
    }
    assert kept.count() == ticks.count()


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_compaction_keeps_rows_in_fewer_files(spark, tmp_path):
    ticks = replay.ticks(spark, SMALL)
    hot, cold = f"{tmp_path}/hot", f"{tmp_path}/cold"
    for batch in range(4):
        write_batch(ticks.where(F.col("event_id") % 4 == batch), hot, batch)
    before = maintenance.storage_report(spark, hot).collect()
    as_of = datetime(2024, 1, 20)
    first = maintenance.compact(spark, hot, cold, ticks.schema, as_of - timedelta(days=3))
    assert first < maintenance.compact(spark, hot, cold, ticks.schema, as_of)
    assert maintenance.compact(spark, hot, cold, ticks.schema, as_of) is None
    found = spark.read.parquet(cold).select(*ticks.columns)
    want = ticks.where(F.col("time") < F.lit("2024-01-13").cast("timestamp_ntz"))
    assert same_rows(found, want)
    left = {r["date"]: r["files"] for r in maintenance.storage_report(spark, hot).collect()}
    after = {r["date"]: r["files"] for r in maintenance.storage_report(spark, cold).collect()}
    # what was taken is gone from the batches
    assert len(after) == 12 and not set(after) & set(left)
    assert all(after[r["date"]] < r["files"] for r in before if r["date"] in after)


def test_reader_has_all_rows_at_any_time(spark, tmp_path):
    """Late rows of compacted dates, before and after they are compacted, and a run that failed half-way."""
    ticks = replay.ticks(spark, SMALL)
    hot, cold = f"{tmp_path}/hot", f"{tmp_path}/cold"
    as_of = datetime(2024, 1, 20)
    read = lambda **k: maintenance.read_hot_and_cold(spark, hot, cold, ticks.schema, **k)
    write_batch(ticks.where("event_id % 10 > 0"), hot, 0)
    assert same_rows(read(), ticks.where("event_id % 10 > 0"))
    maintenance.compact(spark, hot, cold, ticks.schema, as_of)
    write_batch(ticks.where("event_id % 10 = 0 and event_id % 20 > 0"), hot, 1)
    write_batch(ticks.where("event_id % 20 = 0"), hot, 2)
    assert same_rows(read(), ticks)
    assert same_rows(read(until=1), ticks.where("event_id % 20 > 0"))
    # rows of a run that never came to its ledger entry
    stray = ticks.limit(50).withColumns({"date": F.to_date("time"), "space": F.lit(0), "run": F.lit(5).cast("long")})
    stray.write.mode("append").partitionBy("date", "space", "run").parquet(cold)
    assert same_rows(read(), ticks)
    assert maintenance.compact(spark, hot, cold, ticks.schema, as_of, until=1)
    assert same_rows(read(), ticks)
    assert maintenance.compact(spark, hot, cold, ticks.schema, as_of)
    assert same_rows(read(), ticks)
    dates = spark.read.parquet(hot).agg(F.min("date")).first()[0]
    assert str(dates) == "2024-01-13"


def test_batches_count_when_they_are_committed(spark, tmp_path):
    ticks, root = replay.ticks(spark, SMALL), str(tmp_path)
    assert last_commit(spark, root) == (-1, 0)
    for batch in range(7):
        write_batch(ticks.where(F.col("event_id") % 7 == batch), f"{root}/ticks", batch)
        if batch < 6:
            commit_batch(spark, root, batch, 100 * batch)
    assert last_commit(spark, root) == (5, 500) and last_commit(spark, root, before=5) == (4, 400)
    read = lambda **k: read_batches(spark, f"{root}/ticks", ticks.schema, last_commit(spark, root)[0], **k)
    assert same_rows(read().drop("date", "batch_id"), ticks.where("event_id % 7 < 6"))
    shown = plan(read(start=datetime(2024, 1, 8), end=datetime(2024, 1, 9)))
    assert "PartitionFilters: [isnotnull(batch_id" in shown and "date#" in shown.split("PartitionFilters")[1][:300]


def test_newest_rows_read_the_newest_dates_only(spark, make_ticks, tmp_path):
    days = [(86_400 * d + 60 * k, "WTI", 80 + d + k) for d in range(9) for k in range(1 if d > 6 else 5)]
    maintenance.backfill(make_ticks(days).selectExpr("*", "1D bid", "2D ask", "'s' source"), str(tmp_path))
    tables = stored.StoredTables(spark, str(tmp_path))
    for count, dates in ((1, 1), (2, 2), (7, 4), (8, 4), (40, 9)):
        found = tables.latest_ticks(count)
        want = sorted(days, reverse=True)[:count]
        assert [r["price"] for r in found.collect()] == [float(r[2]) for r in want]
        assert f">= {START.date() + timedelta(days=9 - dates)}" in plan(found).split("PartitionFilters")[1]


def test_retention_keeps_weeks_that_reach_into_the_retained_days(spark, tmp_path):
    ticks = replay.ticks(spark, SMALL)
    write_table(ticks, f"{tmp_path}/w", LAYOUTS["candles_1m"], "overwrite")
    spark.sql("DROP TABLE IF EXISTS weekly")
    spark.sql(f"CREATE TABLE weekly USING parquet LOCATION '{tmp_path}/w'")
    spark.sql("MSCK REPAIR TABLE weekly")
    as_of = datetime(2024, 2, 12)
    dropped = maintenance.drop_expired(spark, "weekly", as_of, layout=LAYOUTS["candles_1m"])
    assert dropped == ["2023-12-28", "2024-01-04"]
    kept = maintenance.retained_ticks(ticks, as_of)
    assert kept.select("event_id").exceptAll(spark.table("weekly").select("event_id")).count() == 0
    spark.sql("DROP TABLE weekly")


def test_backfill_replaces_whole_tables(spark, tmp_path):
    ticks = replay.ticks(spark, SMALL)
    maintenance.backfill(ticks, str(tmp_path))
    few = ticks.where(F.col("time") < F.lit("2024-01-10").cast("timestamp_ntz"))
    maintenance.backfill(few, str(tmp_path))
    assert stored.StoredTables(spark, str(tmp_path)).rows("ticks").count() == few.count()


def test_a_backfill_clusters_rows_that_were_computed_once(spark, make_ticks, tmp_path, monkeypatch):
    """What is cut into ranges is read twice; no scan of the ticks may stand behind it."""
    seen, right = {}, maintenance.write_table

    def noted(rows, path, *args, **kwargs):
        seen[path.rsplit("/", 1)[1]] = plan(rows)
        right(rows, path, *args, **kwargs)

    monkeypatch.setattr(maintenance, "write_table", noted)
    rows = [(30 * i, ("WTI", "BRENT")[i % 3 == 1], 80 + (i * 7) % 5 * 1.5) for i in range(40)]
    maintenance.backfill(make_ticks(rows).selectExpr("*", "1D bid", "2D ask", "'s' source"), str(tmp_path))
    assert "Window" not in seen["alerts"] and "Window" not in seen["volatility"] and "Join" not in seen["volatility"]
    assert stored.StoredTables(spark, str(tmp_path)).rows("alerts").count() > 0


def test_readers_see_a_backfill_when_it_is_complete(spark, tmp_path, monkeypatch):
    ticks = replay.ticks(spark, SMALL)
    maintenance.backfill(ticks, str(tmp_path))

    def broken(*args, **kwargs):
        raise OSError("lost")

    monkeypatch.setattr(returns, "volatility_sampled", broken)
    with pytest.raises(OSError):
        maintenance.backfill(ticks.limit(100), str(tmp_path))
    assert stored.StoredTables(spark, str(tmp_path)).rows("ticks").count() == ticks.count()


def test_models_come_after_what_they_read():
    known = maintenance.models(datetime(2024, 1, 31))
    order = maintenance.build_order(known)
    assert sorted(order) == sorted(known) and order[0] == "stg_ticks"


def test_distinct_on_sorts_no_input_row(spark):
    ticks = replay.ticks(spark, SMALL)
    found = marts.distinct_on(ticks, ["benchmark", "exchange"], ("time", "event_id"))
    shown = plan(found)
    # the rows at the winning positions are fetched by a semi join
    assert "LeftSemi" in shown and "partial_min" in shown
    deepest = shown[shown.index("partial_min") :]
    assert "Sort " not in deepest
    nulls = spark.createDataFrame([(1, None, 5.0), (2, None, 6.0), (3, "a", 7.0), (3, "a", 7.0)], "event_id long, k string, price double")
    assert sorted(r["event_id"] for r in marts.distinct_on(nulls, ["k"], ("event_id",)).collect()) == [1, 3]


def test_first_refresh_builds_the_rollup(spark, make_ticks, tmp_path):
    ticks = make_ticks([(10, "WTI", 80), (3700, "WTI", 81), (7300, "WTI", 82), (10900, "WTI", 83)])
    rollups.refresh_rollup(ticks, f"{tmp_path}/new", START + timedelta(hours=3, minutes=30))
    found = spark.read.parquet(f"{tmp_path}/new").orderBy("bucket").collect()
    assert [r["open"] for r in found] == [81.0, 82.0]


def test_retention_drops_whole_days(spark, tmp_path):
    ticks = replay.ticks(spark, SMALL).withColumn("date", F.to_date("time"))
    ticks.write.partitionBy("date").option("path", f"{tmp_path}/t").mode("overwrite").saveAsTable("retained")
    dropped = maintenance.drop_expired(spark, "retained", datetime(2024, 2, 10, 5))
    assert dropped[0] == "2024-01-01" and dropped[-1] == "2024-01-10"
    assert str(spark.table("retained").agg(F.min("date")).first()[0]) == "2024-01-11"
    assert spark.table("retained").count() == ticks.where("date >= '2024-01-11'").count()
    spark.sql("DROP TABLE retained")


def test_refresh_leaves_other_buckets_alone(spark, make_ticks, tmp_path):
    ticks = make_ticks([(10, "WTI", 80), (3700, "WTI", 81), (7300, "WTI", 82), (10900, "WTI", 83)])
    rollups.write_rollup(rollups.rollup_hourly(ticks.where("event_id < 2")), str(tmp_path))
    changed = ticks.withColumn("price", F.col("price") + 100)
    rollups.refresh_rollup(changed, str(tmp_path), START + timedelta(hours=3, minutes=30))
    found = spark.read.parquet(str(tmp_path)).orderBy("bucket").collect()
    assert [r["open"] for r in found] == [80.0, 181.0, 182.0]


def test_refresh_empties_a_date_without_ticks(spark, make_ticks, tmp_path):
    hours = [(10, "WTI", 80), (86_400 + 10, "WTI", 81), (86_400 + 3700, "WTI", 82)]
    rollups.write_rollup(rollups.rollup_hourly(make_ticks(hours)), str(tmp_path))
    rollups.refresh_rollup(make_ticks(hours[:1]), str(tmp_path), START + timedelta(days=1, hours=2, minutes=30))
    found = spark.read.schema("bucket timestamp_ntz, open double, date date").parquet(str(tmp_path)).collect()
    assert [(r["bucket"], r["open"]) for r in found] == [(START, 80.0)]


@pytest.mark.parametrize(
    "as_of,low,high", [((12, 30), (10, 0), (12, 0)), ((12, 0), (9, 0), (11, 0)), ((12, 1), (10, 0), (12, 0))]
)
def test_refresh_covers_whole_buckets(as_of, low, high):
    day = datetime(2024, 1, 5)
    at = lambda h, m: day + timedelta(hours=h, minutes=m)
    assert rollups.whole_buckets(at(*as_of), rollups.HOURLY_REFRESH, rollups.HOUR) == (at(*low), at(*high))


def test_insert_without_keys_keeps_copies(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a")], "event_id int, k string")
    assert maintenance.insert_ignore(rows, rows).count() == 2
    assert maintenance.insert_ignore(rows, rows.limit(0), ["k"]).count() == 1
    assert maintenance.insert_ignore(rows, rows, ["k"]).count() == 0


def test_models_are_rebuilt(spark, tmp_path):
    ticks = replay.ticks(spark, SMALL)
    for _ in range(2):
        maintenance.build_models(ticks, datetime(2024, 1, 31), "twice_", str(tmp_path))
    assert spark.table("twice_daily_analytics").count() == 150
    assert spark.table("twice_stg_ticks").count() == ticks.count()


def test_json_defaults(spark):
    rows = spark.createDataFrame([(1, '{"price": 5, "volume": 2}')], "event_id long, value string")
    row = decode.decode_json(rows).first()
    assert (row["benchmark"], row["source"], row["fault"]) == ("UNKNOWN", "simulator", None)
    assert decode.decode_json(rows).select(F.unix_micros("time")).first()[0] == 0


def test_feed_numbers_as_text(spark):
    rows = spark.createDataFrame([('{"tradePrice": "78.5", "tradeQuantity": 3, "timestamp": 1704067200123}',)], "value string")
    row = decode.feed_adapter(rows, "WTI", "NYMEX").first()
    assert (row["price"], row["volume"], row["benchmark"]) == (78.5, 3.0, "WTI")


def test_avro_round_trip(spark):
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:
        pytest.skip("the spark-avro package is not on the class path")
    ticks = replay.ticks_dense(spark, SMALL).withColumn("region", F.lit("EUROPE")).withColumn("open_interest", F.lit(None).cast("double"))
    sent = decode.publish_ticks(ticks, "avro")
    assert decode.good_ticks(decode.decode_ticks(sent, "avro")).count() == ticks.count()


def test_registry_header(spark):
    body = spark.range(1).select(decode.framed(F.lit(b"body"), 258).alias("value")).first()["value"]
    assert bytes(body) == b"\x00\x00\x00\x01\x02body" and len(body) == decode.REGISTRY_HEADER + 4


@pytest.mark.parametrize(
    "name", ["candles_5m", "rollup_hourly", "rollup_daily", "daily_analytics", "live_prices", "latest_spread", "spread_heatmap"]
)
def test_ordered_aggregates_need_no_sort_of_the_input(spark, name):
    shown = plan(QUERIES[name](spark, SMALL))
    assert "HashAggregate" in shown and "SortAggregate" not in shown


def test_order_key_orders_as_its_columns_do(spark):
    rows = [(t, e) for t in (-1, 0, 1, 253_402_300_799_999_999) for e in (-(2**63), -1, 0, 2**63 - 1)]
    df = spark.createDataFrame(rows, "us long, event_id long").withColumn("time", F.timestamp_micros("us"))
    found = df.orderBy(order_key(("time", "event_id"))).select("us", "event_id").collect()
    assert [tuple(r) for r in found] == sorted(rows)
