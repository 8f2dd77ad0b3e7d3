"""Hand-written cases of the rules."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import START
from tickloom.operators import alerts, asof, candles, quotes, returns, rollups
from tickloom.plans import live, marts, quality, staging


def test_candle_closes_on_the_next_minute(make_ticks):
    rows = candles.candles_1m(make_ticks([(1, "WTI", 80), (30, "WTI", 82), (60, "WTI", 81)])).collect()
    assert [(r["time"], r["open"], r["high"], r["low"], r["close"], r["tick_count"]) for r in rows] == [
        (START, 80.0, 82.0, 80.0, 82.0, 2)
    ]


def test_candle_without_volume_takes_the_closing_tick(make_ticks):
    rows = candles.candles_1m(make_ticks([(1, "WTI", 80, 0), (30, "WTI", 82, 0), (60, "WTI", 81, 5)])).collect()
    assert [r["vwap"] for r in rows] == [81.0]


def test_empty_minutes_give_no_candle(make_ticks):
    rows = candles.candles_1m(make_ticks([(1, "WTI", 80), (200, "WTI", 82), (400, "WTI", 81)])).collect()
    assert sorted(r["time"] for r in rows) == [START, START + timedelta(minutes=3)]


def test_candles_chain_over_days(make_ticks):
    day = 86_400
    rows = candles.candles_1m(make_ticks([(1, "WTI", 80, 0), (3 * day, "WTI", 81, 0), (9 * day, "WTI", 82)])).collect()
    assert sorted(r["vwap"] for r in rows) == [81.0, 82.0]


def test_five_minute_candle_without_volume_takes_its_close(make_ticks):
    row = candles.candles_5m(make_ticks([(1, "WTI", 80, 0), (30, "WTI", 82.12345, 0)])).first()
    assert (row["vwap"], row["window_end"] - row["window_start"]) == (82.1235, 300_000)


def test_rolling_volatility_needs_five_prices(make_ticks):
    ticks = make_ticks([(i, "WTI", p) for i, p in enumerate([80, 84, 80, 84, 80])])
    found = [r["rolling_std_30"] for r in returns.rolling_vol(ticks).orderBy("event_id").collect()]
    assert found[:4] == [None] * 4
    assert found[4] == pytest.approx((0.05 + 4 / 84) / 2)


def test_first_ticks_raise_nothing(make_ticks):
    assert alerts.alerts_all(make_ticks([(0, "BRENT", 10), (1, "WTI", 100), (2, "DUBAI", 50)])).count() == 0


@pytest.mark.parametrize(
    "price,kind,severity",
    [(80.32, None, None), (80.48, "SPIKE", "MEDIUM"), (81.2, "SPIKE", "HIGH"), (78.0, "DROP", "CRITICAL"), (79.52, "DROP", "MEDIUM")],
)
def test_move_limits(make_ticks, price, kind, severity):
    rows = alerts.alerts_price_move(make_ticks([(0, "WTI", 80), (1, "WTI", price)])).collect()
    assert [(r["alert_type"], r["severity"]) for r in rows] == ([(kind, severity)] if kind else [])


def test_move_message(make_ticks):
    row = alerts.alerts_price_move(make_ticks([(0, "WTI", 80), (1, "WTI", 78)])).first()
    assert row["message"] == "WTI drop: -2.50%"


@pytest.mark.parametrize("brent,raised", [(83.0, 0), (82.99, 1)])
def test_spread_limit_is_strict(make_ticks, brent, raised):
    ticks = make_ticks([(0, "WTI", 88), (1, "BRENT", brent), (2, "WTI", 88)])
    rows = alerts.alerts_spread(ticks).collect()
    assert len(rows) == raised
    assert not rows or rows[0]["message"] == "WTI/Brent spread unusually wide: $5.01"


def test_spread_rule_ignores_a_zero_price(make_ticks):
    assert alerts.alerts_spread(make_ticks([(0, "WTI", 88), (1, "BRENT", 0), (2, "WTI", 88)])).count() == 0


def test_zero_previous_price_raises_nothing(make_ticks):
    assert alerts.alerts_price_move(make_ticks([(0, "WTI", 0), (1, "WTI", 88)])).count() == 0


def test_asof_before_the_first_price_is_null(make_ticks):
    rows = asof.asof_spread(make_ticks([(0, "WTI", 88), (1, "BRENT", 80), (2, "WTI", 87)])).orderBy("event_id").collect()
    assert [r["spread"] for r in rows] == [None, 7.0]


def test_realized_volatility_of_few_prices(make_ticks):
    one = returns.realized_vol(make_ticks([(4000, "WTI", 80)])).collect()
    assert len(one) == 12 and all(r["realized_vol"] is None for r in one)
    two = returns.realized_vol(make_ticks([(4000, "WTI", 80), (4001, "WTI", 88)])).collect()
    assert len(two) == 12 and all(r["realized_vol"] == 0.0 for r in two)


def test_realized_volatility_leaves_out_the_step_into_a_window(make_ticks):
    rows = returns.realized_vol(make_ticks([(0, "WTI", 80), (3700, "WTI", 88), (3800, "WTI", 88), (3900, "WTI", 96.8)]))
    found = {r["window_start"]: r["realized_vol"] for r in rows.collect()}
    assert found[START + timedelta(minutes=10)] == 0.05


def test_daily_mart_first_day(make_ticks, spark):
    ticks = make_ticks([(0, "WTI", 80), (86_400, "WTI", 84)])
    extra = ticks.selectExpr("*", "price - 0.04 as bid", "price + 0.04 as ask", "'s' as source")
    rows = marts.daily_analytics(staging.stg_ticks(extra, datetime(2024, 1, 5))).orderBy("day_bucket").collect()
    assert [(r["price_change"], r["pct_change"], r["volatility_regime"]) for r in rows] == [
        (None, None, "NORMAL"), (4.0, 5.0, "HIGH"),
    ]
    assert rows[0]["daily_volatility"] is None and rows[0]["avg_spread"] == 0.08


def test_staging_keeps_the_last_thirty_days(make_ticks):
    ticks = make_ticks([(0, "URALS", 80), (86_400, "URALS", 80)]).selectExpr("*", "1D bid", "2D ask", "'s' source")
    rows = staging.stg_ticks(ticks, START + timedelta(days=31)).collect()
    assert [(r["event_id"], r["region"]) for r in rows] == [(1, "OTHER")]


def test_zero_volume_rollup_has_no_average(make_ticks):
    assert rollups.rollup_hourly(make_ticks([(0, "WTI", 80, 0)])).first()["vwap"] is None


def test_live_price_expires(make_ticks):
    ticks = make_ticks([(0, "WTI", 80, 0), (50, "BRENT", 81)])
    rows = {r["benchmark"]: r for r in live.live_prices(ticks, START + timedelta(seconds=60)).collect()}
    assert set(rows) == {"BRENT"}
    assert (rows["BRENT"]["ts"], rows["BRENT"]["vol"]) == ("2024-01-01T00:00:50+00:00", None)
    assert live.live_prices(ticks).where("benchmark = 'WTI'").first()["vwap"] is None


def test_live_series_keeps_distinct_points_of_an_hour(make_ticks):
    ticks = make_ticks([(0, "WTI", 80), (10, "WTI", 80), (10, "WTI", 80), (3600, "WTI", 81), (0, "BRENT", 9)])
    found = sorted((r["benchmark"], r["price"]) for r in live.live_series(ticks).collect())
    assert found == [("BRENT", 9.0), ("WTI", 80.0), ("WTI", 81.0)]


def test_clamp(make_ticks):
    rows = quotes.clamp_market(make_ticks([(0, "WTI", 10, 1), (1, "WTI", 300, 500)])).orderBy("event_id").collect()
    assert [(r["price"], r["volume"]) for r in rows] == [(30.0, 100.0), (200.0, 500.0)]


def test_quality_counts(make_ticks):
    ticks = make_ticks([(0, "WTI", 80), (1, "OTHER", 301), (2, "WTI", 300)])
    assert quality.accepted_values(ticks, "ticks").first()["failures"] == 1
    assert quality.accepted_range(ticks, "ticks").first()["failures"] == 1
    assert {r["failures"] for r in quality.not_null(ticks, "ticks").collect()} == {0}
    assert [(r["benchmark"], r["copies"]) for r in quality.unique(ticks, ["benchmark"]).collect()] == [("WTI", 2)]


def test_seconds_candles(make_ticks):
    rows = candles.candlestick(make_ticks([(0.2, "WTI", 80), (0.7, "WTI", 81), (1.1, "WTI", 82)]), "1 second")
    assert sorted((r["open"], r["close"]) for r in rows.collect()) == [(80.0, 81.0), (82.0, 82.0)]


def test_average_true_range(make_ticks):
    ticks = make_ticks([(60 * i, "WTI", 80 + i % 2) for i in range(17)])
    rows = candles.atr(candles.candles_1m(ticks)).orderBy("time").collect()
    assert [r["atr_14"] is None for r in rows] == [True] * 13 + [False] * 3
    assert rows[14]["atr_14"] == 1.0


def test_deviation_far_from_zero(spark):
    """Returns of a million that differ in the third place after the point, against exact numbers."""
    import random
    import statistics

    rng, rows, exact = random.Random(4), [], {}
    for minute in range(90):
        ret = 1e6 + rng.randint(-9, 9) / 8192
        at = START + timedelta(minutes=minute)
        rows.append((at, at - timedelta(minutes=1), "WTI", ret + 1, 1.0))
        exact[at] = ret
    moved = spark.createDataFrame(rows, "time timestamp_ntz, prev_time timestamp_ntz, benchmark string, price double, prev_price double")
    panes = returns.pane_statistics(moved)
    found = returns.realized_from_panes(panes.withColumn("mean", F.col("mean")))
    parts = {r["window_start"]: r["realized_vol"] for r in found.collect()}
    for start, got in parts.items():
        inside = [v for t, v in exact.items() if start <= t - timedelta(minutes=1) and t < start + timedelta(hours=1)]
        assert got == pytest.approx(round(statistics.pstdev(inside), 6), abs=1.1e-6) if inside else got is None
    one = moved.selectExpr("price - 1 AS ret").agg(*returns.moments("ret")).selectExpr("array(struct(n, mean, m2)) AS parts")
    whole = one.select(returns.merged_deviation(F.col("parts"))).first()[0]
    assert whole == pytest.approx(statistics.pstdev(exact.values()), abs=1e-9)
    split = moved.selectExpr("price - 1 AS ret", "minute(time) AS m").groupBy("m").agg(*returns.moments("ret"))
    merged = split.agg(F.collect_list(F.struct("n", "mean", "m2")).alias("parts")).select(returns.merged_deviation(F.col("parts"))).first()[0]
    assert merged == pytest.approx(statistics.pstdev(exact.values()), abs=1e-9)


def test_merged_deviation_works_the_mean_out_once(spark):
    """Before, the mean stood in the lambda twice and was worked out for each part, over all parts."""
    parts = spark.range(1).selectExpr("transform(sequence(1, 6), i -> struct(i AS n, 1e9D + i AS mean, 2D * i AS m2)) AS parts")
    merged = parts.select(returns.merged_deviation(F.col("parts")).alias("d"))
    analyzed = merged._jdf.queryExecution().analyzed().toString()
    assert analyzed.count("aggregate(") <= 4
    mean = sum(i * i for i in range(1, 7)) / 21
    want = (sum(2 * i + i * (i - mean) ** 2 for i in range(1, 7)) / 21) ** 0.5
    assert abs(merged.first()[0] - want) < 1e-9
    assert spark.range(1).selectExpr("array_remove(array(named_struct('n', 1, 'mean', 1D, 'm2', 0D)), named_struct('n', 1, 'mean', 1D, 'm2', 0D)) AS parts").select(
        returns.merged_deviation(F.col("parts"))
    ).first()[0] is None
