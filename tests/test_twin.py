"""Candles, volatility, session price and alerts against plain Python on a jittered feed."""

import random
from datetime import timedelta
from itertools import accumulate, groupby
from statistics import pstdev

import pytest
from pyspark.sql import functions as F

from tests.conftest import START
from tickloom.operators import alerts, candles, returns
from tickloom.operators.ordered import ARRIVAL_ORDER


@pytest.fixture(scope="module")
def feed():
    rng = random.Random(3)
    level = {"WTI": 80.0, "BRENT": 84.0, "DUBAI": 82.0}
    rows = []
    for i in range(900):
        name = rng.choice(list(level))
        level[name] *= 1 + rng.choice([0.0, 0.002, -0.002, 0.006, -0.006, 0.015, -0.02, 0.9, -0.45])
        level[name] = min(max(level[name], 20.0), 400.0)
        at = i * 4.0 + 0.37 - rng.choice([0, 0, 0, 0, 70])
        rows.append((i, START + timedelta(hours=1, seconds=at), name, round(level[name], 3), float(rng.choice([0, 0, 5, 9]))))
    return rows


@pytest.fixture(scope="module")
def arriving(spark, feed):
    shape = "event_id long, time timestamp_ntz, benchmark string, price double, volume double"
    return spark.createDataFrame(feed, shape).withColumn("arrival_us", F.col("event_id"))


def per_benchmark(feed):
    return {b: [r for r in feed if r[2] == b] for b in sorted({r[2] for r in feed})}


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-9)


def test_candles_fold_late_ticks(arriving, feed):
    want = {}
    for name, rows in per_benchmark(feed).items():
        minutes = accumulate((r[1].replace(second=0, microsecond=0) for r in rows), max)
        groups = [(m, [r for _, r in g]) for m, g in groupby(zip(minutes, rows), key=lambda pair: pair[0])]
        for (minute, ticks), (_, following) in zip(groups, groups[1:]):
            prices, volume = [t[3] for t in ticks], sum(t[4] for t in ticks)
            vwap = sum(t[3] * t[4] for t in ticks) / volume if volume else following[0][3]
            want[name, minute] = (prices[0], max(prices), min(prices), prices[-1], volume, vwap, len(ticks))
    found = candles.candles_1m(arriving, ARRIVAL_ORDER).collect()
    assert len(found) == len(want)
    for row in found:
        expected = want[row["benchmark"], row["time"]]
        have = [row[c] for c in ("open", "high", "low", "close", "volume", "vwap", "tick_count")]
        assert all(close(a, b) for a, b in zip(have, expected))


def test_open_candle_on_request(arriving):
    closed = candles.candles_1m(arriving, ARRIVAL_ORDER).count()
    assert candles.candles_1m(arriving, ARRIVAL_ORDER, include_open=True).count() == closed + 3


def volatility(prices):
    recent = prices[-30:]
    return pstdev((b - a) / a for a, b in zip(recent, recent[1:])) if len(recent) >= 5 else None


def test_volatility_and_session_price(arriving, feed):
    vol = {r["event_id"]: r["rolling_std_30"] for r in returns.rolling_vol(arriving, ARRIVAL_ORDER).collect()}
    vwap = {r["event_id"]: r["session_vwap"] for r in returns.session_vwap(arriving, ARRIVAL_ORDER).collect()}
    for rows in per_benchmark(feed).values():
        for i, row in enumerate(rows):
            seen = rows[: i + 1]
            volume = sum(r[4] for r in seen)
            assert close(vol[row[0]], volatility([r[3] for r in seen]))
            assert close(vwap[row[0]], sum(r[3] * r[4] for r in seen) / volume if volume else None)


def test_alerts(arriving, feed):
    want = set()
    for i, (event, _, name, price, _) in enumerate(feed):
        own = [r[3] for r in feed[: i + 1] if r[2] == name]
        if len(own) < 2:
            continue
        pct = (price - own[-2]) / own[-2] * 100
        if abs(pct) >= 0.5:
            level = next(s for s, least in (("CRITICAL", 2), ("HIGH", 1), ("MEDIUM", 0)) if abs(pct) > least)
            want.add((event, "SPIKE" if pct > 0 else "DROP", level))
        brent = [r[3] for r in feed[:i] if r[2] == "BRENT"]
        if name == "WTI" and brent and abs(price - brent[-1]) > 5:
            want.add((event, "SPREAD_WIDE", "HIGH"))
        if (volatility(own) or 0) > 0.3:
            want.add((event, "VOLATILITY", "MEDIUM"))
    found = alerts.alerts_all(arriving, ARRIVAL_ORDER).collect()
    assert {(r["event_id"], r["alert_type"], r["severity"]) for r in found} == want
    assert len(found) == len(want) and len({k for _, k, _ in want}) == 4
