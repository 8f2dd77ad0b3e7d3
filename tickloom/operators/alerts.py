"""Alert rules over ticks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import iso_text, present, rounded
from tickloom.operators.asof import price_of
from tickloom.operators.ordered import (
    CHUNK,
    EVENT_ORDER,
    HALO,
    running,
    with_chunk,
    with_halo,
)
from tickloom.operators.returns import KEY, rolling_vol, with_previous, with_rolling
from tickloom.schemas import MOVE_PCT, ROLLING_TICKS, SPREAD_LIMIT, VOL_LIMIT

_RAISED = ["alert_type", "delta", "delta_pct", "severity", "message"]
ALERT_COLUMNS = ["time", "benchmark", "alert_type", "price", "delta", "delta_pct", "severity", "message"]


def alert_inputs(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Ticks with previous price, rolling volatility and the latest BRENT price."""
    return alert_inputs_chunked(with_chunk(ticks, order_by), order_by)


def alert_inputs_chunked(chunked: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """The same on a chunked frame.

    All three scans need the same chunks, so the rows are spread by chunk once and every
    window below reuses that.
    """
    spread = with_halo(chunked, KEY, order_by, ROLLING_TICKS, ["price", "time"]).repartition(CHUNK)
    rolled = with_rolling(spread, order_by).where(~F.col(HALO)).drop(HALO)
    return with_brent(rolled, chunked, order_by)


def with_brent(rolled: DataFrame, chunked: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Add `brent_price`; its per-chunk summary is taken from the plain chunked ticks."""
    return running(rolled, [], order_by, lasts={"brent_price": price_of("BRENT")}, summarize=chunked)


class Rule:
    """One alert rule: its condition and the alert it raises, on columns of `alert_inputs`."""

    def __init__(self, number: int, when: Column, kind, delta: Column, pct: Column, severity, message: Column):
        self.when = when
        self.alert = F.struct(
            F.lit(number).alias("rule"),
            (F.lit(kind) if isinstance(kind, str) else kind).alias("alert_type"),
            delta.alias("delta"),
            pct.cast("double").alias("delta_pct"),
            (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
            message.alias("message"),
        )


def move_rule() -> Rule:
    """SPIKE or DROP: a move of at least half a percent in one tick."""
    delta = F.col("price") - F.col("prev_price")
    pct = F.try_divide(delta, F.col("prev_price")) * 100
    size = F.abs(pct)
    kind = F.when(delta > 0, "SPIKE").otherwise("DROP")
    severity = F.when(size > 2, "CRITICAL").when(size > 1, "HIGH").otherwise("MEDIUM")
    text = F.format_string("%s %s: %+.2f%%", F.col("benchmark"), F.lower(kind), rounded(pct, 2))
    return Rule(0, size >= MOVE_PCT, kind, delta, pct, severity, text)


def spread_rule() -> Rule:
    """SPREAD_WIDE: a WTI tick more than five away from the latest BRENT price."""
    gap = F.abs(F.col("price") - present(F.col("brent_price")))
    wide = (F.col("benchmark") == "WTI") & F.col("prev_price").isNotNull() & (gap > SPREAD_LIMIT)
    text = F.format_string("WTI/Brent spread unusually wide: $%.2f", rounded(gap, 2))
    return Rule(1, wide, "SPREAD_WIDE", gap, F.lit(None), "HIGH", text)


def volatility_rule() -> Rule:
    """VOLATILITY: rolling volatility above the limit."""
    vol = F.col("rolling_std_30")
    high = F.col("prev_price").isNotNull() & (vol > VOL_LIMIT)
    text = F.format_string("%s rolling σ elevated: %.4f", F.col("benchmark"), rounded(vol, 4))
    return Rule(2, high, "VOLATILITY", vol, F.lit(None), "MEDIUM", text)


def fan_out(inputs: DataFrame, *rules: Rule) -> DataFrame:
    """One row per raised alert, up to one per rule and tick; `rule` gives their order in a tick.

    Most ticks raise nothing, so the conditions filter first and messages are built after that.
    """
    raised = inputs.where(reduce(lambda a, b: a | b, [F.coalesce(rule.when, F.lit(False)) for rule in rules]))
    alerts = F.explode(F.array(*[F.when(rule.when, rule.alert) for rule in rules])).alias("_alert")
    rows = raised.select("event_id", "time", "benchmark", "price", alerts).where(F.col("_alert").isNotNull())
    return rows.select("event_id", "_alert.rule", "time", "benchmark", "price", *[f"_alert.{c}" for c in _RAISED])


def alerts_all(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """All rules. The first tick of a benchmark has no previous price and raises nothing."""
    return fan_out(alert_inputs(ticks, order_by), move_rule(), spread_rule(), volatility_rule())


def alerts_price_move(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    return fan_out(with_previous(with_chunk(ticks, order_by), order_by), move_rule())


def alerts_spread(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    pair = with_chunk(ticks.where(F.col("benchmark").isin("WTI", "BRENT")), order_by)
    return fan_out(with_brent(with_previous(pair, order_by), pair, order_by), spread_rule())


def alerts_volatility(ticks: DataFrame, order_by: Sequence[str] = EVENT_ORDER) -> DataFrame:
    return fan_out(rolling_vol(ticks, order_by), volatility_rule())


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as keyed JSON messages."""
    body = F.struct(iso_text("time").alias("time"), *ALERT_COLUMNS[1:])
    return alerts.select(
        F.col("benchmark").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value")
    )


def alert_frequency(alerts: DataFrame, interval: str = "10 minutes") -> DataFrame:
    """Number of alerts per interval and type."""
    return (
        alerts.groupBy(F.window("time", interval), "alert_type")
        .agg(F.count("*").alias("alert_count"))
        .select(F.col("window.start").alias("time"), "alert_type", "alert_count")
    )


def newest_alerts(alerts: DataFrame, count: int) -> DataFrame:
    """The newest alerts; ties in time by arrival, then by rule."""
    return alerts.orderBy(F.desc("time"), F.desc("event_id"), F.desc("rule")).limit(count)
