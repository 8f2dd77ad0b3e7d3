"""Keyed state of the tick stream in Spark's state store: open candle, session sums, the last ticks.

Each processor gets a micro-batch's ticks of one key, puts them in order of arrival (event_id) and works
on arrays; what later batches need is small and of fixed size. Spark hands rows to a processor one by one, so
ticks are packed before, in the tasks that read them: a row of arrays holds a key's ticks of one Arrow batch.
A batch that is run again starts from the state that Spark kept before it. A key's ticks of one micro-batch
pass one task, so a micro-batch has to be bounded by the source (`maxFilesPerTrigger`, `maxOffsetsPerTrigger`);
the order of a key's ticks leaves no other way on a stream. Tables of any size go through `operators.ordered`.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.columns import micros as micros_of
from tickloom.schemas import MIN_VOL_TICKS, ROLLING_TICKS

#: Partitions of the state, fixed when a stream first starts: there are a handful of keys.
STATE_PARTITIONS = 8
#: Ticks whose returns are looked at in one go.
BLOCK = 65_536
MINUTE_US = 60_000_000
#: Microseconds that numpy reads as "not a time".
NO_TIME = np.iinfo(np.int64).min

#: Rows of the enriched stream: a tick with what is known at it, a closed candle, or a WTI tick with the
#: latest BRENT price. Times are microseconds.
ENRICHED = (
    "kind string, event_id bigint, time_us bigint, benchmark string, exchange string, price double, volume double, "
    "bid double, ask double, source string, prev_price double, rolling_std_30 double, session_pv double, "
    "session_volume double, brent_price double, open double, high double, low double, close double, vwap double, tick_count int"
)
COLUMNS = [field.split()[0] for field in ENRICHED.split(", ")]
TICK_ROW, CANDLE_ROW, PAIR_ROW = "tick", "candle", "pair"
#: What is packed of a tick, for the state of a benchmark and that of the pair.
_TICK_FIELDS = {
    "event_id": "bigint", "time_us": "bigint", "exchange": "string", "price": "double", "volume": "double",
    "bid": "double", "ask": "double", "source": "string",
}
_PAIR_FIELDS = {name: _TICK_FIELDS[name] for name in ("event_id", "time_us", "price")}


@contextmanager
def state_partitions(spark: SparkSession, count: int = STATE_PARTITIONS):
    """Streams that are started inside have at most `count` partitions of state."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(count, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def packed(ticks: DataFrame, fields: dict[str, str]) -> DataFrame:
    """One row per benchmark and Arrow batch: `benchmark` and an array of each of the `fields`."""
    names = ["benchmark", *fields]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = pa.Table.from_batches([batch]).group_by("benchmark", use_threads=False)
            lists = groups.aggregate([(c, "list") for c in fields]).select(["benchmark", *[f"{c}_list" for c in fields]])
            yield from lists.rename_columns(names).to_batches()

    # a missing time goes as the number that numpy reads as none
    timed = ticks.withColumn("time_us", F.coalesce(micros_of("time"), F.lit(NO_TIME)))
    rows = timed.select(F.col("benchmark").cast("string").alias("benchmark"), *[F.col(c).cast(kind).alias(c) for c, kind in fields.items()])
    return rows.mapInArrow(pack, ", ".join(["benchmark string", *[f"{c} array<{kind}>" for c, kind in fields.items()]]))


def in_order(parts: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """A key's ticks of the micro-batch by arrival."""
    return by_arrival(pd.concat(list(parts)))


def by_arrival(ticks: pd.DataFrame) -> pd.DataFrame:
    return ticks.sort_values("event_id", kind="stable", ignore_index=True)


def unpacked(parts: Iterator[pd.DataFrame], fields: dict[str, str]) -> pd.DataFrame:
    """A key's ticks of the micro-batch by arrival, from `packed` rows."""
    rows = pd.concat(list(parts))
    found = {c: np.concatenate(rows[c].tolist(), dtype=object if kind == "string" else None) for c, kind in fields.items()}
    found.update({c: numbers(pd.Series(found[c])) for c, kind in fields.items() if kind == "double"})
    found["benchmark"] = np.repeat(rows["benchmark"].to_numpy(dtype=object), [len(ids) for ids in rows["event_id"]])
    ticks = pd.DataFrame(found)
    if ticks["event_id"].dtype == object:  # some are missing
        ticks["event_id"] = ticks["event_id"].astype("Int64")
    return by_arrival(ticks)


def micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy().astype("datetime64[us]").astype(np.int64)


def numbers(column: pd.Series) -> np.ndarray:
    """Values as doubles, missing ones as NaN."""
    return column.to_numpy(dtype=float, na_value=np.nan)


def returns(prices: np.ndarray) -> np.ndarray:
    """Relative change to the price before; NaN for the first, and after a zero or missing price."""
    before = np.concatenate([[np.nan], prices[:-1]])
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(before != 0, (prices - before) / before, np.nan)


def rolling_deviation(prices: np.ndarray, start: int) -> np.ndarray:
    """Population deviation of the returns among the last 30 prices, from place `start` on; NaN below five prices."""
    width = ROLLING_TICKS - 1
    padded = np.concatenate([np.full(width - 1, np.nan), returns(prices)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)[start:]
    found = np.empty(len(windows))
    for at in range(0, len(windows), BLOCK):
        part = windows[at : at + BLOCK]
        real = ~np.isnan(part)
        n = real.sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = np.where(real, part, 0).sum(axis=1) / n
            found[at : at + BLOCK] = np.sqrt(np.where(real, (part - mean[:, None]) ** 2, 0).sum(axis=1) / n)
    enough = np.concatenate([np.full(MIN_VOL_TICKS - 1, np.nan), prices])[: len(prices)]
    return np.where(np.isnan(enough[start:]), np.nan, found)


def optional(value: float) -> float | None:
    return None if np.isnan(value) else float(value)


def enriched_rows(found: pd.DataFrame) -> pd.DataFrame:
    """All columns of ENRICHED, texts as plain objects and missing ones as None."""
    full = found.reindex(columns=COLUMNS)
    for name in ("kind", "benchmark", "exchange", "source"):
        texts = full[name].astype(object)
        full[name] = texts.where(texts.notna(), None)
    return full


def in_blocks(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """ENRICHED rows, a block at a time, so that no Arrow batch holds a whole micro-batch."""
    for at in range(0, len(rows), BLOCK):
        yield enriched_rows(rows.iloc[at : at + BLOCK])


class TickState(StatefulProcessor):
    """Per benchmark: previous price, rolling volatility and session sums of each tick, and the candles that close."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tail = handle.getListState("tail", "price double")
        self.session = handle.getValueState("session", "pv double, volume double")
        self.open = handle.getValueState(
            "open", "minute bigint, open double, high double, low double, close double, volume double, pv double, tick_count bigint"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ticks = unpacked(rows, _TICK_FIELDS)
        price, volume = numbers(ticks["price"]), numbers(ticks["volume"])
        yield from self._ticks(ticks, price, volume)
        yield from self._candles(key[0], ticks["time_us"].to_numpy(), price, volume)

    def _ticks(self, ticks: pd.DataFrame, price: np.ndarray, volume: np.ndarray) -> Iterator[pd.DataFrame]:
        known = [np.nan if p is None else p for (p,) in self.tail.get()] if self.tail.exists() else []
        prices, n = np.concatenate([known, price]), len(known)
        pv, traded = self.session.get() if self.session.exists() else (0.0, 0.0)
        out = ticks.copy()
        out["kind"] = TICK_ROW
        out["prev_price"] = np.concatenate([[np.nan], prices])[n : n + len(price)]
        out["rolling_std_30"] = rolling_deviation(prices, n)
        out["session_pv"] = pv + np.cumsum(np.nan_to_num(price * volume))
        out["session_volume"] = traded + np.cumsum(np.nan_to_num(volume))
        self.session.update((float(out["session_pv"].iloc[-1]), float(out["session_volume"].iloc[-1])))
        self.tail.put([(optional(p),) for p in prices[-ROLLING_TICKS:]])
        yield from in_blocks(out)

    def _candles(self, benchmark: str, time_us: np.ndarray, price: np.ndarray, volume: np.ndarray) -> Iterator[pd.DataFrame]:
        """Fold the ticks into candles: a tick older than the open candle joins that one."""
        was = self.open.get() if self.open.exists() else None
        minute = time_us // MINUTE_US * MINUTE_US
        candle = np.maximum.accumulate(minute if was is None else np.maximum(minute, was[0]))
        ticks = pd.DataFrame({"minute": candle, "price": price, "volume": volume, "pv": price * volume})
        made = ticks.groupby("minute", sort=False).agg(
            open=("price", "first"), high=("price", "max"), low=("price", "min"), close=("price", "last"),
            volume=("volume", "sum"), pv=("pv", "sum"), tick_count=("price", "size"),
        ).reset_index()
        if was is not None:
            if made["minute"].iloc[0] == was[0]:
                first = made.iloc[0]
                merged = (
                    was[0], was[1], max(was[2], first["high"]), min(was[3], first["low"]), first["close"],
                    was[5] + first["volume"], was[6] + first["pv"], was[7] + first["tick_count"],
                )
                made.iloc[0] = merged
            else:
                made = pd.concat([pd.DataFrame([was], columns=made.columns), made], ignore_index=True)
        last = made.iloc[-1]
        self.open.update((int(last["minute"]), *(float(last[c]) for c in ("open", "high", "low", "close", "volume", "pv")), int(last["tick_count"])))
        closed = made.iloc[:-1].copy()
        if len(closed):
            # without volume the average is the price of the tick that closed the candle
            closed["vwap"] = np.where(closed["volume"] != 0, closed["pv"] / closed["volume"].replace(0, np.nan), made["open"].to_numpy()[1:])
            closed = closed.rename(columns={"minute": "time_us"}).assign(kind=CANDLE_ROW, benchmark=benchmark)
            yield from in_blocks(closed)


class PairState(StatefulProcessor):
    """The latest BRENT price at each WTI tick; `prev_price` says whether an earlier WTI tick was there."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "brent double, begun boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ticks = unpacked(rows, _PAIR_FIELDS)
        brent, begun = self.known.get() if self.known.exists() else (None, False)
        ours = (ticks["benchmark"] == "WTI").to_numpy()
        price = numbers(ticks["price"])
        latest = pd.Series(np.where(ours, np.nan, price)).ffill().fillna(np.nan if brent is None else brent).to_numpy()
        earlier = np.concatenate([[0], np.cumsum(ours)[:-1]]) > 0
        self.known.update((optional(latest[-1]), bool(begun or ours.any())))
        out = ticks[ours].assign(
            kind=PAIR_ROW, brent_price=latest[ours], prev_price=np.where(earlier | begun, 1.0, np.nan)[ours],
        )
        yield from in_blocks(out)


class ReturnState(StatefulProcessor):
    """Each tick with its return and the time of the tick before, per benchmark."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "time_us bigint, price double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ticks = in_order(rows)
        time_us, price = micros(ticks["time"]), numbers(ticks["price"])
        was = self.last.get() if self.last.exists() else None
        before = np.nan if was is None or was[1] is None else was[1]
        out = pd.DataFrame({"benchmark": np.full(len(ticks), key[0], object), "time": time_us.astype("datetime64[us]")})
        earlier = np.concatenate([time_us[:1], time_us[:-1]])
        earlier[0] = NO_TIME if was is None else was[0]
        out["prev_time"] = earlier.astype("datetime64[us]")
        out["ret"] = returns(np.concatenate([[before], price]))[1:]
        self.last.update((int(time_us[-1]), optional(price[-1])))
        yield out


def enriched(ticks: DataFrame) -> DataFrame:
    """The stream of ENRICHED rows: two keyed states side by side, one per benchmark and one of the pair."""
    own = packed(ticks, _TICK_FIELDS).groupBy("benchmark").transformWithStateInPandas(TickState(), ENRICHED, "Append", "None")
    both = ticks.where(F.col("benchmark").isin("WTI", "BRENT"))
    pair = packed(both, _PAIR_FIELDS).withColumn("pair", F.lit("WTI/BRENT"))
    return own.unionByName(pair.groupBy("pair").transformWithStateInPandas(PairState(), ENRICHED, "Append", "None"))


def tick_returns(watermarked: DataFrame) -> DataFrame:
    """benchmark, time, prev_time, ret of a stream behind a watermark, which `time` keeps."""
    form = "benchmark string, time timestamp, prev_time timestamp, ret double"
    rows = watermarked.select("event_id", "time", "benchmark", "price")  # packed rows would have no watermark
    return rows.groupBy("benchmark").transformWithStateInPandas(ReturnState(), form, "Append", "EventTime", eventTimeColumnName="time")
