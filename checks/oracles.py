"""Reference SQL for the registered queries, in DuckDB's dialect over the given tables.

Written independently of the library: plain windows over whole tables, no chunks.
"""

from __future__ import annotations

_PRICE = "(78000 + CAST(floor((floor(value * 100 + 0.5) + 2) / 4) AS BIGINT)) / 1000.0::DOUBLE"
_DENSE = "make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60)"


def r(value: str, places: int = 6) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def _ticks(name: str, time: str = "ts", price: str = _PRICE) -> str:
    return f"""
{name}_base AS (
  SELECT event_id, {time} AS time,
    CASE event_type WHEN 'click' THEN 'WTI' WHEN 'view' THEN 'BRENT' WHEN 'purchase' THEN 'DUBAI'
      WHEN 'signup' THEN 'URALS' WHEN 'error' THEN 'OPEC_BASKET' END AS benchmark,
    CASE event_type WHEN 'click' THEN 'NYMEX' WHEN 'view' THEN 'ICE' WHEN 'purchase' THEN 'ADNOC'
      ELSE 'OTHER' END AS exchange,
    {price} AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume
  FROM events),
{name} AS (
  SELECT *, CASE WHEN event_id % 10 <> 0 THEN {r("price - price * 0.001::DOUBLE / 2", 3)} END AS bid,
    CASE WHEN event_id % 10 <> 0 THEN {r("price + price * 0.001::DOUBLE / 2", 3)} END AS ask,
    'replay' AS source
  FROM {name}_base)"""


TICKS = _ticks("ticks")
DENSE = _ticks("dense", _DENSE)
RAW = _ticks("raw", price="value")
SYNC = _ticks("sync", f"date_trunc('minute', {_DENSE})")

STG = f"""{TICKS},
stg AS (
  SELECT event_id, time AS tick_time, benchmark, exchange, price, volume, bid, ask, ask - bid AS spread,
    CASE benchmark WHEN 'WTI' THEN 'NORTH_AMERICA' WHEN 'BRENT' THEN 'EUROPE' WHEN 'DUBAI' THEN 'MIDDLE_EAST'
      ELSE 'OTHER' END AS region, source,
    CAST(date_trunc('hour', time) AS TIMESTAMP) AS hour_bucket, CAST(date_trunc('day', time) AS TIMESTAMP) AS day_bucket
  FROM ticks WHERE time >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY)"""

# Per day and benchmark: plain aggregates; opening and closing prices by their smallest and largest position.
DAYS = """
days AS (
  SELECT day_bucket, benchmark, any_value(region) AS region, arg_min(price, (tick_time, event_id)) AS open_price,
    max(price) AS high_price, min(price) AS low_price, arg_max(price, (tick_time, event_id)) AS close_price,
    sum(volume) AS total_volume, sum(price * volume) / nullif(sum(volume), 0) AS vwap,
    stddev_samp(price) AS price_volatility, count(*) AS tick_count, avg(spread) AS avg_spread
  FROM stg GROUP BY ALL)"""

STATS = f"""{DAYS},
stats AS (SELECT stg.event_id, stg.tick_time, days.* FROM stg JOIN days USING (day_bucket, benchmark))"""


def _daily() -> str:
    regimes = "CASE WHEN abs(pct) > 3 THEN 'HIGH' WHEN abs(pct) > 1.5 THEN 'MEDIUM' ELSE 'NORMAL' END"
    return f"""{STG}, {STATS},
day_moves AS (
  SELECT d.*, d.close_price - p.close_price AS moved, (d.close_price / nullif(p.close_price, 0) - 1) * 100 AS pct
  FROM days d LEFT JOIN days p ON p.benchmark = d.benchmark AND p.day_bucket =
    (SELECT max(e.day_bucket) FROM days e WHERE e.benchmark = d.benchmark AND e.day_bucket < d.day_bucket)),
daily AS (
  SELECT benchmark, day_bucket, region, tick_count, {regimes} AS volatility_regime,
    {r("open_price", 3)} AS open, {r("close_price", 3)} AS close, {r("high_price", 3)} AS high,
    {r("low_price", 3)} AS low, {r("moved", 3)} AS price_change, {r("pct", 4)} AS pct_change,
    {r("vwap", 3)} AS vwap, {r("total_volume", 0)} AS total_volume, {r("avg_spread", 4)} AS avg_spread,
    {r("price_volatility", 4)} AS daily_volatility
  FROM day_moves)"""


HOURS = """
hours AS (
  SELECT hour_bucket, benchmark, avg(price) AS avg_price, min(price) AS min_price, max(price) AS max_price
  FROM {source} GROUP BY hour_bucket, benchmark)"""


def _spread(where: str = "true") -> str:
    side = lambda b: f"(SELECT hour_bucket, avg_price AS {b.lower()} FROM hours WHERE benchmark = '{b}')"
    gap = "abs(wti - brent)"
    return f"""{STG}, chosen AS (SELECT * FROM stg WHERE {where}), {HOURS.format(source="chosen")},
full_hours AS (SELECT hour_bucket FROM chosen GROUP BY 1 HAVING count(DISTINCT benchmark) = 3),
aligned AS (
  SELECT * FROM full_hours LEFT JOIN {side("WTI")} USING (hour_bucket) LEFT JOIN {side("BRENT")} USING (hour_bucket)
    LEFT JOIN {side("DUBAI")} USING (hour_bucket)),
numbered AS (SELECT *, row_number() OVER (ORDER BY hour_bucket) AS n FROM aligned),
averaged AS (
  SELECT a.n, avg(b.wti - b.brent) AS moving FROM numbered a JOIN numbered b ON b.n BETWEEN a.n - 167 AND a.n GROUP BY a.n),
spread AS (
  SELECT hour_bucket, moving, if({gap} > 5, 'WIDE', if({gap} > 3, 'MODERATE', 'NORMAL')) AS spread_regime,
    {r("wti - dubai", 3)} AS wti_dubai_spread, {r("brent - dubai", 3)} AS brent_dubai_spread,
    {r("wti - brent", 3)} AS wti_brent_spread, {r("dubai", 3)} AS dubai_price, {r("brent", 3)} AS brent_price,
    {r("wti", 3)} AS wti_price
  FROM numbered JOIN averaged USING (n))"""


_MAJORS = "benchmark IN ('WTI', 'BRENT', 'DUBAI')"
_SPREAD_OUT = f"SELECT * EXCLUDE (moving), {r('moving')} AS wti_brent_7d_avg_spread FROM spread"


def _ohlcv(source: str, bucket: str, extra: str = "") -> str:
    return f"""
  SELECT {bucket} AS bucket, benchmark, first(price ORDER BY time, event_id) AS open, max(price) AS high,
    min(price) AS low, last(price ORDER BY time, event_id) AS close, sum(volume) AS volume,
    sum(price * volume) AS pv, count(*) AS tick_count {extra}
  FROM {source} GROUP BY 1, 2"""


def _candles(order: str = "time, event_id", folded: bool = False) -> str:
    minute = "CAST(date_trunc('minute', time) AS TIMESTAMP)"
    candle = f"max({minute}) OVER (PARTITION BY benchmark ORDER BY {order} ROWS UNBOUNDED PRECEDING)" if folded else minute
    return f"""{DENSE},
arriving AS (SELECT *, epoch_us(time) + (event_id * 7919 % 20) * 1000000 AS arrival_us FROM dense),
marked AS (SELECT *, {candle} AS candle FROM arriving),
grouped AS (
  SELECT candle AS time, benchmark, first(price ORDER BY {order}) AS open, max(price) AS high, min(price) AS low,
    last(price ORDER BY {order}) AS close, sum(volume) AS volume, sum(price * volume) AS pv, count(*) AS n
  FROM marked GROUP BY candle, benchmark),
following AS (SELECT *, lead(open) OVER (PARTITION BY benchmark ORDER BY time) AS next_open FROM grouped),
candles AS (
  SELECT time, benchmark, open, high, low, close, volume, coalesce(pv / nullif(volume, 0), next_open) AS vwap,
    CAST(n AS INTEGER) AS tick_count
  FROM following WHERE next_open IS NOT NULL)"""


_CANDLE_OUT = f"SELECT * EXCLUDE (vwap), {r('vwap')} AS vwap FROM candles"


def _vol(source: str, order: str = "time, event_id") -> str:
    return f"""
moved_{source} AS (
  SELECT *, lag(price) OVER (PARTITION BY benchmark ORDER BY {order}) AS prev_price,
    lag(time) OVER (PARTITION BY benchmark ORDER BY {order}) AS prev_time,
    row_number() OVER (ORDER BY {order}) - 1 AS seq FROM {source}),
ret_{source} AS (SELECT *, (price - prev_price) / nullif(prev_price, 0) AS ret FROM moved_{source}),
vol_{source} AS (
  SELECT *, CASE WHEN count(price) OVER (PARTITION BY benchmark ORDER BY {order}
      ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) >= 5
    THEN stddev_pop(ret) OVER (PARTITION BY benchmark ORDER BY {order}
      ROWS BETWEEN 28 PRECEDING AND CURRENT ROW) END AS vol,
    last_value(CASE WHEN benchmark = 'BRENT' THEN price END IGNORE NULLS) OVER (ORDER BY {order}
      ROWS UNBOUNDED PRECEDING) AS brent,
    (price - prev_price) / nullif(prev_price, 0) * 100 AS pct
  FROM ret_{source})"""


def _alerts(source: str, order: str = "time, event_id") -> str:
    return f"""{_vol(source, order)},
moves AS (
  SELECT event_id, 0 AS rank, time, benchmark, CASE WHEN price > prev_price THEN 'SPIKE' ELSE 'DROP' END AS alert_type,
    price, price - prev_price AS delta, pct AS delta_pct,
    CASE WHEN abs(pct) > 2 THEN 'CRITICAL' WHEN abs(pct) > 1 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
    benchmark || CASE WHEN price > prev_price THEN ' spike: ' ELSE ' drop: ' END
      || printf('%+.2f', {r("pct", 2)}) || '%' AS message
  FROM vol_{source} WHERE abs(pct) >= 0.5),
wide AS (
  SELECT event_id, 1 AS rank, time, benchmark, 'SPREAD_WIDE' AS alert_type, price, abs(price - brent) AS delta,
    CAST(NULL AS DOUBLE) AS delta_pct, 'HIGH' AS severity,
    'WTI/Brent spread unusually wide: $' || printf('%.2f', {r("abs(price - brent)", 2)}) AS message
  FROM vol_{source}
  WHERE benchmark = 'WTI' AND prev_price IS NOT NULL AND brent <> 0 AND abs(price - brent) > 5),
volatile AS (
  SELECT event_id, 2 AS rank, time, benchmark, 'VOLATILITY' AS alert_type, price, vol AS delta,
    CAST(NULL AS DOUBLE) AS delta_pct, 'MEDIUM' AS severity,
    benchmark || ' rolling σ elevated: ' || printf('%.4f', {r("vol", 4)}) AS message
  FROM vol_{source} WHERE prev_price IS NOT NULL AND vol > 0.3),
every AS (SELECT * FROM moves UNION ALL SELECT * FROM wide UNION ALL SELECT * FROM volatile),
alerts AS (SELECT * EXCLUDE (rank), CAST(rank AS INTEGER) AS rule FROM every)"""


def _rule_out(table: str) -> str:
    return (
        f"SELECT event_id, CAST(rank AS INTEGER) AS rule, time, benchmark, alert_type, price, {r('delta')} AS delta, "
        f"{r('delta_pct')} AS delta_pct, severity, message FROM {table}"
    )


_ALERT_OUT = f"SELECT * EXCLUDE (delta, delta_pct), {r('delta')} AS delta, {r('delta_pct')} AS delta_pct FROM alerts"

def iso(time: str) -> str:
    return (
        f"CASE WHEN epoch_us({time}) % 1000000 = 0 THEN strftime({time}, '%Y-%m-%dT%H:%M:%S+00:00') "
        f"ELSE strftime({time}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"
    )


def _bucket(interval: str, time: str = "time") -> str:
    return f"time_bucket(INTERVAL '{interval}', {time}, TIMESTAMP '1970-01-01')"


_SESSION = """
session AS (
  SELECT *, sum(price * volume) OVER w / nullif(sum(volume) OVER w, 0) AS session_vwap
  FROM ticks WINDOW w AS (PARTITION BY benchmark ORDER BY time, event_id ROWS UNBOUNDED PRECEDING))"""


def _live(source: str, where: str = "true") -> str:
    return f"""WITH {_ticks(source, _DENSE if source == "dense" else "ts")}, {_vol(source)},
state AS (
  SELECT *, sum(price * volume) OVER w / nullif(sum(volume) OVER w, 0) AS vwap,
    row_number() OVER (PARTITION BY benchmark ORDER BY time DESC, event_id DESC) AS back
  FROM vol_{source} WINDOW w AS (PARTITION BY benchmark ORDER BY time, event_id ROWS UNBOUNDED PRECEDING))
SELECT benchmark, {r("price", 3)} AS price, {r("nullif(vwap, 0)", 3)} AS vwap, {r("nullif(vol, 0)", 6)} AS vol,
  {iso("time")} AS ts
FROM state WHERE back = 1 AND {where}"""


_SERIES = f"""{DENSE},
series AS (
  SELECT DISTINCT benchmark, time, price
  FROM (SELECT *, max(time) OVER (PARTITION BY benchmark) AS newest FROM dense)
  WHERE time > newest - INTERVAL 1 HOUR)"""


def _null_checks(table: str, source: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS failures FROM {source}"
        for c in columns.split()
    )


_WIRE = """
sent AS (SELECT *, make_timestamp((epoch_us(time) // 1000) * 1000) AS sent_at FROM dense)"""

# windows that the end of the stream leaves open: the watermark stays five seconds behind the newest tick
_CLOSED = "(SELECT max(time) - INTERVAL 5 SECOND FROM dense)"


def _alert_list(source: str, view: str) -> str:
    return f"WITH {view}, {_alerts(source)} {_ALERT_OUT}"


def _refreshed(unit: str, extra: str, until: str, low: str, high: str) -> str:
    bucket = f"CAST(date_trunc('{unit}', time) AS TIMESTAMP)"
    more = f", {r('sd')} AS daily_volatility" if extra else ""
    return f"""WITH {TICKS},
early AS ({_ohlcv(f"(SELECT * FROM ticks WHERE time < TIMESTAMP '{until}')", bucket, extra)}),
fresh AS ({_ohlcv(f"(SELECT * FROM ticks WHERE time >= TIMESTAMP '{low}' AND time < TIMESTAMP '{high}')", bucket, extra)}),
stored AS (
  SELECT * FROM early WHERE bucket < TIMESTAMP '{low}' OR bucket >= TIMESTAMP '{high}' UNION ALL SELECT * FROM fresh)
SELECT bucket, benchmark, open, high, low, close, volume, tick_count, {r("pv / nullif(volume, 0)")} AS vwap {more}
FROM stored"""


ORACLES: dict[str, str] = {
    "scan_ticks": f"WITH {TICKS} SELECT * FROM ticks",
    "stg_ticks": f"WITH {STG} SELECT * EXCLUDE (spread), {r('spread')} AS spread FROM stg",
    "ticks_last_n_days": f"WITH {TICKS} SELECT * FROM ticks WHERE time >= TIMESTAMP '2024-01-31' - INTERVAL 15 DAY",
    "daily_analytics": f"WITH {_daily()} SELECT * FROM daily",
    "daily_stats_window": f"""WITH {STG}, {STATS}
SELECT * EXCLUDE (vwap, price_volatility, avg_spread), {r("vwap")} AS vwap, {r("price_volatility")} AS price_volatility,
  {r("avg_spread")} AS avg_spread FROM stats""",
    "distinct_on_latest": f"""WITH {STG}
SELECT DISTINCT ON (day_bucket, benchmark) day_bucket, benchmark, region, event_id, tick_time, price
FROM stg ORDER BY day_bucket, benchmark, tick_time, event_id""",
    "hourly_prices": f"WITH {STG}, {HOURS.format(source='stg')} SELECT * EXCLUDE (avg_price), {r('avg_price')} AS avg_price FROM hours",
    "spread_analysis": f"WITH {_spread()} {_SPREAD_OUT}",
    "spread_analysis_majors": f"WITH {_spread(_MAJORS)} {_SPREAD_OUT}",
    "rollup_hourly": f"""WITH {TICKS}, rolled AS ({_ohlcv("ticks", "CAST(date_trunc('hour', time) AS TIMESTAMP)")})
SELECT * EXCLUDE (pv), {r("pv / nullif(volume, 0)")} AS vwap FROM rolled""",
    "rollup_daily": f"""WITH {TICKS},
rolled AS ({_ohlcv("ticks", "CAST(date_trunc('day', time) AS TIMESTAMP)", ", stddev_samp(price) AS sd")})
SELECT * EXCLUDE (pv, sd), {r("pv / nullif(volume, 0)")} AS vwap, {r("sd")} AS daily_volatility FROM rolled""",
    "candles_1m": f"WITH {_candles()} {_CANDLE_OUT}",
    "candles_1m_arrival": f"WITH {_candles('arrival_us, event_id', folded=True)} {_CANDLE_OUT}",
    "candles_5m": f"""WITH {DENSE}, rolled AS ({_ohlcv("dense", _bucket("5 minutes"))})
SELECT benchmark, epoch_ms(bucket) AS window_start, epoch_ms(bucket + INTERVAL 5 MINUTE) AS window_end, open, high, low,
  close, volume, {r("CASE WHEN volume > 0 THEN pv / volume ELSE close END", 4)} AS vwap, tick_count FROM rolled""",
    "candlestick_1m": f"""WITH {DENSE}, rolled AS ({_ohlcv("dense", _bucket("1 minute"))})
SELECT bucket AS time, benchmark, open, high, low, close FROM rolled""",
    "candlestick_1s": f"""WITH {DENSE}, rolled AS ({_ohlcv("dense", _bucket("1 second"))})
SELECT bucket AS time, benchmark, open, high, low, close FROM rolled""",
    "atr_14": f"""WITH {_candles()},
ranged AS (
  SELECT time, benchmark, greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr
  FROM candles WINDOW w AS (PARTITION BY benchmark ORDER BY time)),
averaged AS (
  SELECT time, benchmark, avg(tr) OVER w AS atr, count(*) OVER w AS n
  FROM ranged WINDOW w AS (PARTITION BY benchmark ORDER BY time ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT time, benchmark, CASE WHEN n = 14 THEN {r("atr")} END AS atr_14 FROM averaged""",
    "tick_returns": f"""WITH {TICKS}, {_vol("ticks")}
SELECT event_id, benchmark, price, prev_price, {r("price - prev_price")} AS delta, {r("pct")} AS delta_pct FROM vol_ticks""",
    "rolling_vol_30": f"WITH {TICKS}, {_vol('ticks')} SELECT event_id, time, benchmark, {r('vol')} AS rolling_std_30 FROM vol_ticks",
    "rolling_std_1m": f"""WITH {DENSE}, {_vol("dense")},
seconds AS (SELECT DISTINCT benchmark, CAST(date_trunc('second', time) AS TIMESTAMP) AS second FROM ret_dense)
SELECT s.second AS time, s.benchmark, {r("stddev_pop(t.ret)")} AS rolling_std_1m
FROM seconds s JOIN ret_dense t ON t.benchmark = s.benchmark AND t.time >= s.second - INTERVAL 59 SECOND
  AND t.time < s.second + INTERVAL 1 SECOND
GROUP BY s.second, s.benchmark""",
    "session_vwap": f"WITH {TICKS}, {_SESSION} SELECT event_id, time, benchmark, {r('session_vwap')} AS session_vwap FROM session",
    "volatility_sampled": f"""WITH {DENSE}, {_vol("dense")}
SELECT event_id, seq, time, benchmark, {r("vol")} AS rolling_std_30 FROM vol_dense WHERE seq % 10 = 0 AND vol <> 0""",
    "volatility_1m_avg": f"""WITH {DENSE}, {_vol("dense")}
SELECT {_bucket("1 minute")} AS time, benchmark, {r("avg(vol)")} AS volatility
FROM vol_dense WHERE seq % 10 = 0 AND vol <> 0 AND benchmark = 'WTI' GROUP BY 1, 2""",
    "realized_vol_1h": f"""WITH {DENSE},
placed AS (
  SELECT benchmark, time, event_id, price, {_bucket("5 minutes")} - INTERVAL 5 MINUTE * k AS start
  FROM dense, range(12) AS shifts(k)),
returned AS (
  SELECT *, lag(price) OVER (PARTITION BY benchmark, start ORDER BY time, event_id) AS prev FROM placed),
windows AS (
  SELECT benchmark, start, stddev_pop((price - prev) / nullif(prev, 0)) AS std, count(*) AS n
  FROM returned GROUP BY benchmark, start)
SELECT benchmark, start AS window_start, start + INTERVAL 1 HOUR AS window_end, {r("std")} AS realized_vol,
  {r("std * sqrt(252 * 8 * 3600 * 2)", 4)} AS annualized_vol, n AS tick_count FROM windows""",
    "asof_spread": f"""WITH {TICKS}
SELECT w.event_id, w.time, w.price AS wti_price, b.price AS brent_price, {r("w.price - b.price")} AS spread
FROM (SELECT * FROM ticks WHERE benchmark = 'WTI') w
ASOF LEFT JOIN (SELECT * FROM ticks WHERE benchmark = 'BRENT') b ON w.time >= b.time""",
    "latest_spread": f"""WITH {TICKS}
SELECT {r("w.price - b.price")} AS value
FROM (SELECT price FROM ticks WHERE benchmark = 'WTI' ORDER BY time DESC, event_id DESC LIMIT 1) w,
  (SELECT price FROM ticks WHERE benchmark = 'BRENT' ORDER BY time DESC, event_id DESC LIMIT 1) b""",
    "spread_heatmap": f"""WITH {SYNC},
newest AS (SELECT DISTINCT ON (time, benchmark) time, benchmark, price FROM sync ORDER BY time, benchmark, event_id DESC)
SELECT {_bucket("5 minutes", "t.time")} AS time, {r("avg(abs(w.price - b.price))")} AS wti_brent_spread
FROM sync t JOIN newest w ON w.time = t.time AND w.benchmark = 'WTI'
  JOIN newest b ON b.time = t.time AND b.benchmark = 'BRENT'
GROUP BY 1""",
    "stream_spread_5m": f"""WITH {DENSE},
closes AS (
  SELECT {_bucket("5 minutes")} AS time,
    last(price ORDER BY time, event_id) FILTER (benchmark = 'WTI') AS wti,
    last(price ORDER BY time, event_id) FILTER (benchmark = 'BRENT') AS brent,
    last(price ORDER BY time, event_id) FILTER (benchmark = 'DUBAI') AS dubai
  FROM dense WHERE benchmark IN ('WTI', 'BRENT', 'DUBAI') GROUP BY 1)
SELECT *, {r("wti - brent")} AS wti_brent_spread, {r("brent - dubai")} AS brent_dubai_spread,
  {r("wti - dubai")} AS wti_dubai_spread FROM closes""",
    "enrich_benchmark": f"""WITH {TICKS}, markets(b, market_exchange, market_region, base_price, sigma) AS (VALUES
  ('WTI', 'NYMEX', 'NORTH_AMERICA', 78.42::DOUBLE, 0.28::DOUBLE), ('BRENT', 'ICE', 'EUROPE', 82.15::DOUBLE, 0.25::DOUBLE),
  ('DUBAI', 'ADNOC', 'MIDDLE_EAST', 80.90::DOUBLE, 0.22::DOUBLE))
SELECT event_id, benchmark, market_exchange, market_region, base_price, sigma FROM ticks LEFT JOIN markets ON b = benchmark""",
    "alerts_price_move": f"WITH {TICKS}, {_alerts('ticks')} {_rule_out('moves')}",
    "alerts_spread": f"WITH {TICKS}, {_alerts('ticks')} {_rule_out('wide')}",
    "alerts_volatility": f"WITH {RAW}, {_alerts('raw')} {_rule_out('volatile')}",
    "alerts_all": f"WITH {RAW}, {_alerts('raw')} {_ALERT_OUT}",
    "alert_frequency": f"""WITH {TICKS}, {_alerts("ticks")}
SELECT {_bucket("10 minutes")} AS time, alert_type, count(*) AS alert_count FROM alerts GROUP BY 1, 2""",
    "alert_history": f"WITH {RAW}, {_alerts('raw')} {_ALERT_OUT} ORDER BY time DESC, event_id DESC, rule DESC LIMIT 100",
    "recent_alerts": f"""WITH {TICKS}, {_alerts("ticks")}
SELECT time, benchmark, alert_type, price, {r("delta_pct", 2)} AS pct, severity, message
FROM alerts ORDER BY time DESC, event_id DESC, rule DESC LIMIT 20""",
    "alerts_json": f"""WITH {TICKS}, {_alerts("ticks")}
SELECT benchmark AS key, {iso("time")} AS time, benchmark, alert_type, price, {r("delta")} AS delta,
  {r("delta_pct")} AS delta_pct, severity, message FROM alerts""",
    "derive_quotes": f"""WITH {RAW},
market AS (
  SELECT event_id, benchmark, {r("least(greatest(price, 30), 200)", 3)} AS price, {r("greatest(volume, 100)", 1)} AS volume,
    {r("greatest(price * volume * 100, 500000)", 0)} AS open_interest
  FROM raw)
SELECT *, {r("price - price * 0.001::DOUBLE / 2", 3)} AS bid, {r("price + price * 0.001::DOUBLE / 2", 3)} AS ask FROM market""",
    "price_band": f"""WITH {RAW}
SELECT event_id, price, CASE WHEN price >= 75 THEN 'green' WHEN price >= 60 THEN 'yellow' WHEN price >= 0 THEN 'red' END
  AS band FROM raw""",
    "live_prices": _live("ticks"),
    "live_prices_ttl": _live("dense", "time > TIMESTAMP '2024-01-01 12:00:00' - INTERVAL 60 SECOND"),
    "live_series_1h": f"WITH {_SERIES} SELECT * FROM series",
    "series_tail": f"""WITH {_SERIES},
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY benchmark ORDER BY time DESC, CAST(price AS VARCHAR) DESC) AS INTEGER)
    AS back FROM series)
SELECT benchmark, time, price, back FROM ranked WHERE back <= 10""",
    "tick_updates": f"""WITH {TICKS}, {_SESSION}
SELECT event_id, benchmark AS key, benchmark, {r("price", 3)} AS price, {r("nullif(session_vwap, 0)", 3)} AS vwap,
  {iso("time")} AS ts FROM session""",
    "latest_price": f"""WITH {TICKS}
SELECT benchmark, time, price FROM ticks WHERE benchmark = 'WTI' ORDER BY time DESC, event_id DESC LIMIT 1""",
    "latest_ticks": f"WITH {TICKS} SELECT benchmark, price, time FROM ticks ORDER BY time DESC, event_id DESC LIMIT 9",
    "latest_candles": f"""WITH {_candles()}
SELECT time, benchmark, open, high, low, close, volume, {r("vwap")} AS vwap
FROM candles ORDER BY time DESC, benchmark LIMIT 10""",
    "price_history": f"""WITH {DENSE}
SELECT {_bucket("30 seconds")} AS time, benchmark, {r("avg(price)")} AS price FROM dense
WHERE benchmark IN ('WTI', 'BRENT', 'DUBAI') AND time BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-01 12:00:00'
GROUP BY 1, 2""",
    "vwap_vs_price": f"WITH {_candles()} SELECT time, close AS price, {r('vwap')} AS vwap FROM candles WHERE benchmark = 'WTI'",
    "hourly_vwap_recent": f"""WITH {TICKS}, rolled AS ({_ohlcv("ticks", "CAST(date_trunc('hour', time) AS TIMESTAMP)")})
SELECT bucket, benchmark, {r("pv / nullif(volume, 0)")} AS vwap, volume FROM rolled
WHERE bucket > TIMESTAMP '2024-01-31' - INTERVAL 6 HOUR""",
    "minute_summary": f"""WITH {DENSE}
SELECT {_bucket("1 minute")} AS minute, benchmark, {r("avg(price)")} AS avg_price, sum(volume) AS total_volume
FROM dense WHERE time > TIMESTAMP '2024-01-01 12:00:00' - INTERVAL 12 HOUR GROUP BY 1, 2""",
    "tick_count": f"WITH {TICKS} SELECT count(*) AS count FROM ticks",
    "dq_not_null": f"""WITH {_daily()}, chosen AS (SELECT * FROM stg), {HOURS.format(source="chosen")},
pivoted AS (SELECT hour_bucket FROM hours GROUP BY hour_bucket HAVING count(DISTINCT benchmark) = 3),
{_candles()}, {_alerts("ticks")}
{_null_checks("ticks", "ticks", "time benchmark price volume")} UNION ALL
{_null_checks("candles", "candles", "time benchmark open close")} UNION ALL
{_null_checks("alerts", "alerts", "time")} UNION ALL
{_null_checks("staged", "stg", "tick_time benchmark price")} UNION ALL
{_null_checks("daily", "daily", "day_bucket benchmark")} UNION ALL
{_null_checks("spread", "pivoted", "hour_bucket")}""",
    "dq_accepted_values": f"""WITH {RAW}, {_alerts("raw")}
SELECT 'ticks' AS table_name, 'benchmark' AS column_name,
  count(*) FILTER (benchmark NOT IN ('WTI', 'BRENT', 'DUBAI', 'URALS', 'OPEC_BASKET')) AS failures FROM raw
UNION ALL
SELECT 'alerts', 'alert_type', count(*) FILTER (alert_type NOT IN ('SPIKE', 'DROP', 'SPREAD_WIDE', 'VOLATILITY')) FROM alerts""",
    "dq_range": f"""WITH {RAW}
SELECT 'ticks' AS table_name, 'price' AS column_name, count(*) FILTER (price NOT BETWEEN 0 AND 300) AS failures FROM raw""",
    "dq_unique": f"""WITH {SYNC}, {_daily()}
SELECT day_bucket AS time, benchmark, count(*) AS copies FROM daily GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL
SELECT time, benchmark, count(*) FROM sync GROUP BY 1, 2 HAVING count(*) > 1""",
    "decode_ticks_json": f"""WITH {DENSE}, {_WIRE}
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN TIMESTAMP '1970-01-01' ELSE sent_at END AS time,
  CASE WHEN event_id % 7 = 0 THEN 'UNKNOWN' ELSE benchmark END AS benchmark, exchange, price, volume, bid, ask,
  CAST(NULL AS DOUBLE) AS open_interest, source,
  CASE benchmark WHEN 'WTI' THEN 'NORTH_AMERICA' WHEN 'BRENT' THEN 'EUROPE' WHEN 'DUBAI' THEN 'MIDDLE_EAST' END AS region
FROM sent WHERE event_id % 13 <> 0 AND (event_id % 7 = 0 OR event_id % 11 <> 0)""",
    "dead_letters": f"""WITH {DENSE}
SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'unparsable' ELSE 'incomplete' END AS fault
FROM dense WHERE event_id % 13 = 0 OR (event_id % 7 <> 0 AND event_id % 11 = 0)""",
    "publish_ticks": f"""WITH {DENSE}
SELECT event_id, benchmark AS key, epoch_us(time) // 1000 AS event_time, benchmark, exchange, price, volume, bid, source,
  CASE benchmark WHEN 'WTI' THEN 'NORTH_AMERICA' WHEN 'BRENT' THEN 'EUROPE' WHEN 'DUBAI' THEN 'MIDDLE_EAST' END AS region
FROM dense""",
    "feed_adapter": f"""WITH {TICKS}
SELECT event_id, make_timestamp((epoch_us(time) // 1000) * 1000) AS time, 'WTI' AS benchmark, 'NYMEX' AS exchange,
  price, volume FROM ticks""",
    "candles_1m_json": f"""WITH {_candles()}
SELECT benchmark AS key, {iso("time")} AS time, * EXCLUDE (time, vwap), {r("vwap")} AS vwap FROM candles""",
    "insert_ignore": f"""WITH {SYNC}
SELECT DISTINCT ON (time, benchmark) event_id, time, benchmark, price FROM sync
WHERE time >= TIMESTAMP '2024-01-01 04:00:00' ORDER BY time, benchmark, event_id""",
    "write_partitioned": f"WITH {TICKS} SELECT * FROM ticks WHERE time >= TIMESTAMP '2024-01-08' AND benchmark = 'BRENT'",
    "compact": f"WITH {TICKS} SELECT * FROM ticks",
    "compact_late_rows": f"""WITH {TICKS}
SELECT *, CASE WHEN time < TIMESTAMP '2024-01-24' AND event_id % 10 > 0 THEN 'cold' ELSE 'hot' END AS stored FROM ticks""",
    "retained_ticks": f"WITH {TICKS} SELECT * FROM ticks WHERE time >= TIMESTAMP '2024-02-10' - INTERVAL 30 DAY",
    "refresh_rollup": _refreshed("hour", "", "2024-01-20 10:30:00", "2024-01-20 10:00:00", "2024-01-20 12:00:00"),
    "refresh_rollup_daily": _refreshed(
        "day", ", stddev_samp(price) AS sd", "2024-01-20 10:30:00", "2024-01-20 00:00:00", "2024-01-22 00:00:00"
    ),
    "build_models": "",
    "backfill": "",
    "replay_ticks": f"WITH {DENSE} SELECT * FROM dense",
    "replay_candles_1m": f"WITH {_candles()} {_CANDLE_OUT}",
    "replay_alerts": _alert_list("raw", RAW),
    "replay_volatility": f"""WITH {DENSE}, {_vol("dense")}
SELECT time, benchmark, {r("vol")} AS rolling_std_30, CAST(NULL AS DOUBLE) AS rolling_std_1m,
  CAST(NULL AS DOUBLE) AS atr_14, CAST(NULL AS DOUBLE) AS realized_vol
FROM vol_dense WHERE seq % 10 = 0 AND vol <> 0""",
    "replay_live_prices": _live("dense"),
    "replay_candles_1m_arrival": f"WITH {_candles('arrival_us, event_id', folded=True)} {_CANDLE_OUT}",
    "replay_alerts_arrival": f"""WITH {DENSE},
arrived AS (
  SELECT * REPLACE (row_number() OVER (ORDER BY epoch_us(time) + (event_id * 7919 % 20) * 1000000, event_id) - 1 AS event_id)
  FROM dense), {_alerts("arrived", "event_id")} {_ALERT_OUT}""",
    "storage_report": f"""WITH {TICKS}
SELECT strftime(time, '%Y-%m-%d') AS date, count(*) AS rows_before,
  count(*) FILTER (time < TIMESTAMP '2024-01-24') AS rows_after, bool_and(time < TIMESTAMP '2024-01-24') AS fewer_files,
  bool_and(time < TIMESTAMP '2024-01-24') AS compacted, bool_and(time >= TIMESTAMP '2024-01-24') AS waiting
FROM ticks GROUP BY 1""",
}
ORACLES["candles_5m_json"] = ORACLES["candles_5m"]
ORACLES["replay_candles_5m"] = (
    f"WITH {DENSE} SELECT * FROM ({ORACLES['candles_5m']}) WHERE window_end <= epoch_ms({_CLOSED})"
)
ORACLES["replay_spread_5m"] = (
    f"WITH {DENSE} SELECT * FROM ({ORACLES['stream_spread_5m']}) WHERE time + INTERVAL 5 MINUTE <= {_CLOSED}"
)
ORACLES["replay_realized_vol"] = (
    f"WITH {DENSE} SELECT * FROM ({ORACLES['realized_vol_1h']}) WHERE window_end <= {_CLOSED}"
)
for _name in ("latest_price", "latest_ticks", "latest_candles", "recent_alerts", "alert_history"):
    ORACLES[f"stored_{_name}"] = ORACLES[_name]
ORACLES["replay_series_1h"] = ORACLES["live_series_1h"]
ORACLES["replay_alert_history"] = ORACLES["alert_history"]
_DENSE_SESSION = _SESSION.replace("FROM ticks", "FROM dense")
ORACLES["replay_updates"] = f"""WITH {DENSE}, {_DENSE_SESSION}
SELECT benchmark AS key, benchmark, {r("price", 3)} AS price, {r("nullif(session_vwap, 0)", 3)} AS vwap, {iso("time")} AS ts
FROM session"""
ORACLES["replay_vwap"] = f"""WITH {DENSE}, {_DENSE_SESSION}
SELECT benchmark AS key, benchmark, {r("session_vwap", 4)} AS vwap, {iso("time")} AS time FROM session WHERE session_vwap IS NOT NULL"""
ORACLES["replay_candles_5m_json"] = ORACLES["replay_candles_5m"]
_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S') || CASE WHEN epoch_us({}) % 1000000 = 0 THEN '' ELSE rtrim(strftime({}, '.%f'), '0') END"


def _model(name: str, time: str, label: str, one: str, two: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS model, {_STAMP.format(time, time, time)} AS time, {label} AS name, {r(one, 4)} AS one, {r(two, 4)} AS two "
        f"FROM {source}"
    )


ORACLES["build_models"] = " UNION ALL ".join(
    [
        _model("daily_analytics", "CAST(day_bucket AS TIMESTAMP)", "benchmark", "close", "price_change", f"({ORACLES['daily_analytics']})"),
        _model("spread_analysis", "hour_bucket", "spread_regime", "wti_brent_spread", "wti_dubai_spread", f"({ORACLES['spread_analysis']})"),
        _model("stg_ticks", "tick_time", "benchmark", "price", "volume", f"({ORACLES['stg_ticks']})"),
    ]
)


def _contents(name: str, one: str, two: str, source: str, time: str = "time") -> str:
    return f"SELECT '{name}' AS table_name, {time} AS time, benchmark, {r(one, 5)} AS one, {r(two, 5)} AS two FROM {source}"


ORACLES["backfill"] = f"""WITH {_candles()}, {_alerts("dense")},
five AS ({ORACLES["candles_5m"]}),
hours AS ({ORACLES["realized_vol_1h"]}),
sampled AS (SELECT *, {_bucket("5 minutes")} AS ended FROM vol_dense WHERE seq % 10 = 0 AND vol <> 0),
measured AS (
  SELECT s.time, s.benchmark, s.vol, h.realized_vol FROM sampled s
  LEFT JOIN hours h ON h.benchmark = s.benchmark AND h.window_end = s.ended)
{_contents("ticks", "price", "volume", "dense")}
UNION ALL {_contents("candles_1m", "close", "vwap", "candles")}
UNION ALL {_contents("candles_5m", "close", "vwap", "five", "make_timestamp(window_start * 1000)")}
UNION ALL {_contents("alerts", "price", "delta", "alerts")}
UNION ALL {_contents("volatility", "vol", "realized_vol", "measured")}"""
