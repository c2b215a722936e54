"""The registered queries as ANSI SQL over the same tables."""

from __future__ import annotations

_SMA = "round(sma + 1e-9, 6)"  # exact ties lifted clear of summation noise, as the Spark side does


_TICKS = """
raw AS (
  SELECT event_type AS symbol, ts AS event_timestamp, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume, event_id
  FROM events),
ticks AS (
  SELECT symbol, event_timestamp, price, volume, event_id, price * volume AS price_x_volume
  FROM raw
  WHERE symbol IS NOT NULL AND price IS NOT NULL AND volume IS NOT NULL
    AND event_timestamp IS NOT NULL AND volume > 0)"""

_WINDOWS = _TICKS + f""",
spread AS (
  SELECT symbol, price_x_volume, volume,
         date_trunc('minute', event_timestamp) - i * INTERVAL 1 MINUTE AS window_start
  FROM ticks, range(5) AS r(i)),
windows AS (
  SELECT symbol, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
         round(sum(price_x_volume), 4) AS weighted_price_sum, sum(volume) AS volume_sum,
         round(sum(price_x_volume) / sum(volume), 8) AS vwap
  FROM spread GROUP BY symbol, window_start HAVING sum(volume) > 0)"""

_CANDLES = """
candles AS (
  SELECT event_type AS symbol, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
         CASE event_id % 4 WHEN 1 THEN date_trunc('milliseconds', ts)
                           WHEN 2 THEN date_trunc('second', ts) ELSE ts END AS event_timestamp,
         event_id % 4 AS form
  FROM events)"""

_BARS = """
bars AS (
  SELECT date_trunc('day', o_orderdate) AS datetime, o_orderpriority AS symbol,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2)"""

_SERIES = _BARS + """,
series AS (
  SELECT *, row_number() OVER w AS rn, lag(close) OVER w AS prev_close, close - lag(close) OVER w AS delta
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY datetime)),
moves AS (
  SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0.0 END AS gain,
            CASE WHEN delta < 0 THEN -delta ELSE 0.0 END AS loss
  FROM series),
means AS (
  SELECT *, avg(close) OVER (PARTITION BY symbol ORDER BY rn ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS sma,
         avg(gain) OVER w14 AS avg_gain, avg(loss) OVER w14 AS avg_loss
  FROM moves
  WINDOW w14 AS (PARTITION BY symbol ORDER BY rn ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
simple AS (
  SELECT *, CASE WHEN avg_loss = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + avg_gain / avg_loss) END AS rsi
  FROM means)"""


def _ema(name: str, span: int, rows: int) -> str:
    weight = f"pow({1.0 - 2.0 / (span + 1.0)!r}, a.rn - b.rn)"
    return f""",
{name} AS (
  SELECT a.symbol, a.rn, sum(b.close * {weight}) / sum({weight}) AS value
  FROM series a JOIN series b ON a.symbol = b.symbol AND b.rn BETWEEN a.rn - {rows - 1} AND a.rn
  GROUP BY a.symbol, a.rn)"""


_GOLD = _SERIES + _ema("e50", 50, 300) + _ema("e12", 12, 200) + _ema("e26", 26, 300)
_EMAS = "JOIN e12 USING (symbol, rn) JOIN e26 USING (symbol, rn)"
_GOLD_ROWS = f"""
SELECT datetime, symbol, open, high, low, close, volume, CAST(year(datetime) AS INTEGER) AS year,
       {_SMA} AS "SMA_200", round(e50.value, 4) AS "EMA_50", round(rsi, 8) AS "RSI_14",
       round(e12.value - e26.value, 4) AS "MACD"
FROM simple JOIN e50 USING (symbol, rn) {_EMAS}"""

_PAIRS = _WINDOWS + """,
messages AS (
  SELECT symbol, event_timestamp AS arrival, 0 AS side, event_id AS seq, price AS value,
         CAST(NULL AS TIMESTAMP) AS window_start, CAST(NULL AS TIMESTAMP) AS window_end
  FROM ticks
  UNION ALL
  SELECT symbol, window_end, 1, 0, vwap, window_start, window_end FROM windows),
ordered AS (
  SELECT *, row_number() OVER w AS pos, lag(side) OVER w AS prev_side, lag(value) OVER w AS prev_value,
         lag(window_start) OVER w AS prev_start, lag(window_end) OVER w AS prev_end
  FROM messages WINDOW w AS (PARTITION BY symbol ORDER BY arrival, side, seq)),
runs AS (
  SELECT *, max(CASE WHEN prev_side IS NULL OR prev_side = side THEN pos END)
              OVER (PARTITION BY symbol ORDER BY pos) AS run_start
  FROM ordered),
pairs AS (
  SELECT symbol, arrival AS paired_at,
         CASE WHEN side = 0 THEN value ELSE prev_value END AS close,
         CASE WHEN side = 0 THEN prev_value ELSE value END AS vwap,
         CASE WHEN side = 0 THEN prev_start ELSE window_start END AS window_start,
         CASE WHEN side = 0 THEN prev_end ELSE window_end END AS window_end
  FROM runs WHERE (pos - run_start) % 2 = 1)"""

_MEASURES = f"""WITH {_PAIRS}
SELECT symbol, 'quotes' AS source_topic, CAST(window_start AS VARCHAR) AS window_start,
       CAST(window_end AS VARCHAR) AS window_end, CAST(window_end AS VARCHAR) AS event_ts,
       'close' AS measure_name, close AS measure_value, window_end AS time, epoch_ms(window_end) AS version
FROM pairs
UNION ALL
SELECT symbol, 'vwap', CAST(window_start AS VARCHAR), CAST(window_end AS VARCHAR), NULL,
       'vwap', vwap, window_end, epoch_ms(window_end) + 1
FROM pairs"""

_WINDOW_ROWS = "SELECT symbol, window_start, window_end, weighted_price_sum, volume_sum, vwap FROM windows"
_BAR_ROWS = "SELECT datetime, symbol, open, high, low, close, volume FROM bars"
_BAR_YEAR_ROWS = (
    "SELECT datetime, symbol, open, high, low, close, volume, CAST(year(datetime) AS INTEGER) AS year FROM bars"
)
_LATEST = (
    f"WITH {_WINDOWS} {_WINDOW_ROWS} WHERE window_end <= (SELECT max(ts) FROM events)"
    " QUALIFY rank() OVER (PARTITION BY symbol ORDER BY window_end DESC) = 1"
)


def _tick_bars(unit: str | None = None, minutes: int = 0) -> str:
    start = f"date_trunc('{unit}', event_timestamp)" if unit else f"time_bucket(INTERVAL {minutes} MINUTE, event_timestamp)"
    return f"""WITH {_TICKS}
SELECT {start}::TIMESTAMP AS datetime, symbol,
       arg_min(price, (event_timestamp, event_id)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (event_timestamp, event_id)) AS close, sum(volume) AS volume
FROM ticks GROUP BY 1, 2"""


def _closed_windows(delay: str) -> str:
    return f"""WITH {_WINDOWS} {_WINDOW_ROWS}
WHERE window_end <= (SELECT max(event_timestamp) FROM ticks) - INTERVAL {delay}"""


def _last_of_known(n: int) -> str:
    return f"""WITH {_BARS} {_BAR_ROWS} WHERE day(datetime) NOT IN (13, 17)
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) <= {n}"""


_EMA_50 = f"""WITH {_SERIES}{_ema("e50", 50, 300)}
SELECT symbol, datetime, close, round(e50.value, 4) AS "EMA_50" FROM simple JOIN e50 USING (symbol, rn)"""

_CLEAN_CANDLES = f"""WITH {_CANDLES}
SELECT symbol, price, volume, event_timestamp, price * volume AS price_x_volume FROM candles WHERE volume > 0"""

_PUBLISHED = """
SELECT symbol AS key,
       '{"symbol":"' || symbol || '","@timestamp":"' || strftime(closed_at, '%Y-%m-%dT%H:%M:%S.%fZ')
       || '","close":"' || CAST(price AS VARCHAR) || '","volume":"' || CAST(volume AS VARCHAR) || '"}' AS value
FROM (SELECT event_type AS symbol, value AS price, date_trunc('milliseconds', ts) AS closed_at,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume FROM events)
WHERE volume % 2 = 0"""

_TOPIC_PAIRS = _PAIRS.replace("  FROM ticks\n  UNION ALL", "  FROM raw WHERE price IS NOT NULL AND event_id % 7 <> 0\n  UNION ALL", 1).replace(
    "SELECT symbol, window_end, 1, 0, vwap, window_start, window_end FROM windows)",
    "SELECT symbol, window_end, 1, 0, vwap, window_start, window_end FROM windows WHERE minute(window_end) % 5 NOT IN (0, 1))",
    1,
)

# the newest closed window of each symbol; the silent one's is the last of the first quarter
_SPARSE = f"""WITH span AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events), {_TICKS.replace(
    "FROM events)", "FROM events WHERE event_type <> 'purchase' OR ts < (SELECT lo + (hi - lo) / 4 FROM span))", 1
)}{_WINDOWS.removeprefix(_TICKS)} {_WINDOW_ROWS} WHERE window_end <= (SELECT hi FROM span)
QUALIFY rank() OVER (PARTITION BY symbol ORDER BY window_end DESC) = 1"""


ORACLE: dict[str, str] = {
    "ticks": f"WITH {_TICKS} SELECT * FROM ticks",
    "symbol_filter": f"WITH {_TICKS} SELECT * FROM ticks WHERE symbol = 'purchase'",
    "normalise_candles": _CLEAN_CANDLES,
    "closed_candles": f"""WITH {_CANDLES}
SELECT symbol, price, volume, event_timestamp, price * volume AS price_x_volume FROM candles
WHERE volume > 0 AND (form <> 1 OR volume % 2 = 0)""",
    "publish_candles": _PUBLISHED,
    "topic_roundtrip": _PUBLISHED,
    "topic_stream": _CLEAN_CANDLES,
    "parse_times": """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN ts WHEN 1 THEN date_trunc('second', ts) END AS parsed FROM events""",
    "epoch_iso": """
SELECT event_id, epoch_us(ts) // 1000 AS ms,
       strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS iso, epoch_us(ts) // 1000 AS back_ms
FROM events""",
    "format_symbol": """
SELECT c_custkey,
       CASE WHEN c_custkey % 3 = 0 THEN 'X:' || c_name
            WHEN c_custkey % 2 = 0 THEN c_mktsegment || ':' || c_name || c_nationkey || '!'
            ELSE c_mktsegment || ':' || c_name END AS full_symbol
FROM customer""",
    "strip_markup": """
SELECT p_partkey, p_brand || p_partkey AS symbol, p_name AS description, p_type AS exchange FROM part""",
    "payload_to_bars": f"WITH {_BARS} {_BAR_ROWS}",
    "vwap_sliding": f"WITH {_WINDOWS} {_WINDOW_ROWS}",
    "vwap_plain": f"""WITH {_TICKS}
SELECT symbol, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
       round(sum(price * volume) / nullif(sum(volume), 0), 8) AS vwap
FROM (SELECT *, date_trunc('minute', event_timestamp) - i * INTERVAL 1 MINUTE AS window_start
      FROM raw, range(5) AS r(i))
GROUP BY symbol, window_start""",
    "vwap_json": f"""WITH {_WINDOWS}
SELECT symbol AS key,
       '{{"calculation_time":"' || strftime(window_end, '%Y-%m-%dT%H:%M:%S.%g')
       || '","window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S.%g')
       || '","window_end":"' || strftime(window_end, '%Y-%m-%dT%H:%M:%S.%g')
       || '","symbol":"' || symbol || '","vwap":' || CAST(vwap AS VARCHAR)
       || ',"volume_sum":' || CAST(volume_sum AS VARCHAR) || '}}' AS value
FROM windows""",
    "vwap_latest_closed": _LATEST,
    "bars_1m": _tick_bars("minute"),
    "bars_3m": _tick_bars(minutes=3),
    "bars_5m": _tick_bars(minutes=5),
    "bars_15m": _tick_bars(minutes=15),
    "bars_30m": _tick_bars(minutes=30),
    "bars_2h": _tick_bars(minutes=120),
    "bars_3h": _tick_bars(minutes=180),
    "bars_45m": _tick_bars(minutes=45),
    "bars_1h": _tick_bars("hour"),
    "bars_4h": _tick_bars(minutes=240),
    "bars_daily": _tick_bars("day"),
    "bars_weekly": _tick_bars("week"),
    "bars_monthly": _tick_bars("month"),
    "bars_rollup": _tick_bars("month"),
    "daily_bars": f"WITH {_BARS} {_BAR_ROWS}",
    "last_n_bars": f"""WITH {_BARS} {_BAR_ROWS}
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) <= 1460""",
    "last_n_bars_1000": _last_of_known(1000),
    "last_n_bars_1001": _last_of_known(1001),
    "bar_history": f"""WITH {_TICKS}
SELECT date_trunc('hour', event_timestamp)::TIMESTAMP AS datetime, 'EVT:' || symbol AS symbol,
       arg_min(price, (event_timestamp, event_id)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (event_timestamp, event_id)) AS close, sum(volume) AS volume
FROM ticks WHERE symbol = 'purchase' GROUP BY 1, 2
QUALIFY row_number() OVER (ORDER BY datetime DESC) <= 200""",
    "returns": f"""WITH {_SERIES}
SELECT symbol, datetime, close, round(prev_close, 2) AS prev_close, round(delta, 2) AS delta,
       round(gain, 2) AS gain, round(loss, 2) AS loss FROM moves""",
    "sma_200": f"""WITH {_SERIES} SELECT symbol, datetime, close, {_SMA} AS "SMA_200" FROM simple""",
    "rsi_14": f"""WITH {_SERIES} SELECT symbol, datetime, close, round(rsi, 8) AS "RSI_14" FROM simple""",
    "ema_50": _EMA_50,
    "ema_from_history": _EMA_50,
    "macd": f"""WITH {_SERIES}{_ema("e12", 12, 200)}{_ema("e26", 26, 300)}
SELECT symbol, datetime, close, round(e12.value, 5) AS "EMA_12", round(e26.value, 4) AS "EMA_26",
       round(e12.value - e26.value, 4) AS "MACD"
FROM simple {_EMAS}""",
    "indicators": f"WITH {_GOLD} {_GOLD_ROWS}",
    "indicators_irregular": f"""WITH
moves AS (
  SELECT event_type AS symbol, ts AS datetime, value AS close, event_id,
         value - lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS delta
  FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL),
means AS (
  SELECT *, avg(close) OVER (s ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS sma,
         avg(CASE WHEN delta > 0 THEN delta ELSE 0.0 END) OVER (s ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS gain,
         avg(CASE WHEN delta < 0 THEN -delta ELSE 0.0 END) OVER (s ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS loss
  FROM moves WINDOW s AS (PARTITION BY symbol ORDER BY datetime, event_id))
SELECT symbol, datetime, close, event_id, {_SMA} AS "SMA_200",
       round(CASE WHEN loss = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + gain / loss) END, 8) AS "RSI_14"
FROM means""",
    "pair_asof": f"""WITH {_WINDOWS}
SELECT w.symbol, w.window_end, w.vwap, t.event_timestamp AS quote_time, t.price AS close
FROM windows w ASOF JOIN ticks t ON w.symbol = t.symbol AND w.window_end > t.event_timestamp""",
    "pair_asof_offgrid": f"""WITH {_WINDOWS}, late AS (SELECT symbol, window_end + INTERVAL 30 SECOND AS window_end, vwap FROM windows)
SELECT w.symbol, w.window_end, w.vwap, t.event_timestamp AS quote_time, t.price AS close
FROM late w ASOF JOIN ticks t ON w.symbol = t.symbol AND w.window_end > t.event_timestamp""",
    "pair_asof_stream": f"""WITH {_WINDOWS}
SELECT w.symbol, w.window_start, w.window_end, w.vwap, t.event_timestamp AS quote_time, t.price AS close
FROM windows w ASOF JOIN ticks t ON w.symbol = t.symbol AND w.window_end > t.event_timestamp
WHERE date_trunc('minute', t.event_timestamp) + INTERVAL 1 MINUTE > w.window_end - INTERVAL 10 MINUTE
  AND w.window_end <= (SELECT max(event_timestamp) FROM ticks) - INTERVAL 12 MINUTE""",
    "pair_latest": f"WITH {_PAIRS} SELECT * FROM pairs",
    "pair_topics": f"WITH {_TOPIC_PAIRS} SELECT * FROM pairs",
    "measures_long": _MEASURES,
    "measures_latest": f"""WITH {_TICKS}
SELECT symbol, 'close' AS measure_name, arg_max(price, (event_timestamp, price)) AS measure_value,
       date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS time, max(epoch_us(event_timestamp)) AS version
FROM ticks GROUP BY symbol, date_trunc('hour', event_timestamp)""",
    "csv_roundtrip": f"WITH {_BARS} {_BAR_YEAR_ROWS}",
    "silver_roundtrip": f"WITH {_BARS} {_BAR_ROWS}",
    "gold_roundtrip": f"WITH {_GOLD} {_GOLD_ROWS}",
    "gold_text_times": f"""WITH {_GOLD.replace("GROUP BY 1, 2)", "WHERE day(o_orderdate) <> 13 GROUP BY 1, 2)", 1)} {_GOLD_ROWS}""",
    "land_csv": f"WITH {_BARS} {_BAR_YEAR_ROWS}",
    "catalog_scan": f"WITH {_BARS} {_BAR_YEAR_ROWS}",
    "vwap_stream_append": _closed_windows("2 MINUTE"),
    "vwap_stream_append0": _closed_windows("0 SECOND"),
    "vwap_stream_update": f"WITH {_WINDOWS} {_WINDOW_ROWS}",
    "vwap_stream_latest": _LATEST,
    "vwap_stream_sparse": _SPARSE,
    "vwap_stream_late": _closed_windows("2 MINUTE"),
    "vwap_stream_json": f"""WITH {_CANDLES},
closed AS (SELECT * FROM candles WHERE volume > 0 AND (form <> 1 OR volume % 2 = 0)),
windows AS (
  SELECT symbol, date_trunc('minute', event_timestamp) - i * INTERVAL 1 MINUTE AS window_start,
         sum(price * volume) AS pv, sum(volume) AS volume_sum
  FROM closed, range(5) AS r(i) GROUP BY 1, 2)
SELECT symbol AS key, window_start + INTERVAL 5 MINUTE AS calculation_time, window_start,
       window_start + INTERVAL 5 MINUTE AS window_end, symbol, round(pv / volume_sum, 8) AS vwap, volume_sum
FROM windows
WHERE window_start + INTERVAL 5 MINUTE <= (SELECT max(event_timestamp) FROM closed) - INTERVAL 2 MINUTE""",
    "measures_store": _MEASURES,
    "pair_stream": f"WITH {_PAIRS} SELECT * FROM pairs",
}
