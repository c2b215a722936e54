"""Row shapes and the interval table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

BAR = T.StructType(
    [
        T.StructField("datetime", T.TimestampNTZType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
    ]
)
BAR_COLUMNS = BAR.fieldNames()

# One message type for both candle shapes; numbers stay text until the tolerant cast.
KLINE = T.StructType(
    [
        T.StructField("T", T.LongType()),
        T.StructField("s", T.StringType()),
        T.StructField("i", T.StringType()),
        T.StructField("c", T.StringType()),
        T.StructField("v", T.StringType()),
        T.StructField("x", T.StringType()),
    ]
)
CANDLE_MESSAGE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("@timestamp", T.StringType()),
        T.StructField("close", T.StringType()),
        T.StructField("volume", T.StringType()),
        T.StructField("s", T.StringType()),
        T.StructField("k", KLINE),
    ]
)
VWAP_MESSAGE = T.StructType(
    [
        T.StructField("calculation_time", T.StringType()),
        T.StructField("window_start", T.StringType()),
        T.StructField("window_end", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("vwap", T.StringType()),
        T.StructField("volume_sum", T.StringType()),
    ]
)
MEASURE = T.StructType(
    [
        T.StructField("dimensions", T.MapType(T.StringType(), T.StringType())),
        T.StructField("measure_name", T.StringType()),
        T.StructField("measure_value", T.DoubleType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("version", T.LongType()),
    ]
)
TOPIC_ROW = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Interval:
    """A bar size: ``code`` as users type it, ``seconds`` its shortest length."""

    code: str
    duration: str
    seconds: int


_MINUTE, _HOUR, _DAY = 60, 3600, 86400

# The thirteen bar sizes.
INTERVALS = {
    i.code: i
    for i in (
        Interval("1", "1 minute", _MINUTE),
        Interval("3", "3 minutes", 3 * _MINUTE),
        Interval("5", "5 minutes", 5 * _MINUTE),
        Interval("15", "15 minutes", 15 * _MINUTE),
        Interval("30", "30 minutes", 30 * _MINUTE),
        Interval("45", "45 minutes", 45 * _MINUTE),
        Interval("1H", "1 hour", _HOUR),
        Interval("2H", "2 hours", 2 * _HOUR),
        Interval("3H", "3 hours", 3 * _HOUR),
        Interval("4H", "4 hours", 4 * _HOUR),
        Interval("1D", "1 day", _DAY),
        Interval("1W", "7 days", 7 * _DAY),
        Interval("1M", "1 month", 28 * _DAY),
    )
}


def interval(code: str | Interval) -> Interval:
    """Look an interval up by its code."""
    if isinstance(code, Interval):
        return code
    if code not in INTERVALS:
        raise ValueError(f"unknown interval {code!r}; one of {', '.join(INTERVALS)}")
    return INTERVALS[code]
