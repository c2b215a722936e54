"""Timestamps, epoch milliseconds and ISO text, all in UTC."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, functions as F

from tickloom.schemas import Interval, interval

# Candle times come with up to six fraction digits or none. One
# pattern with an optional part, because a pattern that fails costs an exception.
CANDLE_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]X"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(text: str) -> int | None:
    """Seconds of a plain duration such as ``5 minutes``; None for any other form."""
    found = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day|week)s?\s*", text.lower())
    return int(found[1]) * _UNIT_SECONDS[found[2]] if found else None


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(text: Column | str, *patterns: str) -> Column:
    """First pattern that fits, else NULL; without patterns the default format."""
    text = _col(text)
    if not patterns:
        return F.try_to_timestamp(text)
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(p)) for p in patterns))


def parse_candle_time(text: Column | str) -> Column:
    return parse_time(text, CANDLE_TIME)


def millis_to_time(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp, milliseconds kept."""
    return F.timestamp_millis(_col(ms))


def millis_to_iso(ms: Column | str) -> Column:
    """Epoch milliseconds to ISO text in UTC with a ``Z``."""
    return F.date_format(F.timestamp_millis(_col(ms)), ISO_MICROS)


def iso_to_millis(text: Column | str) -> Column:
    """ISO text to epoch milliseconds; text without a zone counts as UTC."""
    return F.unix_millis(F.try_to_timestamp(_col(text)))


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def ntz(ts: Column | str) -> Column:
    """UTC wall time without a zone (the form tables are stored in)."""
    return _col(ts).cast("timestamp_ntz")


def order_key(ts: Column | str, seq: Column | str) -> Column:
    """One fixed-width number that orders by time and then by a whole number.

    A single decimal keeps ``min_by`` and ``max_by`` in hash aggregates, where a struct
    would have every map task sort its rows. NULL without a time; a NULL number is 0.
    """
    micros = F.unix_micros(_col(ts).cast("timestamp")).cast("decimal(38,0)")
    number = F.coalesce(_col(seq).cast("decimal(20,0)"), F.lit(0)) + F.lit(Decimal(2**63)).cast("decimal(20,0)")
    return (micros * F.lit(Decimal(10**20)).cast("decimal(21,0)") + number).cast("decimal(38,0)")


def on_grid(ts: Column, step: str) -> Column:
    """``ts``, or an error where it is no multiple of ``step``."""
    micros = F.unix_micros(ts.cast("timestamp"))
    off = micros % (duration_seconds(step) * 1_000_000) != 0
    return F.when(off, F.raise_error(F.concat(ts.cast("string"), F.lit(f" is off the grid of {step}")))).otherwise(ts)


def localise(ts: Column | str, zone: str) -> Column:
    """UTC to the wall time of ``zone``, e.g. to reproduce locally stamped bars."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ntz(ts))


def bar_start(ts: Column | str, size: str | Interval) -> Column:
    """Start of the bar holding ``ts``: weeks start on Monday, months on the 1st."""
    size, ts = interval(size), _col(ts)
    if size.code == "1M":
        return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")
    if size.code == "1W":
        return F.window(ts, size.duration, size.duration, "4 days")["start"]
    return F.window(ts, size.duration)["start"]
