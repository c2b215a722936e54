"""Volume-weighted average price over sliding windows, batch and streaming."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numbers import ratio
from tickloom.functions.times import duration_seconds


def _sums(df: DataFrame, group: Column, weighted: str = "price_x_volume", volume: str = "volume") -> DataFrame:
    return df.groupBy(group, "symbol").agg(
        F.sum(weighted).alias("weighted_price_sum"), F.sum(volume).alias("volume_sum")
    )


def _nested_sums(ticks: DataFrame, size: str, slide: str) -> DataFrame:
    """Sums per slide, then per window. Start times alone are the keys, half a window struct."""
    panes = _sums(ticks, F.window("event_timestamp", slide)["start"].alias("pane"))
    spread = panes.withColumn("start", F.window("pane", size, slide)["start"])
    sums = _sums(spread, F.col("start"), "weighted_price_sum", "volume_sum")
    end = F.col("start") + F.expr(f"interval {duration_seconds(size)} seconds")
    return sums.select(
        F.struct("start", end.alias("end")).alias("window"), "symbol", "weighted_price_sum", "volume_sum"
    )


def _chained_sums(ticks: DataFrame, size: str, slide: str) -> DataFrame:
    """The same of a stream in two states: a pane is handed on once, when the watermark closes it."""
    panes = _sums(ticks, F.window("event_timestamp", slide).alias("pane"))
    over = F.window(F.window_time("pane"), size, slide).alias("window")
    return _sums(panes, over, "weighted_price_sum", "volume_sum")


def _whole_slides(size: str, slide: str) -> bool:
    """True when windows are made of more than one whole slide."""
    length, step = duration_seconds(size), duration_seconds(slide)
    return bool(length and step) and length > step and length % step == 0


def vwap(
    ticks: DataFrame,
    size: str = "5 minutes",
    slide: str = "1 minute",
    *,
    watermark: str | None = None,
    positive_volume: bool = True,
    round_to: int | None = 8,
    nested: bool | None = None,
) -> DataFrame:
    """``window, symbol, weighted_price_sum, volume_sum, vwap`` per half-open window.

    In batch, ticks are first summed per slide and only those panes are spread
    over the windows holding them (``nested``, where the size is a multiple of the
    slide): a tick is hashed once, not once per window, and any hot symbol or
    minute shrinks map-side.

    A stream needs a ``watermark`` to let go of old state. It keeps one aggregate, so that
    every output mode works, unless ``nested`` is asked for: then a tick
    enters the state of its pane alone, and the panes that the watermark closes
    enter that of the windows. This works in append mode, and emits the same windows in the same
    micro-batches. A tick that comes after its pane was closed counts in no window; with one
    aggregate it still counts in those of its windows that are open.
    """
    if ticks.isStreaming:
        if watermark is None:
            raise ValueError("a stream needs a watermark, or its state grows without end")
        timed = ticks.withWatermark("event_timestamp", watermark)
        if nested and _whole_slides(size, slide):
            sums = _chained_sums(timed, size, slide)
        else:
            sums = _sums(timed, F.window("event_timestamp", size, slide).alias("window"))
    elif nested is not False and _whole_slides(size, slide):
        sums = _nested_sums(ticks, size, slide)
    else:
        sums = _sums(ticks, F.window("event_timestamp", size, slide).alias("window"))
    if positive_volume:
        sums = sums.filter(F.col("volume_sum") > 0)
    return sums.withColumn("vwap", ratio(F.col("weighted_price_sum"), F.col("volume_sum"), round_to))


def flat_windows(windows: DataFrame) -> DataFrame:
    """Replace the window struct by ``window_start`` and ``window_end`` (UTC, no zone)."""
    rest = [c for c in windows.columns if c != "window"]
    return windows.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *rest,
    )


def latest_closed(windows: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Per symbol the newest window (flat form) that has ended by ``as_of``, default now.

    One aggregate with fixed-width state; windows are unique per symbol, so no
    join back is needed.
    """
    if as_of is None:
        as_of = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(as_of, datetime):
        as_of = F.lit(as_of).cast("timestamp_ntz")
    values = [c for c in windows.columns if c not in ("symbol", "window_end")]
    return (
        windows.filter(F.col("window_end") <= as_of)
        .groupBy("symbol")
        .agg(F.max("window_end").alias("window_end"), *(F.max_by(c, "window_end").alias(c) for c in values))
        .select(*windows.columns)
    )


def vwap_messages(
    windows: DataFrame, calculation_time: bool = True, volume_sum: bool = True, extra: Sequence[str] = ()
) -> DataFrame:
    """Flat windows to ``key, value`` messages; ``extra`` columns stay beside them."""
    fields = ["window_start", "window_end", "symbol", "vwap"]
    columns = [F.col(f) for f in fields]
    if calculation_time:
        columns.insert(0, F.col("window_end").alias("calculation_time"))
    if volume_sum:
        columns.append(F.col("volume_sum"))
    return windows.select(F.col("symbol").cast("string").alias("key"), F.to_json(F.struct(*columns)).alias("value"), *extra)
