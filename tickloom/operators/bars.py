"""OHLCV bars from ticks, coarser bars from finer ones, and bar history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.text import format_symbol
from tickloom.functions.times import bar_start
from tickloom.operators.blocks import newest_rows
from tickloom.schemas import BAR_COLUMNS, Interval, interval


def ohlcv(
    ticks: DataFrame,
    size: str | Interval,
    *,
    time: str = "event_timestamp",
    price: str = "price",
    volume: Column | str = "volume",
    order: Column | str | None = None,
) -> DataFrame:
    """Aggregate ticks to bars of one size.

    Each aggregate combines map-side, so a symbol or bar holding most of the rows
    costs one row per map task in the shuffle. ``order`` decides first and last;
    it defaults to the tick time. A single fixed-width column (time, sequence
    number) keeps the hash aggregate; a struct of time and a tie-break is exact
    for equal times at the price of a map-side sort.
    """
    order = time if order is None else order
    bars = ticks.groupBy("symbol", bar_start(time, size).cast("timestamp_ntz").alias("datetime")).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum(volume).alias("volume"),
    )
    return bars.select(*BAR_COLUMNS)


def rollup_bars(bars: DataFrame, size: str | Interval) -> DataFrame:
    """Bars of a coarser size from finer bars (sizes must nest)."""
    coarse = bars.groupBy("symbol", bar_start("datetime", size).cast("timestamp_ntz").alias("start")).agg(
        F.min_by("open", "datetime").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "datetime").alias("close"),
        F.sum("volume").alias("volume"),
    )
    return coarse.withColumnRenamed("start", "datetime").select(*BAR_COLUMNS)


def last_n_bars(bars: DataFrame, n: int, size: str | Interval = "1D") -> DataFrame:
    """The ``n`` most recent bars of each symbol, by one plan for every ``n``.

    Bars without a symbol or a time belong to no series and are left out. Bars are
    ranked within stretches of time and by the counts of the newer stretches, so
    neither a long series nor a large ``n`` meets in one task.
    """
    return newest_rows(bars, "symbol", "datetime", interval(size).seconds, n)


def bar_history(
    ticks: DataFrame,
    symbol: str,
    exchange: str = "NSE",
    size: str | Interval = "1D",
    n_bars: int = 10,
    contract: int | None = None,
    **columns: Column | str,
) -> DataFrame:
    """Last ``n_bars`` bars of one instrument, ascending by time; columns as for ``ohlcv``."""
    name = format_symbol(F.lit(symbol), F.lit(exchange), contract)
    one = ticks.filter(F.col("symbol") == name)
    return last_n_bars(ohlcv(one, size, **columns), n_bars, size).orderBy("datetime")
