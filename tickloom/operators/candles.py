"""Candle messages: read both payload shapes, publish closed candles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numbers import to_double
from tickloom.functions.times import millis_to_iso, millis_to_time, parse_candle_time
from tickloom.schemas import CANDLE_MESSAGE


def computed_once(df: DataFrame) -> DataFrame:
    """Pin the columns of ``df``: each is computed once per row.

    A filter on parsed columns is pushed below the projection that parses them, and
    then parses the text again for every condition. Filters stay above a generator.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def parse_messages(topic: DataFrame) -> DataFrame:
    """Topic rows to ``key, broker_time, data``; text that is not JSON gives NULL fields."""
    return computed_once(
        topic.select(
            F.col("key").cast("string").alias("key"),
            F.col("timestamp").alias("broker_time"),
            F.from_json(F.col("value").cast("string"), CANDLE_MESSAGE).alias("data"),
        )
    )


def is_closed() -> Column:
    """True for finished candles; the simplified shape is only ever sent finished."""
    flag = F.col("data.k.x")
    return flag.isNull() | (F.lower(flag) == "true")


def clean_ticks(df: DataFrame, positive_volume: bool = True) -> DataFrame:
    """Keep rows with symbol, price, volume and time, and add ``price_x_volume``."""
    keep = (
        F.col("symbol").isNotNull()
        & F.col("price").isNotNull()
        & F.col("volume").isNotNull()
        & F.col("event_timestamp").isNotNull()
    )
    if positive_volume:
        keep = keep & (F.col("volume") > 0)
    return df.filter(keep).withColumn("price_x_volume", F.col("price") * F.col("volume"))


def normalise_candles(topic: DataFrame, closed_only: bool = True, positive_volume: bool = True) -> DataFrame:
    """Topic rows of either shape to clean ticks.

    Field precedence: the simplified field, then the raw kline's, then the record
    key (symbol) or the broker's time stamp (time).
    """
    parsed = parse_messages(topic)
    if closed_only:
        parsed = parsed.filter(is_closed())
    ticks = parsed.select(
        F.coalesce("data.symbol", "data.k.s", "data.s", "key").alias("symbol"),
        F.coalesce(to_double("data.close"), to_double("data.k.c")).alias("price"),
        F.coalesce(to_double("data.volume"), to_double("data.k.v")).alias("volume"),
        F.coalesce(
            parse_candle_time(F.col("data.`@timestamp`")),
            millis_to_time("data.k.T"),
            F.col("broker_time"),
        ).alias("event_timestamp"),
    )
    return clean_ticks(computed_once(ticks), positive_volume)


def publish_candles(topic: DataFrame) -> DataFrame:
    """Raw kline rows to ``key, value`` messages of the simplified shape, finished ones only."""
    k = F.col("data.k")
    closed = parse_messages(topic).filter(F.lower(k["x"]) == "true")
    return closed.select(
        k["s"].alias("key"),
        F.to_json(
            F.struct(
                k["s"].alias("symbol"),
                millis_to_iso(k["T"]).alias("@timestamp"),
                k["c"].alias("close"),
                k["v"].alias("volume"),
            )
        ).alias("value"),
    )


def only_symbols(df: DataFrame, symbols: Sequence[str] | None, symbol: str = "symbol") -> DataFrame:
    """Keep the named symbols; None keeps all."""
    return df if symbols is None else df.filter(F.col(symbol).isin(*symbols))
