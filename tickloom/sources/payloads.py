"""Landed history payloads: framed text holding ``"s":[{"i":n,"v":[t,o,h,l,c,v]},...]``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numbers import to_double
from tickloom.schemas import BAR_COLUMNS

# The span holding the bars, and one bar in it. Numbers are read as
# text, so that a broken one costs only itself.
SERIES = r'"s":\[(.+?)\}\]'
BAR_ITEMS = "array<struct<i:string,v:array<string>>>"


def payload_to_bars(payloads: DataFrame, text: str = "payload", symbol: str = "symbol", sticky_volume: bool = False) -> DataFrame:
    """One bar per entry of each payload's first series; a payload without one gives no rows.

    A number that cannot be read is 0.0. With ``sticky_volume`` the volume of that bar
    and of every later one in its payload is 0.0 as well, otherwise each bar stands
    for itself.
    """
    series = F.concat(F.lit("["), F.regexp_extract(text, SERIES, 1), F.lit("}]"))
    found = payloads.select(symbol, F.from_json(series, BAR_ITEMS).alias("_bars"))
    if sticky_volume:
        broken = F.transform("_bars", _unreadable)
        found = found.withColumn("_broken", F.array_position(broken, True))
    else:
        found = found.withColumn("_broken", F.lit(0))
    rows = found.select(symbol, "_broken", F.posexplode("_bars").alias("_pos", "_bar"))

    def number(place: int) -> Column:
        return F.coalesce(to_double(F.try_element_at(F.col("_bar.v"), F.lit(place))), F.lit(0.0))

    lost = (F.col("_broken") > 0) & (F.col("_pos") >= F.col("_broken") - 1)
    seconds = to_double(F.try_element_at(F.col("_bar.v"), F.lit(1)))
    return rows.select(
        F.timestamp_micros((seconds * 1000000).cast("long")).cast("timestamp_ntz").alias("datetime"),
        F.col(symbol).alias("symbol"),
        number(2).alias("open"),
        number(3).alias("high"),
        number(4).alias("low"),
        number(5).alias("close"),
        F.when(lost, F.lit(0.0)).otherwise(number(6)).alias("volume"),
    ).select(*BAR_COLUMNS)


def _unreadable(bar: Column) -> Column:
    numbers = F.transform(F.sequence(F.lit(2), F.lit(6)), lambda p: to_double(F.try_element_at(bar["v"], p)))
    return F.exists(numbers, lambda n: n.isNull())


def bars_to_payload(bars: DataFrame, group: Column) -> DataFrame:
    """Bars as payload text, one payload per symbol and ``group`` (keep groups short)."""
    item = F.struct(
        F.unix_seconds(F.col("datetime").cast("timestamp")).alias("t"), "open", "high", "low", "close", "volume"
    )
    items = F.array_sort(F.collect_list(item))
    entries = F.transform(
        items,
        lambda b, i: F.struct(
            i.alias("i"),
            F.array(b["t"].cast("double"), b["open"], b["high"], b["low"], b["close"], b["volume"]).alias("v"),
        ),
    )
    body = F.concat(
        F.lit('~m~{"m":"timescale_update","p":["cs",{"s1":{"s":'), F.to_json(entries), F.lit(',"ns":{"d":""}}}]}')
    )
    return bars.groupBy("symbol", group.alias("span")).agg(body.alias("payload"))
