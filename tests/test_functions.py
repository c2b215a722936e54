from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions import text, times
from tickloom.functions.numbers import ratio, to_double
from tickloom.schemas import INTERVALS, interval


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_parse_time(spark):
    row = one(
        spark,
        times.ntz(times.parse_time(F.lit("2024-02-03 04:05:06.5"))).alias("a"),
        times.parse_time(F.lit("no time")).alias("b"),
        times.ntz(times.parse_time(F.lit("03/02/2024"), "yyyy-MM-dd", "dd/MM/yyyy")).alias("c"),
    )
    assert row.a == datetime(2024, 2, 3, 4, 5, 6, 500000) and row.b is None and row.c == datetime(2024, 2, 3)


def test_epoch_millis_and_iso(spark):
    row = one(
        spark,
        times.millis_to_iso(F.lit(1767225659999)).alias("iso"),
        times.iso_to_millis(F.lit("2026-01-01T00:00:59.999Z")).alias("ms"),
        times.iso_to_millis(F.lit("2026-01-01T02:00:59.999+02:00")).alias("shifted"),
        times.iso_to_millis(F.lit("2026-01-01T00:00:59.999")).alias("no_zone"),
        times.ntz(times.millis_to_time(F.lit(1767225659999))).alias("ts"),
        times.now_millis().alias("now"),
    )
    assert row.iso == "2026-01-01T00:00:59.999000Z"
    assert row.ms == row.shifted == row.no_zone == 1767225659999
    assert row.ts == datetime(2026, 1, 1, 0, 0, 59, 999000) and row.now > 1_700_000_000_000


def test_localise_reproduces_summer_time(spark):
    midnight = [F.lit(t).cast("timestamp_ntz") for t in ("2022-01-24 00:00:00", "2022-08-11 00:00:00")]
    row = one(spark, *(times.localise(t, "Europe/Madrid").alias(n) for t, n in zip(midnight, "ab")))
    assert (row.a.hour, row.b.hour) == (1, 2)


@pytest.mark.parametrize(
    "code,start",
    [
        ("1", datetime(2024, 5, 16, 13, 47)),
        ("3", datetime(2024, 5, 16, 13, 45)),
        ("45", datetime(2024, 5, 16, 13, 30)),
        ("4H", datetime(2024, 5, 16, 12)),
        ("1D", datetime(2024, 5, 16)),
        ("1W", datetime(2024, 5, 13)),
        ("1M", datetime(2024, 5, 1)),
    ],
)
def test_bar_start(spark, code, start):
    moment = spark.createDataFrame([(datetime(2024, 5, 16, 13, 47, 31),)], "t timestamp_ntz")
    assert moment.select(times.bar_start("t", code).alias("s")).first().s == start


def test_intervals():
    assert len(INTERVALS) == 13 and interval("1H").duration == "1 hour"
    with pytest.raises(ValueError, match="unknown interval"):
        interval("2D")


def test_tolerant_numbers(spark):
    row = one(
        spark,
        to_double(F.lit("0.09539")).alias("a"),
        to_double(F.lit("abc")).alias("b"),
        ratio(F.lit(1.0), F.lit(0.0)).alias("c"),
        ratio(F.lit(2.0), F.lit(3.0), 8).alias("d"),
    )
    assert (row.a, row.b, row.c, row.d) == (0.09539, None, None, 0.66666667)


def test_format_symbol(spark):
    s, x = F.lit("CRUDE"), F.lit("MCX")
    row = one(
        spark,
        text.format_symbol(s, x).alias("plain"),
        text.format_symbol(s, x, 1).alias("future"),
        text.format_symbol(F.lit("NSE:NIFTY"), x, 1).alias("full"),
        text.format_symbol(s, x, F.lit(None).cast("int")).alias("none"),
        text.format_symbol(s, x, F.lit(2)).alias("column"),
    )
    assert list(row) == ["MCX:CRUDE", "MCX:CRUDE1!", "NSE:NIFTY", "MCX:CRUDE", "MCX:CRUDE2!"]
    with pytest.raises(ValueError, match="not a valid contract"):
        text.format_symbol(s, x, "front")


def test_search_hits(spark):
    reply = '[{"symbol":"<em>ETH</em>USD","description":"Ether","exchange":"X","type":"crypto"}]'
    row = one(spark, text.search_hits(F.lit(reply)).alias("hits"), text.search_hits(F.lit("oops")).alias("bad"))
    assert row.hits[0].symbol == "ETHUSD"
    assert not row.bad or row.bad[0] is None or row.bad[0].symbol is None
