from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.operators.candles import normalise_candles, only_symbols, publish_candles

BROKER = datetime(2026, 1, 1, 9)
CLOSED = '{"e":"kline","s":"AAA","k":{"T":1767225659999,"s":"AAA","i":"1m","c":"10.5","v":"2","x":true}}'


def topic(spark, *values, key="AAA"):
    rows = [(bytearray(key.encode()), bytearray(v.encode()), BROKER) for v in values]
    return spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp")


def clean(spark, value, **settings):
    rows = normalise_candles(topic(spark, value), **settings).collect()
    return [(r.symbol, r.price, r.volume, r.event_timestamp, r.price_x_volume) for r in rows]


WHOLE = datetime(2026, 1, 1, 0, 0, 59)
MILLIS = datetime(2026, 1, 1, 0, 0, 59, 999000)


@pytest.mark.parametrize(
    "value,time",
    [
        ('{"symbol":"AAA","@timestamp":"2026-01-01T00:00:59Z","close":"10.5","volume":"2"}', WHOLE),
        ('{"symbol":"AAA","@timestamp":"2026-01-01T00:00:59.999000Z","close":"10.5","volume":"2"}', MILLIS),
        ('{"symbol":"AAA","@timestamp":"2026-01-01T00:00:59.999Z","close":"10.5","volume":"2"}', MILLIS),
        ('{"symbol":"AAA","@timestamp":"2026-01-01T00:00:59Z","close":10.5,"volume":2}', WHOLE),
        ('{"@timestamp":"2026-01-01T00:00:59Z","close":"10.5","volume":"2"}', WHOLE),
        ('{"symbol":"AAA","close":"10.5","volume":"2"}', BROKER),
        ('{"symbol":"AAA","@timestamp":"yesterday","close":"10.5","volume":"2"}', BROKER),
        (CLOSED, MILLIS),
    ],
)
def test_both_shapes_and_fall_backs(spark, value, time):
    assert clean(spark, value) == [("AAA", 10.5, 2.0, time, 21.0)]


@pytest.mark.parametrize(
    "value",
    [
        "Mensaje",
        "",
        '{"symbol":"AAA","close":"abc","volume":"2"}',
        '{"symbol":"AAA","close":"1","volume":"0"}',
        '{"symbol":"AAA","volume":"2"}',
        CLOSED.replace("true", "false"),
    ],
)
def test_unusable_messages_are_dropped(spark, value):
    assert clean(spark, value) == []


def test_open_candles_on_request(spark):
    assert len(clean(spark, CLOSED.replace("true", "false"), closed_only=False)) == 1


def test_publish_keeps_number_text(spark):
    rows = publish_candles(topic(spark, CLOSED, CLOSED.replace("true", "false"), "Mensaje")).collect()
    assert [(r.key, r.value) for r in rows] == [
        ("AAA", '{"symbol":"AAA","@timestamp":"2026-01-01T00:00:59.999000Z","close":"10.5","volume":"2"}')
    ]


def test_published_candles_read_back(spark):
    published = publish_candles(topic(spark, CLOSED)).withColumn("timestamp", F.lit(BROKER))
    again = normalise_candles(published).first()
    assert (again.symbol, again.price, again.event_timestamp) == ("AAA", 10.5, MILLIS)


def test_only_symbols(spark):
    df = spark.createDataFrame([("A",), ("B",)], "symbol string")
    assert only_symbols(df, None).count() == 2
    assert [r.symbol for r in only_symbols(df, ["B"]).collect()] == ["B"]
