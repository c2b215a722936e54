from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators.candles import clean_ticks
from tickloom.operators.vwap import flat_windows, latest_closed, vwap, vwap_messages

T0 = datetime(2026, 1, 1)
SCHEMA = "symbol string, event_timestamp timestamp_ntz, price double, volume double"


def at(text):
    minute, second = text.split(":")
    return T0 + timedelta(minutes=int(minute), seconds=float(second))


def ticks(spark, rows, symbol="A"):
    return spark.createDataFrame([(symbol, at(t), float(p), float(v)) for t, p, v in rows], SCHEMA)


SCENARIO = [("0:59.999", 10, 1), ("1:59.999", 20, 3), ("2:59.999", 30, 1), ("7:59.999", 40, 1), ("2:30", 99, 1)]


def by_end(df):
    return {(r.window_end - T0).seconds // 60: r.vwap for r in flat_windows(df).collect()}


@pytest.mark.parametrize("nested", [True, False])
def test_sliding_windows(spark, nested):
    got = by_end(vwap(clean_ticks(ticks(spark, SCENARIO)), nested=nested))
    third = round((10 + 60 + 30 + 99) / 6, 8)
    assert got == {
        1: 10.0, 2: 17.5, 3: third, 4: third, 5: third, 6: 37.8, 7: 64.5,
        8: 40.0, 9: 40.0, 10: 40.0, 11: 40.0, 12: 40.0,
    }


def test_sizes_that_are_no_multiple_of_the_slide(spark):
    rows = [(f"{i // 2}:{i % 2 * 30}", 10 + i % 7, 1 + i % 3) for i in range(60)]
    both = [
        sorted(tuple(r) for r in flat_windows(vwap(clean_ticks(ticks(spark, rows)), "5 minutes", "2 minutes", nested=n)).collect())
        for n in (True, False)
    ]
    assert both[0] == both[1] and len(both[0]) > 0


def test_windows_are_half_open(spark):
    got = by_end(vwap(clean_ticks(ticks(spark, [("5:0", 7, 1)]))))
    assert sorted(got) == [6, 7, 8, 9, 10]


def test_zero_volume(spark):
    rows = [("0:10", 5, 0)]
    assert by_end(vwap(clean_ticks(ticks(spark, rows)))) == {}
    plain = vwap(clean_ticks(ticks(spark, rows), positive_volume=False), positive_volume=False, round_to=None)
    assert set(by_end(plain).values()) == {None}


def test_vwap_lies_between_the_prices(spark):
    rows = [(f"{i % 30}:{(i * 7) % 60}", 10 + (i * 13) % 50, 1 + i % 9) for i in range(300)]
    bounds = clean_ticks(ticks(spark, rows)).groupBy(F.window("event_timestamp", "5 minutes", "1 minute")).agg(
        F.min("price").alias("lo"), F.max("price").alias("hi")
    )
    joined = vwap(clean_ticks(ticks(spark, rows))).join(bounds, "window")
    assert joined.filter("vwap < lo - 1e-8 or vwap > hi + 1e-8").count() == 0


def test_latest_closed_per_symbol(spark):
    both = ticks(spark, SCENARIO).union(ticks(spark, [("0:1", 3, 1)], "B"))
    rows = latest_closed(flat_windows(vwap(clean_ticks(both))), T0 + timedelta(minutes=6)).collect()
    assert {(r.symbol, (r.window_end - T0).seconds // 60, r.vwap) for r in rows} == {("A", 6, 37.8), ("B", 5, 3.0)}
    assert latest_closed(flat_windows(vwap(clean_ticks(both))), T0).count() == 0


def test_message_fields(spark):
    windows = flat_windows(vwap(clean_ticks(ticks(spark, [("0:1", 3, 2)])))).filter(F.col("window_end") == at("1:0"))
    full, short = vwap_messages(windows).first(), vwap_messages(windows, False, False).first()
    assert full.key == "A"
    assert full.value == (
        '{"calculation_time":"2026-01-01T00:01:00.000","window_start":"2025-12-31T23:56:00.000",'
        '"window_end":"2026-01-01T00:01:00.000","symbol":"A","vwap":3.0,"volume_sum":2.0}'
    )
    assert "calculation_time" not in short.value and "volume_sum" not in short.value


def test_a_stream_needs_a_watermark(spark):
    stream = spark.readStream.format("rate").load().withColumn("event_timestamp", F.col("timestamp"))
    with pytest.raises(ValueError, match="watermark"):
        vwap(stream)


def test_streams_hand_panes_on(spark, tmp_path):
    """Asked for, a stream's ticks meet one state per slide, without being spread over windows first."""
    folder = str(tmp_path / "ticks")
    ticks(spark, SCENARIO).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")).write.parquet(folder)
    feed = clean_ticks(spark.readStream.schema(SCHEMA.replace("timestamp_ntz", "timestamp")).parquet(folder))
    plan = vwap(feed, watermark="2 minutes", nested=True)._jdf.queryExecution().analyzed().toString()
    expand, panes, windows = plan.find("Expand"), plan.rfind("Aggregate"), plan.find("Aggregate")
    assert windows < expand < panes  # the tree is printed from the top: ticks reach the panes unexpanded
    assert plan.count("Expand") == 1 and plan.count("Aggregate") == 2
    plain = vwap(feed, watermark="2 minutes")._jdf.queryExecution().analyzed().toString()
    assert plain.count("Aggregate") == 1 and plain.find("Aggregate") < plain.find("Expand")
