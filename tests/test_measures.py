from datetime import datetime

from pyspark.sql import functions as F

from tickloom.operators.measures import flat_dimensions, latest_measures, measures_long

START, END = datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 5)
PAIRS = "symbol string, close double, vwap double, window_start timestamp_ntz, window_end timestamp_ntz"


def test_two_records_per_pair(spark):
    pairs = spark.createDataFrame([("A", 11.0, 10.5, START, END)], PAIRS)
    rows = {r.measure_name: r for r in measures_long(pairs, version=F.lit(7)).collect()}
    shared = {"symbol": "A", "window_start": "2026-01-01 00:00:00", "window_end": "2026-01-01 00:05:00"}
    assert rows["close"].dimensions == {**shared, "source_topic": "quotes", "event_ts": "2026-01-01 00:05:00"}
    assert rows["vwap"].dimensions == {**shared, "source_topic": "vwap"}
    assert (rows["close"].measure_value, rows["vwap"].measure_value) == (11.0, 10.5)
    assert (rows["close"].version, rows["vwap"].version) == (7, 8)
    assert {r.time for r in rows.values()} == {END}


def test_version_defaults_to_now(spark):
    pairs = spark.createDataFrame([("A", 11.0, 10.5, START, END)], PAIRS)
    versions = sorted(r.version for r in measures_long(pairs).collect())
    assert versions[1] == versions[0] + 1 and versions[0] > 1_700_000_000_000


def test_highest_version_wins(spark):
    record = lambda symbol, value, version: ({"symbol": symbol}, "close", value, END, version)
    schema = "dimensions map<string,string>, measure_name string, measure_value double, time timestamp_ntz, version long"
    rows = [record("A", 1.0, 1), record("A", 5.0, 2), record("A", 3.0, 3), record("B", 9.0, 1)]
    latest = flat_dimensions(latest_measures(spark.createDataFrame(rows, schema)), ["symbol"]).collect()
    assert sorted((r.symbol, r.measure_value, r.version) for r in latest) == [("A", 3.0, 3), ("B", 9.0, 1)]


def test_dimension_order_does_not_matter(spark):
    rows = spark.sql(
        """SELECT map('a', '1', 'b', '2') dimensions, 'm' measure_name, 1D measure_value,
                  TIMESTAMP_NTZ'2026-01-01 00:00:00' time, 1L version
           UNION ALL
           SELECT map('b', '2', 'a', '1'), 'm', 2D, TIMESTAMP_NTZ'2026-01-01 00:00:00', 2L"""
    )
    assert [(r.measure_value, r.version) for r in latest_measures(rows).collect()] == [(2.0, 2)]
