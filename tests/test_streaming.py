"""Streams over a folder of files, one file per micro-batch."""

import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import blocks
from tickloom.operators.candles import normalise_candles
from tickloom.operators.pairing import QUOTE, VWAP
from tickloom.plans import views
from tickloom.schemas import CANDLE_MESSAGE, MEASURE
from tickloom.session import use_rocksdb
from tickloom.sources.topics import stream_topic
from tickloom.streaming import pair_jobs
from tickloom.streaming.runners import (
    AVAILABLE_NOW,
    BatchTable,
    newest_per_key,
    start_batches,
    start_console,
    start_topic,
    wait,
)
from tickloom.streaming.vwap_jobs import publish_newest, publish_vwap, stream_vwap

T0 = datetime(2026, 1, 1)
FILES = [
    [("00:00:59.999", 10, 1)],
    [("00:01:59.999", 20, 3)],
    [("00:02:59.999", 30, 1), ("00:07:59.999", 40, 1)],
    [("00:02:30.000", 99, 1)],
    [("00:12:59.999", 50, 2)],
]
TOPIC = "key string, value string, timestamp timestamp"


@pytest.fixture(autouse=True)
def rocksdb(spark):
    use_rocksdb(spark)


class Feed:
    """A folder standing for a topic; every ``add`` is one later file."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0
        os.makedirs(folder)

    def add(self, rows):
        self.n += 1
        path = os.path.join(self.folder, f"{self.n:04d}.json")
        with open(path, "w") as out:
            for at, price, volume in rows:
                value = {"symbol": "A", "@timestamp": f"2026-01-01T{at}Z", "close": str(price), "volume": str(volume)}
                out.write(json.dumps({"key": "A", "value": json.dumps(value), "timestamp": "2026-01-01T09:00:00Z"}) + "\n")
        stamp = time.time() - 1000 + self.n
        os.utime(path, (stamp, stamp))
        return self

    def ticks(self):
        rows = stream_topic(self.spark, self.folder, fmt="json", schema=TOPIC, max_per_trigger=1)
        return normalise_candles(rows)


@pytest.fixture
def feed(spark, tmp_path):
    made = Feed(spark, str(tmp_path / "candles"))
    for rows in FILES:
        made.add(rows)
    return made


def test_slices_hold_all_events_in_order(spark, tmp_path):
    """No time, an outlying time and a crowded moment make no large slice and lose nothing."""
    at = lambda s: T0 + timedelta(seconds=s)
    rows = [(i, at(i // 3)) for i in range(300)] + [(1000 + i, at(50)) for i in range(400)] + [(2000 + i, None) for i in range(20)] + [(3000, at(10**8)), (3001, at(-(10**8)))]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz").repartition(3)
    path = str(tmp_path / "slices")
    bounds = views.write_slices(events, path, rows_per_slice=100)
    files = sorted((f for f in os.listdir(path) if f.endswith(".parquet")), key=lambda f: os.stat(os.path.join(path, f)).st_mtime_ns)
    held = [[tuple(r) for r in spark.read.parquet(os.path.join(path, f)).collect()] for f in files]
    assert sorted((r for part in held for r in part), key=str) == sorted(rows, key=str)
    assert max(map(len, held)) <= 160 and len(held) >= 7
    assert bounds == sorted(set(bounds)) and bounds[0] == at(-(10**8)) and bounds[-1] == at(10**8) + timedelta(microseconds=1)
    times = [[t for _, t in part if t is not None] for part in held]
    assert all(max(a) <= min(b) for a, b in zip(times, times[1:]) if a and b)
    assert len(held[0]) == 20 and all(t is not None for part in held[1:] for _, t in part)
    alone = views.write_slices(events.where("ts is null"), str(tmp_path / "none"))
    assert alone == [] and spark.read.parquet(str(tmp_path / "none")).count() == 20
    few = views.write_slices(events.where("event_id < 400"), str(tmp_path / "few"))
    assert len(few) == 5


def run(spark, windows, tmp_path, mode):
    log = BatchTable(str(tmp_path / "log"))
    query = start_batches(windows, log.write, str(tmp_path / "cp"), mode=mode, trigger=AVAILABLE_NOW)
    assert wait(query, 120)
    return log.read(spark, windows.schema), query


def end(row):
    return (row.window_end - T0).seconds // 60


LATE_THIRD = round((10 + 60 + 30 + 99) / 6, 8)
BATCH = {1: 10.0, 2: 17.5, 3: LATE_THIRD, 4: LATE_THIRD, 5: LATE_THIRD, 6: 37.8, 7: 64.5,
         8: 40.0, 9: 40.0, 10: 40.0, 11: 40.0, 12: 40.0, 13: 50.0, 14: 50.0, 15: 50.0, 16: 50.0, 17: 50.0}


@pytest.mark.parametrize("nested", [False, True])
@pytest.mark.parametrize("delay,newest", [("2 minutes", 10), ("0 seconds", 12)])
def test_append_publishes_each_closed_window_once(spark, feed, tmp_path, delay, newest, nested):
    rows = run(spark, stream_vwap(feed.ticks(), delay, nested=nested), tmp_path, "append")[0].collect()
    assert len(rows) == newest
    assert {end(r): r.vwap for r in rows} == {m: BATCH[m] for m in range(1, newest + 1)}


def test_update_refreshes_windows(spark, feed, tmp_path):
    log = run(spark, stream_vwap(feed.ticks(), "5 minutes"), tmp_path, "update")[0]
    assert log.count() == 30
    last = newest_per_key(log, ["symbol", "window_start", "window_end"]).collect()
    assert {end(r): r.vwap for r in last} == BATCH


def test_late_rows_are_dropped_and_counted(spark, feed, tmp_path):
    windows = stream_vwap(feed.add([("00:13:10.000", 50, 1)]).add([("00:00:30.000", 1000, 5)]).ticks(), "2 minutes")
    log, query = run(spark, windows, tmp_path, "append")
    assert {end(r): r.vwap for r in log.collect() if end(r) <= 10} == {m: BATCH[m] for m in range(1, 11)}
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped > 0


def test_panes_emit_in_the_same_batches_as_one_aggregate(spark, feed, tmp_path):
    feed.add([("00:13:10.000", 50, 1)]).add([("00:30:00.000", 60, 1)])
    logs = []
    for nested in (False, True):
        folder = tmp_path / str(nested)
        log = run(spark, stream_vwap(feed.ticks(), "2 minutes", nested=nested), folder, "append")[0]
        logs.append(sorted(tuple(r) for r in log.select("batch_id", "symbol", "window_start", "window_end", "vwap").collect()))
    assert logs[0] == logs[1] and len(logs[0]) > 10


def test_a_tick_after_its_pane_counts_nowhere(spark, tmp_path):
    """With one aggregate it would count in those of its windows that are still open."""
    feed = Feed(spark, str(tmp_path / "candles"))
    for rows in [[("00:00:10.000", 10, 1)], [("00:03:30.000", 20, 1)], [("00:03:40.000", 20, 1)], [("00:00:20.000", 90, 1)], [("01:00:00.000", 1, 1)], [("01:10:00.000", 1, 1)]]:
        feed.add(rows)
    ends = {}
    for nested in (False, True):
        log = run(spark, stream_vwap(feed.ticks(), "1 minute", nested=nested), tmp_path / str(nested), "append")[0]
        ends[nested] = {end(r): r.vwap for r in log.collect()}
    assert ends[True][1] == ends[False][1] == 10.0 and ends[True].keys() == ends[False].keys()
    assert ends[True][5] == round(50 / 3, 8) and ends[False][5] == 35.0


def test_restart_continues_where_it_stopped(spark, tmp_path):
    feed = Feed(spark, str(tmp_path / "candles"))
    for rows in FILES[:3]:
        feed.add(rows)
    first = run(spark, stream_vwap(feed.ticks(), "0 seconds"), tmp_path, "append")[0].count()
    for rows in FILES[3:]:
        feed.add(rows)
    rows = run(spark, stream_vwap(feed.ticks(), "0 seconds"), tmp_path, "append")[0].collect()
    assert 0 < first < len(rows) and len({end(r) for r in rows}) == len(rows) == 12


def test_messages_to_a_topic(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    query = publish_vwap(feed.ticks(), out, str(tmp_path / "cp"), trigger=AVAILABLE_NOW, fmt="json")
    assert wait(query, 120)
    rows = spark.read.schema("key string, value string").json(out).collect()
    values = {r.value for r in rows}
    assert len(rows) == 10 and {r.key for r in rows} == {"A"}
    assert (
        '{"calculation_time":"2026-01-01T00:01:00.000","window_start":"2025-12-31T23:56:00.000",'
        '"window_end":"2026-01-01T00:01:00.000","symbol":"A","vwap":10.0,"volume_sum":1.0}'
    ) in values


def test_newest_closed_window_per_trigger(spark, feed, tmp_path):
    log = BatchTable(str(tmp_path / "newest"))
    query = publish_newest(
        feed.ticks(), str(tmp_path / "cp"), log.write, as_of=T0 + timedelta(minutes=6), trigger=AVAILABLE_NOW
    )
    assert wait(query, 120)
    rows = log.read(spark, stream_vwap(feed.ticks()).schema).orderBy("batch_id").collect()
    # Batch 4 only refreshes windows ending later than the cut, so it publishes nothing.
    assert [(r.batch_id, end(r), r.vwap) for r in rows] == [(0, 5, 10.0), (1, 6, 20.0), (2, 6, 22.5), (3, 6, 37.8)]


def test_windows_that_close_after_their_last_refresh(spark, tmp_path):
    """One tick a minute, the cut five seconds later, a restart before every file."""
    feed = Feed(spark, str(tmp_path / "in"))
    log = BatchTable(str(tmp_path / "newest"))
    assert log.read(spark, stream_vwap(feed.ticks()).schema).count() == 0
    for minute in range(5):
        feed.add([(f"00:0{minute}:30.000", 10 + minute, 1)])
        cut = T0 + timedelta(minutes=minute, seconds=35)
        assert wait(publish_newest(feed.ticks(), str(tmp_path / "cp"), log.write, as_of=cut, trigger=AVAILABLE_NOW), 120)
    rows = log.read(spark, stream_vwap(feed.ticks()).schema).orderBy("batch_id").collect()
    assert [(end(r), r.vwap) for r in rows] == [(1, 10.0), (2, 10.5), (3, 11.0), (4, 11.5)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    log, rows = BatchTable(str(tmp_path / "t")), spark.createDataFrame([(1,)], "x long")
    log.write(rows, 0)
    log.write(rows, 0)
    log.write(rows, 1)
    assert log.read(spark, rows.schema).count() == 2


def test_console_and_timeout(spark, feed, tmp_path):
    query = start_console(feed.ticks(), str(tmp_path / "cp"), mode="append", trigger={"processingTime": "1 hour"})
    assert wait(query, 1) is False and not query.isActive


# -- pairing ---------------------------------------------------------------

SCRIPT = [("A", QUOTE, 10), ("A", QUOTE, 11), ("B", QUOTE, 5), ("A", VWAP, 100), ("A", VWAP, 101), ("A", QUOTE, 12), ("B", VWAP, 50)]


def message_file(spark, folder, n, rows):
    schema = pair_jobs.PENDING
    data = [(s, T0 + timedelta(seconds=n * 10 + i), side, i, float(v), T0, T0 + timedelta(minutes=5)) for i, (s, side, v) in enumerate(rows)]
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)


def pair_run(spark, tmp_path, on_pairs):
    arriving = spark.readStream.schema(pair_jobs.PENDING).parquet(str(tmp_path / "messages"))
    query = pair_jobs.stream_pairs(
        arriving, str(tmp_path / "slots"), str(tmp_path / "cp"), on_pairs, trigger=AVAILABLE_NOW
    )
    assert wait(query, 120)


@pytest.mark.parametrize("sizes,piece", [([1] * 7, 100), ([3, 4], 100), ([3, 4], 1), ([7], 2)])
def test_pairs_do_not_depend_on_batching(spark, monkeypatch, tmp_path, sizes, piece):
    monkeypatch.setattr(blocks, "ROWS_PER_PIECE", piece)
    log, at = BatchTable(str(tmp_path / "pairs")), 0
    for n, size in enumerate(sizes):
        message_file(spark, str(tmp_path / "messages"), n, SCRIPT[at : at + size])
        at += size
        pair_run(spark, tmp_path, log.write)
    rows = log.read(spark, pair_jobs.PAIR).collect()
    assert sorted((r.symbol, r.close, r.vwap) for r in rows) == [("A", 11, 100), ("A", 12, 101), ("B", 5, 50)]
    if len(sizes) == 7:
        assert sorted((r.batch_id, r.symbol) for r in rows) == [(3, "A"), (5, "A"), (6, "B")]


def test_pairs_become_measures(spark, tmp_path):
    store = str(tmp_path / "measures")
    message_file(spark, str(tmp_path / "messages"), 0, SCRIPT)
    pair_run(spark, tmp_path, pair_jobs.keep_measures(store))
    rows = pair_jobs.stored_measures(spark, store).collect()
    assert sorted((r.dimensions["symbol"], r.measure_name) for r in rows) == [
        ("A", "close"), ("A", "vwap"), ("B", "close"), ("B", "vwap"),
    ]
    # Both pairs of A share their window, so the store keeps the later version.
    values = {(r.dimensions["symbol"], r.measure_name): r.measure_value for r in rows}
    assert values["B", "close"] == 5 and values["B", "vwap"] == 50


def test_a_higher_version_replaces_a_stored_record(spark, tmp_path):
    store = str(tmp_path / "store")
    schema = "symbol string, close double, vwap double, window_start timestamp_ntz, window_end timestamp_ntz"
    for batch_id, (version, close) in enumerate([(5, 1.0), (9, 2.0), (7, 3.0)]):
        pair = spark.createDataFrame([("A", close, 1.0, T0, T0 + timedelta(minutes=5))], schema)
        pair_jobs.keep_measures(store, version=F.lit(version).cast("long"))(pair, batch_id)
    stored = {r.measure_name: r.measure_value for r in pair_jobs.stored_measures(spark, store).collect()}
    assert BatchTable(store).read(spark, MEASURE).count() == 6 and stored["close"] == 2.0
    assert pair_jobs.stored_measures(spark, store, since=T0.date()).count() == 2
    assert pair_jobs.stored_measures(spark, store, since=T0.date() + timedelta(days=1)).count() == 0


def test_messages_from_topics(spark):
    rows = [
        ("A", '{"symbol":"A","close":"10.5","volume":"1"}', 1),
        ("A", '{"vwap":9.5,"window_start":"2026-01-01T00:00:00.000Z","window_end":"2026-01-01T00:05:00.000Z"}', 2),
        ("A", '{"vwap":9.5,"window_start":"","window_end":"2026-01-01T00:05:00.000Z"}', 3),
    ]
    topic = spark.createDataFrame(rows, "key string, value string, offset long").withColumn("timestamp", F.lit(T0))
    quotes = pair_jobs.quotes_from_topic(topic).collect()
    vwaps = pair_jobs.vwaps_from_topic(topic).collect()
    assert [(r.symbol, r.side, r.seq, r.value) for r in quotes] == [("A", QUOTE, 1, 10.5)]
    assert [(r.side, r.seq, r.value, r.window_start, r.window_end) for r in vwaps] == [
        (VWAP, 2, 9.5, T0, T0 + timedelta(minutes=5))
    ]


def test_plain_topic_writer(spark, tmp_path, feed):
    messages = feed.ticks().select(F.col("symbol").alias("key"), F.col("price").cast("string").alias("value"))
    assert wait(start_topic(messages, str(tmp_path / "o"), str(tmp_path / "c"), trigger=AVAILABLE_NOW, fmt="json"), 120)
    assert spark.read.json(str(tmp_path / "o")).count() == 6
    assert CANDLE_MESSAGE.fieldNames()[0] == "symbol"


def test_asof_on_streams(spark, tmp_path):
    """The last quote before a window's end, found over micro-batches, with the states let go."""
    quotes, ends = str(tmp_path / "quotes"), str(tmp_path / "ends")
    at = lambda m, s=0: T0 + timedelta(minutes=m, seconds=s)
    ticks = [("A", at(m, s), float(m * 100 + s), m * 100 + s) for m in range(0, 60, 3) for s in (1, 30, 30, 59)] + [("B", at(2), 5.0, 1), ("A", at(300), 1.0, 2)]
    windows = [(s, at(m - 5), at(m), float(m)) for m in range(1, 80) for s in "ABC"] + [("A", at(295), at(300), 1.0), ("A", None, None, 1.0)]
    for rows, path, schema, by in (
        (ticks, quotes, "symbol string, event_timestamp timestamp, price double, id long", lambda r: r[1]),
        (windows, ends, "symbol string, window_start timestamp_ntz, window_end timestamp_ntz, vwap double", lambda r: r[2] or T0),
    ):
        rows = sorted(rows, key=by)
        for lo, hi in ((0, 20), (20, 40), (40, 60), (60, 1000)):
            part = [r for r in rows if at(lo) <= by(r) < at(hi)]
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    read = lambda path: spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    pairs = pair_jobs.stream_asof(read(ends), read(quotes), max_age="7 minutes", delay="1 minute", order="id")
    log, query = run(spark, pairs, tmp_path, "append")
    got = sorted((r.symbol, end(r), r.vwap, r.quote_time, r.close) for r in log.collect())
    want = []
    for symbol, _, stop, vwap in windows:
        near = [(t, p) for s, t, p, _ in ticks if stop and s == symbol and t < stop and t.replace(second=0) + timedelta(minutes=1) > stop - timedelta(minutes=7)]
        if near and stop < at(200):
            want.append((symbol, int(vwap), vwap, max(near)[0], max(near)[1]))
    assert got == sorted(want) and len({r.batch_id for r in log.select("batch_id").distinct().collect()}) > 2
    assert all(op["numRowsTotal"] < 40 for op in query.lastProgress["stateOperators"])


def test_asof_on_streams_of_one_long_symbol(spark, tmp_path):
    """Windows meet the quotes near them only: all with all of a symbol would be 400 million pairs in one task."""
    n, quotes, ends = 20_000, str(tmp_path / "quotes"), str(tmp_path / "ends")
    at = F.lit(T0).cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))
    late = F.expr("interval 30 seconds")
    for part in (spark.range(n), spark.range(2 * n, 2 * n + 1)):
        part.select(F.lit("A").alias("symbol"), (at + late).alias("event_timestamp"), F.col("id").cast("double").alias("price")).coalesce(1).write.mode("append").parquet(quotes)
        rows = part.select(F.lit("A").alias("symbol"), (at - F.expr("interval 5 minutes")).cast("timestamp_ntz").alias("window_start"), at.cast("timestamp_ntz").alias("window_end"), F.lit(1.0).alias("vwap"))
        rows.coalesce(1).write.mode("append").parquet(ends)
    read = lambda path: spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    pairs = pair_jobs.stream_asof(read(ends), read(quotes), max_age="9 minutes 30 seconds")
    log = BatchTable(str(tmp_path / "log"))
    assert wait(start_batches(pairs, log.write, str(tmp_path / "cp"), mode="append", trigger=AVAILABLE_NOW), 100)
    minute = (F.unix_seconds(F.col("window_end").cast("timestamp")) - F.unix_seconds(F.lit(T0).cast("timestamp"))) / 60
    got = log.read(spark, pairs.schema).agg(F.count("*"), F.min(minute), F.max(minute), F.min(minute - F.col("close")), F.max(minute - F.col("close"))).first()
    assert tuple(got) == (n - 1, 1, n - 1, 1, 1)
