import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import blocks
from tickloom.operators.pairing import (
    QUOTE,
    VWAP,
    compact_quotes,
    fold_arrivals,
    pair_asof,
    pair_latest,
    pairs_of,
    pending,
    quote_messages,
    vwap_arrivals,
)
from tickloom.streaming.pair_jobs import PENDING

T0 = datetime(2026, 1, 1)


def minute(m):
    return T0 + timedelta(minutes=m)


def brute_fold(messages):
    """Two slots per symbol, message by message."""
    slots, pairs = {}, []
    for symbol, arrival, side, _, value, start, end in sorted(messages, key=lambda m: (m[1], m[2], m[3])):
        slot = slots.setdefault(symbol, {})
        slot[side] = (value, start, end)
        if len(slot) == 2:
            pairs.append((symbol, arrival, slot[QUOTE][0], *slot[VWAP]))
            slots[symbol] = {}
    left = {(s, side, v[0]) for s, slot in slots.items() for side, v in slot.items()}
    return sorted(pairs), left


def rows_of(df):
    return sorted((r.symbol, r.paired_at, r.close, r.vwap, r.window_start, r.window_end) for r in df.collect())


def random_messages(seed, n, symbols="AAAAAB", alternate=0.6):
    """Mostly one symbol; long stretches of strictly alternating sides are likely."""
    rng, out, side = random.Random(seed), [], QUOTE
    for i in range(n):
        side = 1 - side if rng.random() < alternate else rng.randint(0, 1)
        at = minute(rng.randint(0, 3) + i * 2)
        bounds = (minute(i), minute(i + 5)) if side == VWAP else (None, None)
        out.append((rng.choice(symbols), at, side, i, float(i), *bounds))
    return out


@pytest.mark.parametrize("seed,alternate", [(1, 0.0), (2, 0.6), (3, 0.97), (4, 1.0)])
@pytest.mark.parametrize("grain", ["7 minutes", "1 hour", "30 days", None])
def test_fold_equals_message_by_message(spark, monkeypatch, seed, alternate, grain):
    monkeypatch.setattr(blocks, "ROWS_PER_PIECE", 9)
    messages = random_messages(seed, 240, alternate=alternate)
    folded = fold_arrivals(spark.createDataFrame(messages, PENDING), grain)
    pairs, left = brute_fold(messages)
    assert rows_of(pairs_of(folded)) == pairs
    assert {(r.symbol, r.side, r.value) for r in pending(folded).collect()} == left


def test_overwritten_slots_and_symbols_apart(spark):
    script = [("A", QUOTE, 10), ("A", QUOTE, 11), ("B", QUOTE, 5), ("A", VWAP, 100),
              ("A", VWAP, 101), ("A", QUOTE, 12), ("B", VWAP, 50)]
    messages = [(s, minute(i), side, i, float(v), minute(0), minute(5)) for i, (s, side, v) in enumerate(script)]
    pairs = pair_latest(spark.createDataFrame(messages, PENDING)).collect()
    assert sorted((r.symbol, r.close, r.vwap) for r in pairs) == [("A", 11, 100), ("A", 12, 101), ("B", 5, 50)]


def tick_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        exact = rng.random() < 0.2
        at = minute(rng.randint(0, 90)) + timedelta(seconds=0 if exact else rng.random() * 59)
        rows.append((rng.choice("AAAB"), at, float(i), i))
    return rows


def test_equal_quotes_of_one_step_stay_two(spark):
    """The first of two alike quotes takes the waiting VWAP, the second waits for the next."""
    ticks = [("A", minute(6), 2.0, 0), ("A", minute(6), 2.0, 0)]
    windows = [("A", minute(0), minute(5), 1.0), ("A", minute(2), minute(7), 2.0)]
    quotes = quote_messages(spark.createDataFrame(ticks, TICKS))
    vwaps = vwap_arrivals(spark.createDataFrame(windows, WINDOWS))
    got = pair_latest(compact_quotes(quotes).unionByName(vwaps))
    assert sorted((r.close, r.vwap) for r in got.collect()) == [(2.0, 1.0), (2.0, 2.0)]


def window_rows(seed, n):
    rng = random.Random(seed)
    ends = {(rng.choice("AAAB"), rng.randint(0, 95)) for _ in range(n)}
    return [(s, minute(m - 5), minute(m), float(m)) for s, m in sorted(ends)]


TICKS = "symbol string, event_timestamp timestamp_ntz, price double, event_id long"
WINDOWS = "symbol string, window_start timestamp_ntz, window_end timestamp_ntz, vwap double"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_first_and_last_quote_per_step_suffice(spark, seed):
    ticks, windows = tick_rows(seed, 200), window_rows(seed, 80)
    quotes = quote_messages(spark.createDataFrame(ticks, TICKS), seq="event_id")
    vwaps = vwap_arrivals(spark.createDataFrame(windows, WINDOWS))
    got = pair_latest(compact_quotes(quotes).unionByName(vwaps), "10 minutes")
    messages = [(s, t, QUOTE, i, p, None, None) for s, t, p, i in ticks]
    messages += [(s, end, VWAP, 0, v, start, end) for s, start, end, v in windows]
    assert rows_of(got) == brute_fold(messages)[0]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("slide,grain", [("1 minute", None), ("1 minute", "8 minutes"), (None, "8 minutes"), (None, None)])
def test_asof_is_the_last_earlier_quote(spark, monkeypatch, seed, slide, grain):
    monkeypatch.setattr(blocks, "ROWS_PER_PIECE", 7)
    ticks, windows = tick_rows(seed, 60), window_rows(seed, 80)
    got = pair_asof(
        spark.createDataFrame(windows, WINDOWS), spark.createDataFrame(ticks, TICKS), slide, grain, order="event_id"
    )
    want = []
    for symbol, start, end, vwap in windows:
        earlier = [(t, i, p) for s, t, p, i in ticks if s == symbol and t < end]
        if earlier:
            time, _, price = max(earlier)
            want.append((symbol, start, end, vwap, time, price))
    assert sorted((r.symbol, r.window_start, r.window_end, r.vwap, r.quote_time, r.close) for r in got.collect()) == sorted(want)


def test_messages_without_measure_or_bounds_are_skipped(spark):
    ticks = spark.createDataFrame([("A", minute(0), None, 1), ("A", minute(1), 2.0, 2)], TICKS)
    assert [r.value for r in quote_messages(ticks).collect()] == [2.0]
    windows = [("A", None, minute(5), 1.0), ("A", minute(0), None, 1.0), ("A", minute(0), minute(5), None)]
    assert vwap_arrivals(spark.createDataFrame(windows, WINDOWS)).count() == 0


def test_windows_off_the_grid(spark):
    ticks = spark.createDataFrame([("A", T0, 1.0, 1), ("A", T0 + timedelta(minutes=9, seconds=10), 2.0, 2)], "symbol string, event_timestamp timestamp_ntz, price double, event_id long")
    windows = spark.createDataFrame([("A", T0 + timedelta(minutes=9, seconds=30), 5.0)], "symbol string, window_end timestamp_ntz, vwap double")
    assert [r.close for r in pair_asof(windows, ticks).collect()] == [2.0]
    with pytest.raises(Exception, match="off the grid"):
        pair_asof(windows, ticks, slide="1 minute").collect()
    whole = windows.withColumns({"window_start": F.col("window_end"), "window_end": F.col("window_end")})
    with pytest.raises(Exception, match="off the grid"):
        vwap_arrivals(whole, grid="1 minute").collect()


def test_distinct_quotes_keep_the_same_ends(spark):
    rng = random.Random(8)
    rows = [(rng.choice("AB"), T0 + timedelta(seconds=rng.randint(0, 600)), 1.0 * i, i - 50) for i in range(200)]
    ticks = spark.createDataFrame(rows, "symbol string, at timestamp_ntz, price double, id long")
    quotes = quote_messages(ticks, "at", "price", "id")
    plain, keyed = (sorted(map(str, compact_quotes(quotes, distinct=d).collect())) for d in (False, True))
    assert plain == keyed
    windows = spark.createDataFrame([(s, T0 + timedelta(minutes=m), 1.0) for s in "AB" for m in range(12)], "symbol string, window_end timestamp_ntz, vwap double")
    named = {"time": "at", "order": "id"}
    assert sorted(map(str, pair_asof(windows, ticks, **named).collect())) == sorted(map(str, pair_asof(windows, ticks, slide="1 minute", **named).collect()))


def test_pairs_in_a_crowded_second(spark, monkeypatch):
    """All messages of a symbol in one second, in pieces a twentieth of that: the pairs are the same."""
    monkeypatch.setattr(blocks, "ROWS_PER_PIECE", 20)
    rng = random.Random(9)
    at = lambda: T0 + timedelta(microseconds=rng.randrange(0, 900_000, 7000))
    messages = []
    for i in range(400):
        side = rng.randint(0, 1)
        bounds = (minute(0), minute(5)) if side == VWAP else (None, None)
        messages.append((rng.choice("AAAB"), at(), side, i, float(i), *bounds))
    folded = fold_arrivals(spark.createDataFrame(messages, PENDING))
    pairs, left = brute_fold(messages)
    assert rows_of(pairs_of(folded)) == pairs and len(pairs) > 50
    assert {(r.symbol, r.side, r.value) for r in pending(folded).collect()} == left

    ticks = [(rng.choice("AAAB"), at(), float(i), i) for i in range(300)]
    windows = [(s, T0, at(), float(i)) for i, s in enumerate("AAB" * 40)]
    got = pair_asof(spark.createDataFrame(windows, WINDOWS), spark.createDataFrame(ticks, TICKS), order="event_id")
    want = []
    for symbol, start, end, vwap in windows:
        earlier = [(t, i, p) for s, t, p, i in ticks if s == symbol and t < end]
        if earlier:
            time, _, price = max(earlier)
            want.append((symbol, start, end, vwap, time, price))
    assert sorted((r.symbol, r.window_start, r.window_end, r.vwap, r.quote_time, r.close) for r in got.collect()) == sorted(want)
