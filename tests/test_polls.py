"""Bounded polls that go on where the last one ended."""

import pytest

from tickloom.sources.polls import TopicPolls, _shares


def append(spark, topic, rows):
    made = spark.createDataFrame(rows, "partition int, offset long, text string")
    made.selectExpr(
        "CAST(text AS binary) AS key", "CAST(text AS binary) AS value", "'t' AS topic", "partition", "offset", "TIMESTAMP'2024-01-01 00:00:00' AS timestamp"
    ).write.mode("append").parquet(topic)


def reader(spark, tmp_path, **options):
    return TopicPolls(spark, str(tmp_path / "topic"), str(tmp_path / "held"), fmt="parquet", **options)


def collector():
    seen = {}

    def handle(rows, number):
        seen[number] = sorted((r.partition, r.offset) for r in rows.collect())

    return seen, handle


def test_every_message_once_in_bounded_polls(spark, tmp_path):
    rows = [(0, i, "a") for i in range(23)] + [(1, 2 * i, "b") for i in range(5)] + [(3, 7, "c")]
    append(spark, str(tmp_path / "topic"), rows)
    seen, handle = collector()
    assert reader(spark, tmp_path, max_records=8).drain(handle) == len(seen)
    assert all(1 <= len(s) <= 8 for s in seen.values())
    assert sorted(x for s in seen.values() for x in s) == sorted((p, o) for p, o, _ in rows)
    assert not reader(spark, tmp_path).poll(handle)
    # later messages, and a partition that was not there, in one poll without a limit
    more = [(0, 23, "d"), (0, 24, "d"), (2, 0, "e")]
    append(spark, str(tmp_path / "topic"), more)
    before = len(seen)
    assert reader(spark, tmp_path).drain(handle) == 1
    assert seen[before] == sorted((p, o) for p, o, _ in more)


def test_a_poll_that_dies_is_repeated_with_its_rows(spark, tmp_path):
    append(spark, str(tmp_path / "topic"), [(0, i, "a") for i in range(6)])
    first = []

    def dies(rows, number):
        first.append((number, sorted(r.offset for r in rows.collect())))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        reader(spark, tmp_path, max_records=4).poll(dies)
    append(spark, str(tmp_path / "topic"), [(0, 6, "b"), (1, 0, "b")])
    seen, handle = collector()
    reader(spark, tmp_path, max_records=2).poll(handle)
    assert first == [(0, [o for _, o in seen[0]])] == [(0, [0, 1, 2, 3])]
    reader(spark, tmp_path, max_records=50).drain(handle)
    assert sorted(x for s in seen.values() for x in s) == [(0, i) for i in range(7)] + [(1, 0)]


def test_fewer_records_than_partitions_and_empty_topics(spark, tmp_path):
    append(spark, str(tmp_path / "topic"), [])
    seen, handle = collector()
    assert reader(spark, tmp_path, max_records=1).drain(handle) == 0
    append(spark, str(tmp_path / "topic"), [(p, 0, "a") for p in range(3)])
    assert reader(spark, tmp_path, max_records=1).drain(handle) == 3
    assert sorted(x for s in seen.values() for x in s) == [(p, 0) for p in range(3)]
    with pytest.raises(ValueError, match="max_records"):
        reader(spark, tmp_path, max_records=0)


def test_shares():
    assert _shares(["0", "1", "2"], 8, 0) == {"0": 3, "1": 3, "2": 2}
    assert _shares(["0", "1", "2"], 1, 5) == {"2": 1, "0": 0, "1": 0}
