"""The merging measure store, manifests and the delivery ledger."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators.measures import latest_measures, measures_long
from tickloom.sources.manifests import KEPT, Ledger, Manifest
from tickloom.streaming.stores import MeasureStore, merge_measures
from tickloom.streaming.vwap_jobs import send_once

T0 = datetime(2026, 1, 1)
PAIRS = "symbol string, close double, vwap double, window_start timestamp_ntz, window_end timestamp_ntz"


def pairs(spark, rng, n=6):
    rows = []
    for _ in range(n):
        start = T0 + timedelta(hours=12 * rng.randrange(6))
        rows.append((rng.choice("AB"), float(rng.randrange(100)), 1.0, start, start + timedelta(minutes=5)))
    return spark.createDataFrame(rows, PAIRS).coalesce(1)


def folders(path):
    return [n for n in os.listdir(path) if n.startswith("run-")]


def shown(df):
    return sorted(str((sorted(r.dimensions.items()), r.measure_name, r.measure_value, r.time, r.version)) for r in df.collect())


def test_many_batches_leave_few_runs(spark, tmp_path):
    rng, path, everything = random.Random(1), str(tmp_path / "store"), None
    store = MeasureStore(spark, path, fan_in=3)
    assert store.read().count() == 0
    for batch in range(30):
        records = measures_long(pairs(spark, rng), version=F.lit(rng.randrange(1000)).cast("long"))
        everything = records if everything is None else everything.unionByName(records)
        assert store.write(records, batch)
        assert not store.write(records, batch)  # repeated
    runs = Manifest(spark, f"{path}/_manifest").read()["runs"]
    assert len(runs) <= 2 * 4 and max(r["tier"] for r in runs) == 3
    assert len(folders(path)) <= len(runs) + 3 * (KEPT + 1)
    assert shown(store.read()) == shown(latest_measures(everything))
    day = (T0 + timedelta(days=1)).date()
    assert shown(store.read(since=day)) == shown(latest_measures(everything.filter(F.to_date("time") >= F.lit(day))))
    assert "PartitionFilters: [isnotnull(day" in store.read(since=day)._jdf.queryExecution().toString()


@pytest.mark.parametrize("died", ["merge before the manifest", "merge in the run", "write before the manifest"])
def test_a_death_half_way_loses_nothing(spark, tmp_path, monkeypatch, died):
    rng, path, held = random.Random(2), str(tmp_path / "store"), []
    store = MeasureStore(spark, path, fan_in=4)
    for batch in range(3):
        held.append(measures_long(pairs(spark, rng), version=F.lit(batch).cast("long")))
        store.write(held[-1], batch)
    held.append(measures_long(pairs(spark, rng), version=F.lit(3).cast("long")))
    calls = []

    def dies(plain, at):
        def run(self, *args):
            calls.append(1)
            if len(calls) == at:
                raise KeyboardInterrupt
            return plain(self, *args)

        return run

    if died == "merge in the run":
        monkeypatch.setattr(MeasureStore, "_write_run", dies(MeasureStore._write_run, 2))
    else:
        monkeypatch.setattr(Manifest, "put", dies(Manifest.put, 1 if died.startswith("write") else 2))
    with pytest.raises(KeyboardInterrupt):
        store.write(held[3], 3)
    monkeypatch.undo()
    whole = held[0].unionByName(held[1]).unionByName(held[2])
    if not died.startswith("write"):
        whole = whole.unionByName(held[3])
    assert shown(MeasureStore(spark, path, fan_in=4).read()) == shown(latest_measures(whole))
    store.write(held[3], 3)  # the stream repeats its batch
    store.merge()
    assert shown(store.read()) == shown(latest_measures(held[0].unionByName(held[1]).unionByName(held[2]).unionByName(held[3])))
    for batch in range(4, 12):
        store.write(measures_long(pairs(spark, rng), version=F.lit(batch).cast("long")), batch)
    runs = Manifest(spark, f"{path}/_manifest").read()["runs"]
    assert len(folders(path)) <= len(runs) + 4 * (KEPT + 1)  # what died is cleared


def test_handler_keeps_the_highest_version(spark, tmp_path):
    path = str(tmp_path / "store")
    for batch_id, (version, close) in enumerate([(5, 1.0), (9, 2.0), (7, 3.0)]):
        pair = spark.createDataFrame([("A", close, 1.0, T0, T0 + timedelta(minutes=5))], PAIRS)
        merge_measures(path, fan_in=2, version=F.lit(version).cast("long"))(pair, batch_id)
    assert {r.measure_name: r.measure_value for r in MeasureStore(spark, path).read().collect()} == {"close": 2.0, "vwap": 1.0}


def test_manifests(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"))
    assert manifest.read() is None and manifest.all() == []
    for i in range(6):
        manifest.put({"n": i, "text": "é"})
    assert manifest.read() == {"n": 5, "text": "é"} and [d["n"] for d in manifest.all()] == [3, 4, 5]
    (tmp_path / "m" / "_draft-x").write_text("{")  # a writer died here
    assert Manifest(spark, str(tmp_path / "m")).read()["n"] == 5


def test_a_repeated_batch_is_sent_once(spark, tmp_path):
    topic, ledger = str(tmp_path / "topic"), str(tmp_path / "ledger")
    messages = spark.createDataFrame([("A", "1"), ("B", "2")], "key string, value string")
    assert send_once(messages, 0, ledger, topic, fmt="json")
    assert send_once(messages, 1, ledger, topic, fmt="json")
    assert not send_once(messages, 1, ledger, topic, fmt="json")  # replayed after a crash before the checkpoint
    assert not send_once(messages, 0, ledger, topic, fmt="json")
    assert spark.read.json(topic).count() == 4
    assert Ledger(spark, ledger).has(1) and not Ledger(spark, ledger).has(2)
