"""The options handed to the topic connector, recorded by a stand-in (the connector is not installed here)."""

import json

from tickloom.sources.topics import read_topic, sasl_options, stream_topic, write_topic
from tickloom.streaming.runners import EVERY_MINUTE, start_topic


class Recorder:
    """Stands for a session, a reader, a writer or a frame; keeps what it is told."""

    def __init__(self):
        self.told = {}

    read = readStream = write = writeStream = property(lambda self: self)

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def select(self, *columns):
        self.told["columns"] = columns
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    outputMode = mode

    def trigger(self, **how):
        self.told["trigger"] = how
        return self

    def load(self, *path):
        return self

    save = start = load


CONNECTION = sasl_options("host:9092", "user", "word", protocol="SASL_PLAINTEXT")


def has_connection(told):
    return all(told[name] == value for name, value in CONNECTION.items())


def test_stream_source():
    told = stream_topic(Recorder(), "candles", CONNECTION, max_per_trigger=500, group_id="g").told
    assert told["format"] == "kafka" and told["subscribe"] == "candles" and told["startingOffsets"] == "latest"
    assert told["maxOffsetsPerTrigger"] == 500 and told["kafka.group.id"] == "g" and has_connection(told)


def test_bounded_read():
    told = read_topic(Recorder(), "candles", CONNECTION).told
    assert (told["subscribe"], told["startingOffsets"], told["endingOffsets"]) == ("candles", "earliest", "latest")
    told = read_topic(Recorder(), "candles", CONNECTION, partitions=[0], starting='{"candles":{"0":5}}').told
    assert json.loads(told["assign"]) == {"candles": [0]} and "subscribe" not in told
    assert told["startingOffsets"] == '{"candles":{"0":5}}' and has_connection(told)


def test_sinks_use_the_same_connection_as_sources():
    batch = Recorder()
    write_topic(batch, "vwap", CONNECTION)
    assert batch.told["topic"] == "vwap" and batch.told["columns"] == ("key", "value") and has_connection(batch.told)
    stream = start_topic(Recorder(), "vwap", "/cp", CONNECTION, mode="update", trigger=EVERY_MINUTE).told
    assert stream["topic"] == "vwap" and stream["checkpointLocation"] == "/cp" and stream["mode"] == "update"
    assert stream["trigger"] == {"processingTime": "1 minute"} and has_connection(stream)
