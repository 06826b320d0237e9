"""Connectors that cannot run here: what they ask of Spark."""

from maintlake.schemas import ENTITY_TOPICS
from maintlake.sources import feed, replica


class Recorder:
    """Stands for a reader or writer and records the calls made on it."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call

    @property
    def settings(self):
        return {args[0]: args[1] for name, args, _ in self.calls if name == "option"}


class Owner:
    def __init__(self, **attributes):
        self.__dict__.update(attributes)


def test_kafka_stream_reads_all_topics_from_the_start(spark):
    reader = Recorder()
    feed.kafka_stream(Owner(readStream=reader), "host:9092", max_offsets_per_trigger=1000)
    assert ("format", ("kafka",), {}) in reader.calls
    assert reader.settings == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": ",".join(ENTITY_TOPICS.values()),
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": 1000,
    }


def test_kafka_sink_sends_keyed_messages(spark, monkeypatch):
    writer = Recorder()
    monkeypatch.setattr(feed, "feed_messages", lambda bronze: Owner(write=writer))
    feed.write_kafka(None, "host:9092")
    assert ("format", ("kafka",), {}) in writer.calls and writer.calls[-1][0] == "save"


def test_jdbc_sink_truncates_and_reloads():
    writer = Recorder()
    replica.jdbc_sink("jdbc:x://db", {"user": "u"}, partitions=4)(Owner(write=writer), "staging_gold.mtbf_metrics")
    assert writer.settings == {
        "url": "jdbc:x://db", "dbtable": "staging_gold.mtbf_metrics", "truncate": True, "numPartitions": 4, "batchsize": 10_000,
    }
    assert ("mode", ("overwrite",), {}) in writer.calls and ("options", (), {"user": "u"}) in writer.calls
