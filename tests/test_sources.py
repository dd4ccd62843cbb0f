"""Readers and writers whose other end cannot be started here, up to what they ask for."""

import pytest
from helpers import VALID, raw, rows_of

from curbline.operators import shards
from curbline.operators.canonical import canonical_events
from curbline.schema import EVENT_COLUMNS, SHARD_COLUMNS, TRIGGER
from curbline.session import work_dir
from curbline.sources import messages, relational, shard_csv
from curbline.streaming.sinks import start_writer


class Reader:
    """Notes the options of a reader or writer."""

    def __init__(self):
        self.seen = {}

    @property
    def readStream(self):
        return self

    read = write = readStream

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def load(self):
        return self.seen

    def jdbc(self, url, table, predicates, properties):
        return url, table, predicates, properties


def test_bus_source_options():
    assert messages.kafka_stream(Reader(), "a:1,b:2", "x,y") == {
        "format": "kafka", "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "x,y",
        "startingOffsets": "earliest", "failOnDataLoss": "false",
    }
    limited = messages.kafka_stream(Reader(), "a:1", "x", "latest", 500)
    assert (limited["startingOffsets"], limited["maxOffsetsPerTrigger"]) == ("latest", 500)


class Writer(dict):
    """Records what a batch or stream writer is told."""

    def __init__(self):
        super().__init__()
        self.write = self.writeStream = self

    def _set(self, key, value):
        self[key] = value
        return self

    def format(self, name):
        return self._set("format", name)

    def option(self, key, value):
        return self._set(key, value)

    def outputMode(self, mode):
        return self._set("mode", mode)

    def trigger(self, **when):
        return self._set("trigger", when)

    def start(self):
        return self

    def save(self):
        self["saved"] = True


def test_bus_sinks_take_partial_events_and_streams(monkeypatch):
    asked, writers = [], []

    def payload(events, fields):
        asked.append(fields)
        writers.append(Writer())
        return writers[-1]

    monkeypatch.setattr(messages, "message_payload", payload)
    bus = {"format": "kafka", "kafka.bootstrap.servers": "a:1", "kafka.acks": "all", "topic": "parts"}
    fields = ("trip_id", "pickup_latitude")
    messages.publish_kafka(None, "a:1", "parts", fields)
    assert asked == [fields] and writers[0] == bus | {"saved": True}
    messages.publish_kafka_stream(None, "a:1", "parts", "check")
    assert asked[1] == EVENT_COLUMNS
    assert writers[1] == bus | {
        "mode": "append", "checkpointLocation": "check", "trigger": {"processingTime": TRIGGER},
    }


def test_relational_source_reads_date_spans():
    url, table, spans, properties = relational.read_staging_table(
        Reader(), "jdbc:x", "staging.trips", "u", "p", ["2014-04-01", "2014-04-08", "2014-04-15"]
    )
    assert (url, table, properties["user"]) == ("jdbc:x", "staging.trips", "u")
    assert spans == [
        "trip_date >= date '2014-04-01' and trip_date < date '2014-04-08'",
        "trip_date >= date '2014-04-08' and trip_date < date '2014-04-15'",
    ]
    with pytest.raises(ValueError):
        relational.read_staging_table(Reader(), "jdbc:x", "t", "u", "p", ["2014-04-01"])


def test_shards_stream_as_partial_events(spark):
    folder = work_dir(spark, "shards")
    rows = raw(spark, VALID, ("bad", *VALID[1:]), ("4/1/2014 1:0:0", "95", "-74", ""))
    shard_csv.write_shard_csv(shards.split_columns(rows), f"{folder}/in")
    counts = {}
    for role in SHARD_COLUMNS:
        stream = shard_csv.stream_shard_csv(spark, f"{folder}/in", role, max_files=1)
        writer = shards.partial_events(role, stream).writeStream.format("parquet")
        start_writer(
            writer.option("path", f"{folder}/out/{role}"), f"{folder}/checkpoint/{role}", "available"
        ).awaitTermination()
        counts[role] = spark.read.parquet(f"{folder}/out/{role}").count()
    assert counts == {"datetime": 2, "latitude": 2, "longitude_base": 2}


def test_merged_table_is_read_by_its_five_columns(spark):
    folder = work_dir(spark, "merged")
    events = canonical_events(raw(spark, VALID), keep_row_number=True)
    events.write.parquet(folder)
    assert rows_of(shard_csv.read_merged(spark, folder)) == rows_of(events.drop("row_number"))
