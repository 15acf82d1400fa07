import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trafficlake.session import session_settings
from trafficlake.sinks.raw import write_raw
from trafficlake.sources.codec import encode_events, storable_events
from trafficlake.sources.raw import read_lake, read_raw, read_raw_days
from trafficlake.sources.topic import read_file_stream, read_topic, topic_batching, topic_options
from trafficlake.sinks.topic import topic_sink_options, write_topic
from trafficlake.streaming import ingest
from trafficlake.streaming.dedup import dedup_stream, late_events
from trafficlake.streaming.ingest import ingest_stream, quarantine_stream
from trafficlake.streaming.late import STATE_STORE, dedup_stream_tagged

NOW = {"availableNow": True}


def _message(sensor, timestamp, zone="Centre Ville", **more):
    return json.dumps({"sensor_id": sensor, "timestamp": timestamp, "zone": zone, **more})


class Feed:
    def __init__(self, tmp_path):
        self.inbox = tmp_path / "inbox"
        self.inbox.mkdir()
        self.out, self.checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
        self.count = 0

    def send(self, *messages):
        file = self.inbox / f"{self.count}.txt"
        file.write_text("\n".join(messages) + "\n")
        os.utime(file, (1_700_000_000 + self.count,) * 2)  # files are taken in the order of their times
        self.count += 1

    def ingest(self, spark, **options):
        messages = read_file_stream(spark, str(self.inbox), max_files=1)
        stream = ingest_stream(messages, self.out, self.checkpoint, trigger=NOW, **options)
        stream.awaitTermination()
        assert stream.exception() is None


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path)


@pytest.mark.parametrize("options", [{}, {"writers": 4}, {"writers": 4, "spread": 1}])
def test_events_land_in_their_own_day(spark, feed, options):
    feed.send(_message(1, "2026-01-08T23:59:59+00:00"), "{broken")
    feed.send(_message(2, "2026-01-09T00:00:01+00:00"), _message(3, "2026-01-09T01:30:00+02:00", "Périphérie"))
    feed.ingest(spark, **options)
    rows = {r.sensor_id: r for r in read_lake(spark, feed.out).collect()}
    assert {s: (r.day, r.zone, r.zone_key) for s, r in rows.items()} == {
        1: ("08", "Centre Ville", "Centre_Ville"),
        2: ("09", "Centre Ville", "Centre_Ville"),
        3: ("08", "Périphérie", "Périphérie"),
    }


def test_restart_adds_only_new_messages(spark, feed):
    feed.send(_message(1, "2026-01-08T10:00:00+00:00"))
    feed.ingest(spark)
    feed.ingest(spark)
    assert read_raw(spark, feed.out).count() == 1
    feed.send(_message(2, "2026-01-08T10:00:00+00:00"))
    feed.ingest(spark)
    assert sorted(r.sensor_id for r in read_raw(spark, feed.out).collect()) == [1, 2]


def _lake(spark, feed):
    return sorted(map(str, read_lake(spark, feed.out).collect()))


STEPS = ["remove", "_stage", "_commit", "write_text", "move_all", "half of move_all", "names"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_killed_ingestion_resumes(spark, feed, tmp_path, monkeypatch, step, after):
    """A query that dies before or after any step leaves what a restarted one completes: every message once."""
    aside = str(tmp_path / "aside")
    feed.send(*[_message(i, f"2026-01-{8 + i % 3:02d}T10:00:00+00:00") for i in range(9)], "{broken")
    feed.send(_message(100, "2026-01-08T10:00:00+00:00"), _message(101, "soon"))
    step, half = step.rpartition(" ")[2], " " in step
    home = ingest._Sink if step.startswith("_") else ingest
    plain = getattr(home, step)

    def dies(*args):
        if half:
            plain(args[0], args[1][after::2])
        elif after:
            plain(*args)
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(home, step, dies)
        with pytest.raises(Exception, match="killed"):
            feed.ingest(spark, quarantine=aside)
    feed.ingest(spark, quarantine=aside)
    assert sorted(r.sensor_id for r in read_lake(spark, feed.out).collect()) == [*range(9), 100]
    assert sorted(r.reason for r in spark.read.json(aside).collect()) == ["bad timestamp", "undecodable"]
    assert not list(Path(feed.out).glob("_staging/*"))


def test_staged_files_are_not_read(spark, feed, monkeypatch):
    feed.send(_message(1, "2026-01-08T10:00:00+00:00"))
    feed.ingest(spark)
    feed.send(_message(9, "2026-01-08T10:00:00+00:00"))

    def dies(*args):
        raise RuntimeError("killed")

    monkeypatch.setattr(ingest._Sink, "_commit", dies)
    with pytest.raises(Exception, match="killed"):
        feed.ingest(spark)
    assert list(Path(feed.out).glob("_staging/*"))
    for reader in (read_raw, read_lake, read_raw_days):
        assert [r.sensor_id for r in reader(spark, feed.out).collect()] == [1]


def test_day_range_of_a_stream_lake_lists_its_days(spark, feed):
    feed.send(*[_message(i, f"2026-01-{8 + i % 3:02d}T10:00:00+00:00") for i in range(9)])
    feed.ingest(spark)
    one = read_raw_days(spark, feed.out, "2026-01-09", "2026-01-09")
    assert {r.day for r in one.collect()} == {"09"} and all("day=09" in f for f in one.inputFiles())


def test_one_parse_for_lake_and_quarantine(spark, plan):
    rows = ingest.sorted_messages(spark.createDataFrame([("{}",)], "value string"), True)
    text = plan(rows.hint("rebalance", F.col("sink")))
    assert text.count("from_json(") <= 2 and text.count("Generate") <= 2  # once in the tree, once in the details


def test_small_directories_share_a_file_and_lists_are_purged(spark, feed, monkeypatch):
    monkeypatch.setattr(ingest, "_KEPT_LISTS", 2)
    for i in range(4):
        feed.send(*[_message(j, "2026-01-08T10:00:00+00:00", f"Z{j % 3}") for j in range(60)])
    feed.ingest(spark)
    assert len(list(Path(feed.out).glob("year=*/month=*/day=*/zone_key=*/*.txt"))) == 4 * 3
    assert len(list(Path(feed.checkpoint).glob("stored/*.json"))) == 2


def test_two_streams_share_a_lake(spark, feed, tmp_path):
    feed.send(_message(1, "2026-01-08T10:00:00+00:00"))
    feed.ingest(spark)
    feed.checkpoint = str(tmp_path / "other")
    feed.ingest(spark)
    assert [r.sensor_id for r in read_raw(spark, feed.out).collect()] == [1, 1]


def test_logged_lakes_are_refused(spark, feed):
    Path(feed.out, "_spark_metadata").mkdir(parents=True)
    feed.send(_message(1, "2026-01-08T10:00:00+00:00"))
    with pytest.raises(ValueError, match="file log"):
        feed.ingest(spark)


def test_special_characters_in_zones(spark, feed):
    zones = ["A/B", "50%", "a=b", "é:ü", "x y", "%2F"]
    feed.send(*[_message(i, "2026-01-08T10:00:00+00:00", z) for i, z in enumerate(zones)])
    feed.ingest(spark)
    assert sorted(r.zone_key for r in read_lake(spark, feed.out).collect()) == sorted(z.replace(" ", "_") for z in zones)


def test_stream_equals_batch(spark, feed, tmp_path, event):
    events = event(*[{"sensor_id": s, "zone": z} for s in range(20) for z in ("A b", "C")])
    values = [r.value for r in encode_events(events).collect()]
    feed.send(*values[:15], "{broken")
    feed.send(*values[15:])
    feed.ingest(spark)
    batch = str(tmp_path / "batch")
    write_raw(storable_events(encode_events(events)), batch)
    assert sorted(map(str, read_lake(spark, feed.out).collect())) == sorted(map(str, read_lake(spark, batch).collect()))


def test_whole_messages_are_stored(spark, feed):
    """Unknown fields, decimals and spelling stay; line breaks between values become spaces."""
    text = '{"lane": 3, "sensor_id":1,"average_speed":40.50,  "timestamp":"2026-01-08T10:00:00+00:00","zone":"A"}'
    feed.send(text)
    feed.ingest(spark, writers=2)
    assert [r.value for r in spark.read.text(feed.out).collect()] == [text]
    assert [(r.sensor_id, float(r.average_speed)) for r in read_lake(spark, feed.out).collect()] == [(1, 40.5)]


def test_late_events_are_counted(spark, feed):
    feed.send(_message(1, "2026-01-08T10:00:00+00:00"))
    feed.send(_message(2, "2026-01-08T12:00:00+00:00"))
    feed.send(_message(3, "2026-01-08T09:00:00+00:00"), _message(4, "2026-01-08T12:01:00+00:00"))
    events = storable_events(read_file_stream(spark, str(feed.inbox), max_files=1))
    stream = dedup_stream(events, "10 minutes").writeStream.format("memory").queryName("late").outputMode("append")
    stream = stream.option("checkpointLocation", feed.checkpoint).start()
    try:
        stream.processAllAvailable()
        assert late_events(stream) + spark.table("late").count() == 4
        assert late_events(stream) == 1
    finally:
        stream.stop()


def test_quarantine_stream(spark, feed, tmp_path):
    feed.send(_message(1, "2026-01-08T10:00:00+00:00"), "{broken", _message(2, "soon"))
    out = str(tmp_path / "aside")
    messages = read_file_stream(spark, str(feed.inbox))
    quarantine_stream(messages, out, str(tmp_path / "checkpoint-aside"), trigger=NOW).awaitTermination()
    rows = spark.read.schema("value string, reason string").json(out).collect()
    assert {(r.value, r.reason) for r in rows} == {
        ("{broken", "undecodable"),
        (_message(2, "soon"), "bad timestamp"),
    }


@pytest.mark.parametrize("spread", [1, 8])
def test_dedup_stream(spark, feed, spread):
    first, second = _message(1, "2026-01-08T10:00:00+00:00"), _message(2, "2026-01-08T10:00:00+00:00")
    feed.send(first, first, second, _message(3, "soon"))
    feed.send(first, _message(1, "2026-01-08T10:00:00+00:00", "other"))
    feed.send(second, _message(1, "2026-01-08T10:01:00+00:00"))
    events = storable_events(read_file_stream(spark, str(feed.inbox), max_files=1))
    name = f"unique_{spread}"
    stream = (
        dedup_stream(events, "1 hour", spread)
        .writeStream.format("memory")
        .queryName(name)
        .option("checkpointLocation", feed.checkpoint)
        .outputMode("append")
        .start()
    )
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    rows = sorted((r.sensor_id, r.timestamp[14:16]) for r in spark.table(name).collect())
    assert rows == [(1, "00"), (1, "01"), (2, "00")]


def test_late_first_arrivals_are_tagged(spark, feed):
    """Output and late events together are the distinct keys; the smallest copy of a micro-batch stays; state expires."""
    first = _message(1, "2026-01-08T10:00:00+00:00", "B")
    feed.send(first, _message(1, "2026-01-08T10:00:00+00:00", "A"), first, _message(3, "soon"), _message(None, "2026-01-08T10:00:00+00:00"))
    feed.send(first, _message(2, "2026-01-08T12:00:00+00:00"), _message(None, "2026-01-08T10:00:00+00:00"))
    feed.send(_message(3, "2026-01-08T09:00:00+00:00"), _message(4, "2026-01-08T12:00:30+00:00"), _message(2, "2026-01-08T12:00:00+00:00"))
    feed.send(_message(3, "2026-01-08T09:00:00+00:00"), _message(5, "2026-01-08T11:55:00+00:00"))
    feed.send(_message(6, "2026-01-08T23:00:00+00:00"))
    feed.send(_message(7, "2026-01-08T23:01:00+00:00"))
    events = storable_events(read_file_stream(spark, str(feed.inbox), max_files=1))
    with session_settings(spark, STATE_STORE):
        stream = dedup_stream_tagged(events, "10 minutes", spread=2).writeStream.format("memory").queryName("tagged")
        stream = stream.option("checkpointLocation", feed.checkpoint).start()
    try:
        stream.processAllAvailable()
        rows = sorted((r.sensor_id or 0, r.timestamp[11:16], r.zone, r.late) for r in spark.table("tagged").collect())
        ordinary = [(0, "10:00"), (2, "12:00"), (4, "12:00"), (5, "11:55"), (6, "23:00"), (7, "23:01")]
        expected = [(s, t, "Centre Ville", False) for s, t in ordinary] + [(1, "10:00", "A", False), (3, "09:00", "Centre Ville", True)]
        assert rows == sorted(expected)
        assert stream.lastProgress["stateOperators"][0]["numRowsTotal"] < 12
    finally:
        stream.stop()


def test_topic_options():
    assert topic_options("b:9092", **topic_batching()) == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "traffic-events",
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": "50",
        "maxTriggerDelay": "30s",
    }
    assert topic_batching(1000, "1m", 5000)["maxOffsetsPerTrigger"] == "5000"
    assert topic_options("b:9092", startingOffsets="latest")["startingOffsets"] == "latest"
    assert topic_sink_options("b:9092", "t") == {
        "kafka.bootstrap.servers": "b:9092",
        "topic": "t",
        "kafka.acks": "all",
    }


def test_topic_needs_the_connector(spark, event):
    for call in (lambda: read_topic(spark, "b:9092"), lambda: write_topic(event({}), "b:9092")):
        with pytest.raises(Exception, match="(?i)kafka"):
            call()
