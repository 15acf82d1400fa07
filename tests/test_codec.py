import json
import random

import pytest

from trafficlake.fixtures import traffic_from_events
from trafficlake.schema import EVENT_SCHEMA, READINGS
from trafficlake.sources.codec import classify_messages, decode_events, encode_events, quarantine, storable_events

VALID = '{"sensor_id": 3, "timestamp": "2026-01-08T10:11:12+00:00", "zone": "Périphérie", "vehicle_count": 12}'
MESSAGES = {
    VALID: None,
    "{broken": "undecodable",
    '{"vehicle_count":"x","zone":"A","timestamp":"2026-01-08T10:11:12+00:00"}': "undecodable",
    "[1, 2]": "undecodable",
    f"[{VALID}]": "undecodable",
    VALID + VALID: "undecodable",
    f"{VALID},{VALID}": "undecodable",
    VALID + " trailing": "undecodable",
    VALID + "}": "undecodable",
    VALID + "]": "undecodable",
    VALID + "]}": "undecodable",
    VALID.replace('"', "'"): "undecodable",
    "7": "undecodable",
    "null": "undecodable",
    "": "undecodable",
    "  ": "undecodable",
    "{}": "missing timestamp",
    '{"zone":"A"}': "missing timestamp",
    '{"zone":"A","timestamp":null}': "missing timestamp",
    '{"zone":"A","timestamp":"soon"}': "bad timestamp",
    '{"zone":"A","timestamp":"10:11:12"}': "bad timestamp",
    '{"zone":"A","timestamp":"T10:11"}': "bad timestamp",
    '{"zone":"A","timestamp":"2024"}': "bad timestamp",
    '{"zone":"A","timestamp":"2024-01"}': "bad timestamp",
    '{"zone":"A","timestamp":"2024-01-01"}': None,
    '{"zone":"A","timestamp":"2026-01-08T10:11:12+00:00","average_speed":40.5,"occupancy_rate":50.0}': None,
    VALID + '],"x":[{}': "undecodable",
    VALID + '],"complete":true}   ': "undecodable",
    VALID + '],"messages":[' + VALID: "undecodable",
    VALID + "," + VALID + "," + VALID: "undecodable",
    '{"timestamp":"2026-01-08T10:11:12+00:00"}': "missing zone",
}


@pytest.fixture
def messages(spark):
    return spark.createDataFrame([(bytearray(m, "utf-8"),) for m in MESSAGES] + [(None,)], "value binary")


def test_reasons(messages):
    got = {r.value: r.reason for r in quarantine(messages).collect()}
    assert got == {m: r for m, r in MESSAGES.items() if r} | {None: "undecodable"}


def test_every_message_is_stored_or_kept_aside(messages):
    assert storable_events(messages).count() + quarantine(messages).count() == messages.count()


def test_decode_keeps_what_can_be_read(messages):
    rows = decode_events(messages).collect()
    assert len(rows) == 12
    good = [r for r in rows if r.sensor_id == 3]
    assert [(r.zone, r.vehicle_count, r.event) for r in good] == [("Périphérie", 12, None)]


def test_invalid_bytes(spark):
    broken = VALID.encode("utf-8").replace("é".encode("utf-8"), b"\xff", 1)
    df = spark.createDataFrame([(bytearray(broken),)], "value binary")
    assert [r.reason for r in quarantine(df).collect()] == ["undecodable"]
    assert decode_events(df).count() == 0


def test_absent_event_is_left_out(event):
    rows = encode_events(event({"sensor_id": 5}, {"sensor_id": 6, "event": "accident"})).collect()
    assert [r.key for r in rows] == ["5", "6"]
    assert '"event"' not in rows[0].value
    assert '"event":"accident"' in rows[1].value


def test_damaged_messages_against_a_plain_parser(spark):
    """Valid messages with one to three characters removed, doubled or replaced."""
    rng = random.Random(7)
    texts = set()
    for _ in range(1500):
        text = list(VALID)
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice(["", text[at] * 2, rng.choice('{}[]",:0x ')])
        texts.add("".join(text))

    def is_event(text):
        try:
            event = json.loads(text)
        except ValueError:
            return False
        counts = [event.get(f.name) for f in EVENT_SCHEMA if f.dataType.simpleString() == "bigint"]
        readings = [event.get(name) for name in READINGS]
        return all(n is None or type(n) is int for n in counts) and all(n is None or type(n) in (int, float) for n in readings)

    df = spark.createDataFrame([(t,) for t in texts], "value string")
    decoded = {r.value for r in classify_messages(df).collect() if r.reason != "undecodable"}
    expected = {t for t in texts if is_event(t)}
    assert decoded == expected
    assert 0 < len(expected) < len(texts)
    assert storable_events(df).count() + quarantine(df).count() == len(texts)


def test_roundtrip(spark):
    events = traffic_from_events(spark, "/root/testdata/sf0.001")
    assert sorted(map(str, decode_events(encode_events(events)).collect())) == sorted(map(str, events.collect()))


def test_each_message_is_parsed_once(messages, plan):
    tree = plan(classify_messages(messages).where("reason IS NULL"))
    assert tree.count("Arguments: inline(array(from_json") == 1
    assert tree.count("from_json") == 1
