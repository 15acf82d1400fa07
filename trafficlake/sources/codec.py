"""Messages <-> events. A message is a row with a ``value`` of JSON bytes or text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.functions import dated_timestamp
from trafficlake.schema import EVENT_COLUMNS, EVENT_SCHEMA, READINGS

_EVENT_DDL = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in EVENT_SCHEMA)
_ENVELOPE_DDL = f"messages array<struct<{_EVENT_DDL}>>, complete boolean, corrupt string"
_PARSER_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt", "allowSingleQuotes": "false"}


def classify_messages(df: DataFrame) -> DataFrame:
    """``value`` as text, the event columns, and ``reason``: NULL for a storable event.

    Spark's parser stops at the end of the first JSON value and ignores what follows. Each message is
    therefore parsed as the middle one of three list elements; the outer two hold the message's own digest.
    A second value or other text after the event is then an error rather than lost, and a message that
    closes the list itself cannot leave three elements with that digest.

    The parsed struct goes through ``inline``: conditions on its fields cannot be pushed below
    a generator, so each message is parsed once, however many filters follow.
    """
    digest = F.sha2(F.col("value").cast("binary"), 256)
    mark = F.concat(F.lit('{"event":"'), digest, F.lit('"}'))
    envelope = F.concat(F.lit('{"messages":['), mark, F.lit(","), F.col("value"), F.lit(","), mark, F.lit('],"complete":true}'))
    parsed = F.from_json(envelope, _ENVELOPE_DDL, _PARSER_OPTIONS)
    rows = df.select(F.col("value").cast("string").alias("value")).select("value", F.inline(F.array(parsed)))
    event = F.get("messages", 1)
    own = F.sha2(F.col("value").cast("binary"), 256)
    decodable = (
        F.col("corrupt").isNull()
        & F.col("complete")
        & (F.size("messages") == 3)
        & (F.get("messages", 0)["event"] == own)
        & (F.get("messages", 2)["event"] == own)
        & event.isNotNull()
        & F.is_valid_utf8("value")
    )
    reason = (
        F.when(~F.coalesce(decodable, F.lit(False)), "undecodable")
        .when(event["timestamp"].isNull(), "missing timestamp")
        .when(dated_timestamp(event["timestamp"]).isNull(), "bad timestamp")
        .when(event["zone"].isNull(), "missing zone")
    )
    return rows.select("value", *[event[c].alias(c) for c in EVENT_COLUMNS], reason.alias("reason"))


def decode_events(df: DataFrame) -> DataFrame:
    """Events of all decodable messages."""
    return classify_messages(df).where("reason IS NULL OR reason <> 'undecodable'").select(*EVENT_COLUMNS)


def storable_messages(df: DataFrame) -> DataFrame:
    """``value`` and the event columns of messages that have a place in the raw lake; together with
    ``quarantine`` every message."""
    return classify_messages(df).where("reason IS NULL").drop("reason")


def storable_events(df: DataFrame) -> DataFrame:
    return storable_messages(df).select(*EVENT_COLUMNS)


def quarantine(df: DataFrame) -> DataFrame:
    """Messages that cannot be stored, unchanged, each with the reason."""
    return classify_messages(df).where("reason IS NOT NULL").select("value", "reason")


def encode_events(df: DataFrame) -> DataFrame:
    """``key`` (sensor id) and ``value`` (JSON text); absent fields are left out."""
    event = F.to_json(F.struct(*written_readings()))
    return df.select(F.col("sensor_id").cast("string").alias("key"), event.alias("value"))


def written_readings() -> list[Column]:
    """The event columns as JSON shows them: readings as plain numbers without the decimal type's zeros."""
    return [F.col(c).cast("double").alias(c) if c in READINGS else F.col(c) for c in EVENT_COLUMNS]
