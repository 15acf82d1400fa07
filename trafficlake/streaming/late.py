"""Deduplication of a stream that keeps late first arrivals, marked, instead of dropping them.

Keys already seen are state: one list for each minute of event time and each of ``spread`` hash parts, so a
micro-batch asks for state once a list and not once an event. A list expires, by an event-time timer, when the
watermark is ``delay`` past its minute.
"""

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructField, StructType

from trafficlake.functions import parsed_timestamp
from trafficlake.schema import EVENT_COLUMNS, EVENT_SCHEMA

#: State of this kind lives in RocksDB only; the setting to start the session, or the query, with.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}
_MINUTE_MS = 60_000
_TAGGED = StructType([*EVENT_SCHEMA.fields, StructField("late", BooleanType())])


def dedup_stream_tagged(events: DataFrame, delay: str, spread: int = 64) -> DataFrame:
    """The first arrival of each (sensor_id, timestamp) with ``late``: whether it came when its event time was already
    behind the watermark, the latest event time of the micro-batches before less ``delay``.

    Rows that are not late are unique. A late one is unique among late ones for ``delay``, but may be a copy of
    an event from long before: what was seen then is forgotten, which bounds the state. Of copies in one
    micro-batch the smallest stays, so a repeated one picks the same. Events without a readable timestamp are
    left out, as ``dedup_stream`` does. A group's copies are read one by one, whatever their number; choose
    ``spread`` such that a minute's events, divided by it, fit a task's memory. Needs ``STATE_STORE``.
    """
    timed = events.withColumn("event_time", parsed_timestamp(F.col("timestamp"))).where("event_time IS NOT NULL")
    timed = timed.withWatermark("event_time", delay)
    # A column that no longer is the watermark's: else Spark drops late rows before the processor sees them.
    arrived = F.unix_millis(F.col("event_time") + F.expr("INTERVAL 0 SECONDS"))
    rows = timed.select(*EVENT_COLUMNS, arrived.alias("event_ms"))
    minute = F.floor(F.col("event_ms") / _MINUTE_MS).alias("minute")
    part = F.pmod(F.xxhash64("sensor_id", "timestamp"), F.lit(spread)).alias("part")
    grouped = rows.select("*", minute, part).groupBy("minute", "part")
    return grouped.transformWithState(_FirstArrivals(_milliseconds(events, delay)), _TAGGED, "Append", "EventTime")


def _milliseconds(df: DataFrame, delay: str) -> int:
    zero = "timestamp'1970-01-01 00:00:00Z'"
    return df.sparkSession.sql(f"SELECT unix_millis({zero} + INTERVAL '{delay}') AS ms").first()["ms"]


class _FirstArrivals(StatefulProcessor):
    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "keys array<string>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        state = self.seen.get()
        seen = set(state[0]) if state else set()
        new: dict[str, Row] = {}
        for row in rows:
            name = f"{row.sensor_id}|{row.timestamp}"
            if name not in seen and (name not in new or _order(row) < _order(new[name])):
                new[name] = row
        if not new:
            return
        self.seen.update(([*seen, *new],))
        self.handle.registerTimer(max((key[0] + 1) * _MINUTE_MS, watermark) + self.delay_ms)
        for row in new.values():
            yield Row(**{c: row[c] for c in EVENT_COLUMNS}, late=row.event_ms <= watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # Events that came since the timer was set have set a later one.
        if not any(at > expiredTimerInfo.getExpiryTimeInMs() for at in self.handle.listTimers()):
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def _order(row: Row) -> tuple:
    return tuple((row[c] is not None, row[c]) for c in EVENT_COLUMNS)
