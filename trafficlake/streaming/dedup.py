from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trafficlake.functions import parsed_timestamp
from trafficlake.schema import EVENT_COLUMNS, EVENT_KEY


def dedup_stream(events: DataFrame, delay: str, spread: int = 1) -> DataFrame:
    """First arrival per (sensor_id, timestamp); later copies within ``delay`` are dropped.

    State is one entry per key for the length of ``delay``. Events older than the latest one by more than
    ``delay`` when their micro-batch begins cannot be compared any more: Spark drops them, first arrivals
    too, and ``late_events`` of the running query tells how many. Choose ``delay`` above the lateness to
    expect, or take late days from the raw lake, which keeps everything, by the batch job.

    With ``spread`` above 1 copies of one key are first thinned out on that many tasks, by the task they come
    from, which pays where one key's copies arrive by many source partitions; a topic written by
    ``write_topic`` has them all in one. Events without a readable timestamp have no event time and are
    left out.
    """
    timed = events.withColumn("event_time", parsed_timestamp(F.col("timestamp"))).where("event_time IS NOT NULL")
    timed = timed.withWatermark("event_time", delay)
    if spread > 1:
        timed = timed.withColumn("lane", F.spark_partition_id() % spread)
        timed = timed.dropDuplicatesWithinWatermark([*EVENT_KEY, "lane"])
    return timed.dropDuplicatesWithinWatermark(EVENT_KEY).select(*EVENT_COLUMNS)


def late_events(query: StreamingQuery) -> int:
    """Events that ``dedup_stream`` dropped as later than its delay, in the micro-batches the query remembers."""
    operators = [o for progress in query.recentProgress for o in progress["stateOperators"]]
    return sum(o["numRowsDroppedByWatermark"] for o in operators)
