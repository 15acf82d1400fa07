from pyspark.sql import DataFrame

from trafficlake.schema import TOPIC_NAME
from trafficlake.sources.codec import encode_events


def topic_sink_options(servers: str, topic: str = TOPIC_NAME, **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", **options}


def write_topic(df: DataFrame, servers: str, topic: str = TOPIC_NAME, **options: str) -> None:
    """Publish events, each acknowledged by all replicas before its task ends."""
    encode_events(df).write.format("kafka").options(**topic_sink_options(servers, topic, **options)).save()
