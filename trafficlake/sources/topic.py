"""Streams of raw messages. The topic source needs Spark's Kafka connector on the classpath."""

from pyspark.sql import DataFrame, SparkSession

from trafficlake.schema import BATCH_MAX_DELAY, BATCH_MIN_MESSAGES, TOPIC_NAME


def topic_batching(
    min_rows: int = BATCH_MIN_MESSAGES, max_delay: str = BATCH_MAX_DELAY, max_rows: int | None = None
) -> dict[str, str]:
    """Source options that start a micro-batch at ``min_rows`` new messages or after ``max_delay``.

    The small defaults suit a demo feed. Raise ``min_rows`` with the rate of the topic, since
    every micro-batch writes at least one file per day and zone. ``max_rows`` bounds a
    micro-batch, above all the first one, which starts at the beginning of the topic.
    """
    options = {"minOffsetsPerTrigger": str(min_rows), "maxTriggerDelay": max_delay}
    if max_rows is not None:
        options["maxOffsetsPerTrigger"] = str(max_rows)
    return options


def topic_options(servers: str, topic: str = TOPIC_NAME, **options: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **options,
    }


def read_topic(spark: SparkSession, servers: str, topic: str = TOPIC_NAME, **options: str) -> DataFrame:
    """Messages of a topic from its beginning; later starts resume from the stream's checkpoint."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **options)).load()


def read_file_stream(
    spark: SparkSession, directory: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Messages from text files, one per line, as they arrive in ``directory``.

    A micro-batch takes at most ``max_files`` files, or files of ``max_bytes`` together (at least one
    file).
    """
    reader = spark.readStream.format("text")
    if max_files is not None and max_bytes is not None:
        raise ValueError("a micro-batch is bounded by files or by bytes, not both")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(directory)
