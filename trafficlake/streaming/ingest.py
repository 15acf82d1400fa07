"""Messages to the raw lake, and those that have no place there to a folder of their own.

One query does both and parses each message once. A micro-batch is written to a hidden folder of the lake, then
listed in a file that appears by one rename, which commits it, and then moved file by file to its directories. A
micro-batch that Spark repeats after a failure is written anew if it was not committed, and else only moved on. So
each message is stored once, and the lake's directories hold nothing but committed files: readers and ranges of
days list directories, no log that grows for ever.
"""

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trafficlake.operators.enrich import with_partition_keys
from trafficlake.paths import exists, files, move_all, names, read_text, remove, same_file_system, write_text
from trafficlake.schema import PARTITION_KEYS
from trafficlake.session import session_settings
from trafficlake.sources.codec import classify_messages, quarantine

#: Lists of so many committed micro-batches are kept; Spark repeats none but the last.
_KEPT_LISTS = 100
_EVENTS, _ASIDE = "events", "quarantine"
#: Adaptive execution is off in streams; a micro-batch without state can use it.
_SETTINGS = {"spark.sql.adaptive.enabled": "true"}


def sorted_messages(messages: DataFrame, keep_quarantined: bool) -> DataFrame:
    """``value`` as the line to store, ``sink`` and the directory keys, which quarantined messages lack; parsed once.

    A message is stored whole: fields the library does not know stay in the lake, and numbers keep their
    spelling. Line breaks, which JSON allows between values only, become spaces.
    """
    rows = with_partition_keys(classify_messages(messages))
    if not keep_quarantined:
        rows = rows.where("reason IS NULL")
    line = F.regexp_replace("value", "[\\r\\n]+", " ")
    aside = F.to_json(F.struct("value", "reason"))
    return rows.select(
        F.when(F.col("reason").isNull(), line).otherwise(aside).alias("value"),
        F.when(F.col("reason").isNull(), _EVENTS).otherwise(_ASIDE).alias("sink"),
        *[F.when(F.col("reason").isNull(), F.col(k)).alias(k) for k in PARTITION_KEYS],
    )


class _Sink:
    """Stores micro-batches, each once."""

    def __init__(self, out: str, quarantine: str | None, checkpoint: str, writers: int | None, spread: int | None):
        self.out, self.quarantine = out.rstrip("/"), quarantine and quarantine.rstrip("/")
        self.lists = f"{checkpoint.rstrip('/')}/stored"
        self.writers, self.spread = writers, spread
        # Streams with other checkpoints count their batches too.
        self.stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def store(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        staging, listed = f"{self.out}/_staging/{self.stream}-{number}", f"{self.lists}/{number:012d}.json"
        if exists(spark, listed):
            # It was committed before; what is still here has not been moved.
            moves = [move for move in json.loads(read_text(spark, listed)) if exists(spark, move[0])]
        else:
            remove(spark, staging)
            with session_settings(spark, _SETTINGS):
                self._stage(batch, staging)
            moves = self._commit(spark, staging, listed, number)
        move_all(spark, moves)
        remove(spark, staging)
        for name in names(spark, self.lists)[:-_KEPT_LISTS]:
            remove(spark, f"{self.lists}/{name}")

    def _stage(self, batch: DataFrame, staging: str) -> None:
        rows = sorted_messages(batch, self.quarantine is not None)
        if self.writers is None:
            # Small directories share a task, and a busy one is split into several of the advisory size.
            rows = rows.hint("rebalance", F.col("sink"), *[F.col(k) for k in PARTITION_KEYS])
        else:
            rows = _spread(rows, self.writers, self.spread)
        rows.write.partitionBy("sink", *PARTITION_KEYS).text(staging)

    def _commit(self, spark: SparkSession, staging: str, listed: str, number: int) -> list[tuple[str, str]]:
        """List where each file comes from and goes to."""
        moves = []
        for file in files(spark, staging):
            sink, _, rest = file.partition("/")
            folder, _, name = rest.rpartition("/")
            name = f"{self.stream}-{number:012d}-{name}"
            target = f"{self.out}/{folder}/{name}" if sink == f"sink={_EVENTS}" else f"{self.quarantine}/{name}"
            moves.append((f"{staging}/{file}", target))
        write_text(spark, listed, json.dumps(moves))
        return moves


def _spread(df: DataFrame, writers: int, spread: int | None) -> DataFrame:
    """Bring the rows of one directory to at most ``spread`` of ``writers`` tasks.

    The salt comes from the message, so a repeated task writes the same rows. By default a
    directory may use a third of the tasks, which keeps them even if it gets a third of the rows.
    """
    salt = F.pmod(F.xxhash64("value"), F.lit(spread or -(-writers // 3)))
    return df.repartition(writers, "sink", *PARTITION_KEYS, salt)


def ingest_stream(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    writers: int | None = None,
    spread: int | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Store the messages whose events have a place in the raw lake, each exactly once, in the directory of its own
    date and zone; the others, with the reason, as JSON Lines in ``quarantine``, if that is named.

    Files are balanced by directory as adaptive execution sees fit; with ``writers`` a micro-batch has so many
    writing tasks, and at most ``spread`` files per directory. ``trigger`` holds arguments of
    ``DataStreamWriter.trigger``. Lake and quarantine must be on one file system, whose renames are atomic. A
    lake whose files an earlier version kept in a log (``_spark_metadata``) is refused, as its readers would
    not see new ones: copy its days to another root with ``compact_days``.
    """
    spark = messages.sparkSession
    if exists(spark, f"{out.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{out} is kept by a file log; copy its days to a new root first")
    if quarantine is not None and not same_file_system(spark, out, quarantine):
        raise ValueError("lake and quarantine must be on one file system")
    sink = _Sink(out, quarantine, checkpoint, writers, spread)
    writer = messages.select("value").writeStream.foreachBatch(sink.store)
    return _started(writer, checkpoint, trigger).start()


def quarantine_stream(
    messages: DataFrame, out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Store only the messages ``ingest_stream`` leaves out, each with the reason, by a query of its own."""
    return _started(quarantine(messages).writeStream.format("json"), checkpoint, trigger).start(out)


def _started(writer, checkpoint: str, trigger: dict | None):
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer
