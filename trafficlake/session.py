"""Session settings and scratch space."""

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Show and parse zone-less timestamps as UTC, which is how the events are written."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def workers_find_package(spark: SparkSession) -> SparkSession:
    """Let Python workers of a local session find this package, wherever the session was started; on a cluster
    ``--py-files`` does. Once per session is enough, and often does no harm."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    Tables staged here must be readable from every executor, so a machine-local folder is only
    used in local mode with the setting absent.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or _checkpoint_dir(spark)
    if shared:
        return f"{shared.rstrip('/')}/trafficlake/{label}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{tempfile.mkdtemp(prefix='run-', dir='/tmp')}/{label}"


def _checkpoint_dir(spark: SparkSession) -> str | None:
    """The folder given to ``SparkContext.setCheckpointDir``, without the level Spark adds below it."""
    context = getattr(spark, "sparkContext", None)
    found = context.getCheckpointDir() if context else None
    return found.rstrip("/").rpartition("/")[0] if found else None


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the time of a job; afterwards each is as before. The number of shuffle partitions is only
    ever raised."""
    key = "spark.sql.shuffle.partitions"
    settings = settings | {key: str(max(int(spark.conf.get(key)), int(settings.get(key, 0))))}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


_MIB = 1024**2
_GIB = 1024**3
_MERGED_BYTES = 32 * _MIB


def settings_for(input_bytes: int) -> dict[str, str]:
    """Session settings for a batch over ``input_bytes`` of raw JSON.

    Adaptive execution merges small shuffle partitions, here up to ``_MERGED_BYTES``, about a million events; it cannot
    split those of an aggregate, so their number follows the input: one per GiB of JSON. An aggregate sorts its
    partition, in about as much memory as the JSON has. Large inputs get larger partitions, at most about 25,000 of
    them, and larger scan tasks, at most about 100,000, as shuffle bookkeeping grows with the product of the two numbers.
    """
    shuffle_bytes = max(_GIB, input_bytes // 25_000)
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_MERGED_BYTES),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": str(-(-input_bytes // shuffle_bytes)),
        "spark.sql.files.maxPartitionBytes": str(_scan_bytes(input_bytes)),
    }


def staged_settings_for(input_bytes: int) -> dict[str, str]:
    """Session settings for reading back the clean Parquet table of ``input_bytes`` of raw JSON. It takes about a tenth of
    the bytes, so scan tasks as large as those of the JSON would hold ten times the rows."""
    return {"spark.sql.files.maxPartitionBytes": str(_scan_bytes(input_bytes) // 8)}


def _scan_bytes(input_bytes: int) -> int:
    return min(max(128 * _MIB, input_bytes // 100_000), _GIB)
