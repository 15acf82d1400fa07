"""Sets of tables that replace each other at once.

A version is a folder below ``<base>/_versions``. It is written under a hidden name and appears, whole, by one
rename; the one published last is current. A reader that has looked it up goes on reading it while the next one
is published, and old versions go when they have been out of date for a while. The names begin with an
underscore, so whoever lists ``<base>`` itself does not see them.
"""

import time
import uuid

from pyspark.sql import SparkSession

from trafficlake.paths import move, names, remove

#: For so long a version stays after the next one has come.
GRACE_SECONDS = 3600.0
_FOLDER = "_versions"


def _published(spark: SparkSession, base: str) -> list[str]:
    """Names of complete versions, oldest first; they begin with the time of publication."""
    return [name for name in names(spark, f"{base}/{_FOLDER}") if name[:1].isdigit()]


def new_version(base: str) -> str:
    """A hidden folder to write the next version to."""
    return f"{base}/{_FOLDER}/.next-{uuid.uuid4().hex}"


def publish(spark: SparkSession, base: str, folder: str, grace: float = GRACE_SECONDS) -> str:
    """Make a folder of ``new_version`` the current one; returns its name for good.

    Versions that were replaced more than ``grace`` seconds ago are removed.
    """
    before = _published(spark, base)
    now = max(int(time.time() * 1000), _time(before[-1]) + 1 if before else 0)
    target = f"{base}/{_FOLDER}/{now:015d}-{uuid.uuid4().hex[:8]}"
    move(spark, folder, target)
    for old, replaced in zip(before, [*map(_time, before[1:]), now]):
        if replaced + grace * 1000 <= now:
            remove(spark, f"{base}/{_FOLDER}/{old}")
    return target


def _time(name: str) -> int:
    return int(name.partition("-")[0])


def current(spark: SparkSession, base: str) -> str:
    """The folder of the current version, ``base`` itself if none was ever published there."""
    published = _published(spark, base)
    return f"{base}/{_FOLDER}/{published[-1]}" if published else base
