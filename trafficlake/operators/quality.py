"""Cleaning, deduplication and row counts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trafficlake.schema import EVENT_COLUMNS, EVENT_KEY, EVENT_PAYLOAD


def in_range() -> Column:
    """Plausible readings; NULL (hence not kept) when speed or occupancy is missing."""
    return (F.col("average_speed") >= 0) & F.col("occupancy_rate").between(0, 100)


def clean(df: DataFrame) -> DataFrame:
    return df.where(in_range())


def dedup(df: DataFrame) -> DataFrame:
    """One row per (sensor_id, timestamp text); NULL keys count as equal.

    The survivor is the smallest payload, so that a recomputed task cannot pick another one. It
    is an aggregate with partial results: copies collapse before the shuffle, and a key holding
    a large share of all rows sends one row per map task.
    """
    survivor = F.min(F.struct(*EVENT_PAYLOAD)).alias("survivor")
    return df.groupBy(*EVENT_KEY).agg(survivor).select(*EVENT_KEY, "survivor.*").select(*EVENT_COLUMNS)


def tally(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``dedup(clean(df))`` with row counts, in the same single shuffle.

    Adds ``kept``, ``n_read`` (rows with that key) and ``n_unreadable`` (those that ``df.unreadable`` marks, where
    ``df`` has that column; they are never kept). The range is checked before the shuffle: all rows that fail share
    one key of NULLs with ``kept = false``, so each map task sends them as one row that only counts. The counts
    travel with the data, hence a map task that runs again counts once.

    ``by`` names columns to keep apart and to keep in the result.
    """
    unreadable = F.col("unreadable") if "unreadable" in df.columns else F.lit(False)
    rows = df.withColumn("kept", F.coalesce(in_range() & ~unreadable, F.lit(False)))
    keys = [F.when(F.col("kept"), F.col(c)).alias(c) for c in EVENT_KEY]
    survivor = F.min(F.when(F.col("kept"), F.struct(*EVENT_PAYLOAD))).alias("survivor")
    counts = [F.count(F.lit(1)).alias("n_read"), F.count_if(unreadable).alias("n_unreadable")]
    tallied = rows.groupBy(*by, "kept", *keys).agg(survivor, *counts)
    return tallied.select(*by, *EVENT_KEY, "survivor.*", "kept", "n_read", "n_unreadable")


def survivors(tallied: DataFrame) -> DataFrame:
    return tallied.where("kept").drop("kept", "n_read", "n_unreadable")


def _counts() -> list[Column]:
    return [
        F.coalesce(F.sum("n_read"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum("n_unreadable"), F.lit(0)).alias("rows_unreadable"),
        F.coalesce(F.sum(F.when(F.col("kept"), F.col("n_read"))), F.lit(0)).alias("rows_in_range"),
        F.count_if("kept").alias("rows_unique"),
    ]


def tally_report(tallied: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows read, rows unreadable, rows in range, rows after deduplication: one row, or one for each of ``by``."""
    return tallied.groupBy(*by).agg(*_counts())


def observed_survivors(tallied: DataFrame, observation: Observation) -> DataFrame:
    """``survivors``; the observation gets the values of ``tally_report`` when they are written.

    It watches the last stage of the job, behind the shuffle. Spark takes what a task of the last stage observed
    once for each partition, also where a task ran twice.
    """
    return survivors(tallied.observe(observation, *_counts()))


def quality_report(df: DataFrame) -> DataFrame:
    """Counts of the cleaning stages from one scan. The unused survivor column is pruned, which
    leaves a hash aggregate over the key and the counters."""
    return tally_report(tally(df))
