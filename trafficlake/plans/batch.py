"""The batch job: raw events -> clean events -> KPI tables and a sample."""

from itertools import combinations
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession

from trafficlake.operators.enrich import enrich
from trafficlake.operators.kpis import kpi_all, pick_kpi
from trafficlake.operators.quality import clean, dedup, observed_survivors, tally
from trafficlake.operators.serving import sample_events
from trafficlake.paths import overlap, remove, total_bytes
from trafficlake.schema import KPI_NAMES, KPI_PARTITIONING, SAMPLE_ROWS
from trafficlake.session import scratch_dir, session_settings, settings_for, staged_settings_for
from trafficlake.sinks.kpi import write_kpi, write_sample
from trafficlake.sources.raw import day_folders, read_raw_checked, read_raw_days
from trafficlake.versions import new_version, publish


class BatchResult(NamedTuple):
    quality: DataFrame
    """One row: rows read, unreadable, in range, unique."""
    clean_path: str | None
    """Clean, unique, enriched events as Parquet (see ``clean_events``), if kept."""


def traffic_clean(raw: DataFrame) -> DataFrame:
    """Clean, unique and enriched events, lazily."""
    return enrich(dedup(clean(raw)))


def clean_events(spark: SparkSession, clean_path: str) -> DataFrame:
    return spark.read.parquet(clean_path)


def write_kpis(events: DataFrame, analytics: str, staging: str, versions: bool = False) -> None:
    """All KPI tables from one pass over the events.

    The few aggregated rows are written to ``staging`` first; each table is picked from there. With ``versions`` the
    four tables appear at once, as a version of ``analytics``, and readers never meet half of them.
    """
    write_rollup(kpi_all(events), analytics, staging, versions)


def write_rollup(all_kpis: DataFrame, analytics: str, staging: str, versions: bool = False) -> None:
    all_kpis.write.mode("overwrite").parquet(staging)
    spark = all_kpis.sparkSession
    aggregated = spark.read.parquet(staging)
    target = new_version(analytics) if versions else analytics
    for name in KPI_NAMES:
        write_kpi(pick_kpi(aggregated, name), target, name, KPI_PARTITIONING.get(name))
    if versions:
        publish(spark, analytics, target)


def require_apart(spark: SparkSession, **paths: str) -> None:
    """Outputs replace whole folders, so none may contain or lie in another folder."""
    for (a, first), (b, second) in combinations(paths.items(), 2):
        if overlap(spark, first, second):
            raise ValueError(f"{a} ({first}) and {b} ({second}) overlap")


def run_batch(
    spark: SparkSession,
    raw: str,
    analytics: str,
    sample: str,
    clean_path: str | None = None,
    start: str | None = None,
    end: str | None = None,
    sample_rows: int = SAMPLE_ROWS,
    input_bytes: int | None = None,
    versions: bool = False,
) -> BatchResult:
    """Read the raw lake once, shuffle it once, write the KPI tables and the CSV sample.

    With ``start`` or ``end`` (``yyyy-MM-dd``, inclusive) ``raw`` is the root of a lake and only files of
    those days are listed and read; else it is a folder or pattern, read whole.

    The clean events are written as a Parquet table instead of being cached: an executor that
    disappears then costs no second parse of the raw JSON, and KPIs and sample read only the
    columns they need. Name a ``clean_path`` to keep the table, which each run replaces. Everything else
    that is staged lies below the session's checkpoint folder and is removed at the end, also of a failed
    run. Shuffle and scan are sized by the input (``input_bytes``, by default as the file system tells, of
    the chosen days only) for the time of the job. ``versions`` publishes the KPI tables as a version (see
    ``write_kpis``); the sample is replaced in any case.
    """
    scratch = scratch_dir(spark, "batch")
    staged = clean_path or f"{scratch}/clean"
    require_apart(spark, raw=raw, analytics=analytics, sample=sample, clean_path=staged)
    size = _input_bytes(spark, raw, start, end) if input_bytes is None else input_bytes
    try:
        with session_settings(spark, settings_for(size)):
            if start or end:
                events = read_raw_days(spark, raw, start, end, checked=True)
            else:
                events = read_raw_checked(spark, raw)
            counts = Observation("stage counts")
            observed_survivors(enrich(tally(events)), counts).write.mode("overwrite").parquet(staged)
            quality = counts.get
            with session_settings(spark, staged_settings_for(size)):
                clean_rows = clean_events(spark, staged)
                write_kpis(clean_rows, analytics, f"{scratch}/kpi_all", versions)
                write_sample(sample_events(clean_rows, sample_rows), sample)
    finally:
        remove(spark, scratch)
    return BatchResult(quality_row(spark, quality), clean_path)


def quality_row(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    names = ["rows_read", "rows_unreadable", "rows_in_range", "rows_unique"]
    return spark.createDataFrame([[counts[n] for n in names]], ", ".join(f"{n} bigint" for n in names))


def _input_bytes(spark: SparkSession, raw: str, start: str | None, end: str | None) -> int:
    """Size of the input: of the chosen days' folders, or of all ``raw`` stands for."""
    if start or end:
        return sum(total_bytes(spark, folder) for folder in day_folders(spark, raw, start, end))
    return total_bytes(spark, raw)
