"""The batch job by day: only days of the lake that changed are read again.

Copies of an event have the same timestamp text, so they lie in one day, and what a day adds to the results can
be kept apart: its stage counts, its sums and counts by road type, zone, hour and congestion level, and its first
events for the sample. Re-read days replace their own partitions of these tables; KPI tables and sample are
then rolled up from the few rows of all days.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficlake.operators.enrich import enrich
from trafficlake.operators.kpis import kpi_cube, kpi_rollup
from trafficlake.operators.quality import survivors, tally, tally_report
from trafficlake.operators.serving import sample_events, sample_order, sample_part
from trafficlake.paths import exists, remove, stamp, total_bytes
from trafficlake.plans.batch import quality_row, require_apart, write_rollup
from trafficlake.schema import READING, SAMPLE_COLUMNS, SAMPLE_ROWS
from trafficlake.session import scratch_dir, session_settings, settings_for, staged_settings_for
from trafficlake.sinks.kpi import write_sample
from trafficlake.sources.raw import lake_days, read_day_folders

_COUNTS = ["rows_read", "rows_unreadable", "rows_in_range", "rows_unique"]
_SUM = "decimal(28,6)"
_TABLES = {
    "cube": "road_type string, zone string, hour int, congestion_status string, events bigint, "
    + f"vehicle_count_sum {_SUM}, average_speed_sum {_SUM}, occupancy_rate_sum {_SUM}, "
    + "vehicle_count_n bigint, average_speed_n bigint, occupancy_rate_n bigint, day string",
    "sample": "sensor_id bigint, timestamp string, zone string, road_type string, "
    + f"vehicle_count {READING.simpleString()}, average_speed {READING.simpleString()}, "
    + f"occupancy_rate {READING.simpleString()}, congestion_status string, present boolean, day string",
    "days": f"stamp string, sample_rows int, {', '.join(f'{c} bigint' for c in _COUNTS)}, day string",
}


class IncrementalResult(NamedTuple):
    quality: DataFrame
    """One row: rows read, unreadable, in range, unique, of all days."""
    days: list[str]
    """Days that were read."""
    gone: list[str]
    """Days that are no longer in the lake and were taken out."""


def _table(spark: SparkSession, partials: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{partials}/{name}")


def _replace(rows: DataFrame, partials: str, name: str, days: list[str], **marks: object) -> None:
    """Replace the partitions of ``days``. A row of its own for each day, which readers leave out, also replaces
    partitions for which there is nothing new."""
    spark = rows.sparkSession
    marker = spark.createDataFrame([(d,) for d in days], "day string").withColumns({k: F.lit(v) for k, v in marks.items()})
    complete = rows.unionByName(marker, allowMissingColumns=True)
    # A day has few rows: one file each.
    complete = complete.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    complete.partitionBy("day").parquet(f"{partials}/{name}")


def _day_sample(events: DataFrame, n: int) -> DataFrame:
    """The first ``n`` events of each day, cut in parts of the day first, as ``sample_events`` does."""
    rows = events.select("day", *SAMPLE_COLUMNS).withColumn("part", sample_part())
    for keys in (["day", "part"], ["day"]):
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*sample_order()))
        rows = rows.withColumn("number", number).where(F.col("number") <= n)
    return rows.drop("number", "part").withColumn("present", F.lit(True))


def changed_days(spark: SparkSession, raw: str, partials: str, sample_rows: int = SAMPLE_ROWS) -> tuple[dict[str, str], list[str]]:
    """Days whose files are not those of the last run, with the folders' present stamps, and days that are gone.

    A day's folder is summed up and its zone folders are listed, no file is. A file replaced by one of the same
    size at the same moment goes unnoticed; name such days to ``run_incremental``.
    """
    stamps = {day: stamp(spark, folder) for day, folder in lake_days(spark, raw).items()}
    # One row a day.
    rows = _table(spark, partials, "days").collect() if exists(spark, f"{partials}/days") else []
    known = {r["day"]: r["stamp"] for r in rows if r["sample_rows"] >= sample_rows}
    return {d: s for d, s in stamps.items() if known.get(d) != s}, sorted({r["day"] for r in rows} - stamps.keys())


def run_incremental(
    spark: SparkSession,
    raw: str,
    partials: str,
    analytics: str,
    sample: str,
    days: list[str] | None = None,
    sample_rows: int = SAMPLE_ROWS,
    versions: bool = False,
) -> IncrementalResult:
    """Bring KPI tables and sample up to date with the lake ``raw``, as ``run_batch`` over all of it would.

    Only changed days are read, those that came among them, or exactly the ``days`` named (``yyyy-MM-dd``, or
    ``undated``); days that left the lake are taken out. ``partials`` keeps what each day adds and belongs to
    one lake; losing it costs one full run. A day counts as done when its row of the table of days is written,
    last of all, so a run that fails is made good by the next. One run at a time.
    """
    require_apart(spark, raw=raw, partials=partials, analytics=analytics, sample=sample)
    if exists(spark, f"{raw.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{raw} is kept by a file log, which names files, not days; copy its days to a new root first")
    folders = lake_days(spark, raw)
    stamps, gone = changed_days(spark, raw, partials, sample_rows)
    if days is not None:
        if unknown := sorted(set(days) - folders.keys()):
            raise ValueError(f"no such days in {raw}: {unknown}")
        stamps = {d: stamp(spark, folders[d]) for d in days}
    scratch = scratch_dir(spark, "incremental")
    try:
        if stamps:
            _read_days(spark, raw, partials, {d: folders[d] for d in stamps}, stamps, sample_rows, scratch)
        for day in gone:
            for name in _TABLES:
                remove(spark, f"{partials}/{name}/day={day}")
        quality = _roll_up(spark, partials, analytics, sample, sample_rows, scratch, versions)
    finally:
        remove(spark, scratch)
    return IncrementalResult(quality_row(spark, quality), sorted(stamps), gone)


def _read_days(
    spark: SparkSession, raw: str, partials: str, folders: dict[str, str], stamps: dict[str, str], sample_rows: int, scratch: str
) -> None:
    size = sum(total_bytes(spark, folder) for folder in folders.values())
    with session_settings(spark, settings_for(size)):
        # Written, not cached; each day has one row more, for all that was not kept.
        enrich(tally(read_day_folders(spark, raw, list(folders.values())), by=["day"])).write.parquet(f"{scratch}/clean")
        with session_settings(spark, staged_settings_for(size)):
            tallied = spark.read.parquet(f"{scratch}/clean")
            events = survivors(tallied)
            days = list(folders)
            _replace(kpi_cube(events, by=["day"]), partials, "cube", days, events=0)
            _replace(_day_sample(events, sample_rows), partials, "sample", days, present=False)
            stamped = spark.createDataFrame(list(stamps.items()), "day string, stamp string")
            counts = stamped.join(tally_report(tallied, by=["day"]), "day", "left").fillna(0, _COUNTS)
            _replace(counts.withColumn("sample_rows", F.lit(sample_rows)), partials, "days", [])


def _roll_up(
    spark: SparkSession, partials: str, analytics: str, sample: str, sample_rows: int, scratch: str, versions: bool
) -> dict[str, int]:
    if not exists(spark, f"{partials}/days"):
        raise FileNotFoundError("the lake has no days yet")
    write_rollup(kpi_rollup(_table(spark, partials, "cube").where("events > 0")), analytics, f"{scratch}/kpi_all", versions)
    write_sample(sample_events(_table(spark, partials, "sample").where("present"), sample_rows), sample)
    totals = _table(spark, partials, "days").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS])
    return totals.first().asDict()
