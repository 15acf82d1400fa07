"""Every operator as a query over the supplied tables.

Queries about files write to a new scratch folder first and return what is read back.
"""

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.fixtures import traffic_from_events, traffic_hard
from trafficlake.operators import enrich as en
from trafficlake.operators import kpis, quality, serving, upkeep
from trafficlake.paths import write_text
from trafficlake.plans.batch import run_batch, traffic_clean, write_kpis
from trafficlake.plans.incremental import run_incremental
from trafficlake.schema import (
    EVENT_COLUMNS,
    EVENT_SCHEMA,
    KPI_PARTITIONING,
    METRICS,
    PARTITION_KEYS,
    SAMPLE_COLUMNS,
)
from trafficlake.session import scratch_dir, session_settings, use_utc, workers_find_package
from trafficlake.sinks.kpi import write_kpi, write_sample
from trafficlake.sinks.raw import write_raw
from trafficlake.sources import codec
from trafficlake.sources.kpi import check_files, read_kpi
from trafficlake.sources.raw import read_lake, read_raw, read_raw_checked, read_raw_days
from trafficlake.sources.topic import read_file_stream
from trafficlake.streaming.dedup import dedup_stream
from trafficlake.streaming.ingest import ingest_stream
from trafficlake.streaming.late import STATE_STORE, dedup_stream_tagged

Query = Callable[[SparkSession, str], DataFrame]
Source = Callable[..., DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters the SQL of the same key repeats.
DAY_RANGE = ("2024-01-10", "2024-01-16")
RETENTION_AS_OF = datetime.date(2024, 1, 31)
METRIC_REQUEST = [METRICS[3], METRICS[0], "traffic.none", METRICS[1], METRICS[2], METRICS[0]]
# Label, count and mean column of each KPI table.
KPI_ROWS = {
    "kpi_road_type": ("road_type", "total_events", "avg_speed"),
    "kpi_zone": ("zone", "total_events", "avg_occupancy"),
    "kpi_hourly": ("hour", "total_vehicles_counted", "avg_vehicles_per_sensor"),
    "kpi_congestion": ("congestion_status", "count", None),
}

# Queries that run over the harder events as well.
HARD = [
    "clean_events",
    "dedup_events",
    "congestion_status",
    "quality_report",
    "partition_keys",
    "kpi_road_type",
    "kpi_zone",
    "kpi_hourly",
    "kpi_congestion",
    "kpi_all",
    "view_zones",
    "view_congestion_top5",
    "view_speed",
    "view_trends",
    "metric_series",
    "batch_job",
    "batch_job_incremental",
    "kpi_zone_roundtrip",
]


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str, *source: Source) -> DataFrame:
        return _plain_readings(fn(workers_find_package(use_utc(spark)), sf_dir, *source))

    QUERIES[fn.__name__] = run
    if fn.__name__ in HARD:
        QUERIES[f"{fn.__name__}_hard"] = lambda spark, sf_dir: run(spark, sf_dir, traffic_hard)
    return fn


def _plain_readings(df: DataFrame) -> DataFrame:
    """Decimal readings as doubles, which SQL engines show alike."""
    return df.withColumns({c: F.col(c).cast("double") for c, kind in df.dtypes if kind.startswith("decimal")})


def _clean(spark: SparkSession, sf_dir: str, source: Source) -> DataFrame:
    return traffic_clean(source(spark, sf_dir))


def _plain_ts(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp_parsed", F.col("timestamp_parsed").cast("timestamp_ntz"))


# --- filters, dedup, scalar expressions --------------------------------------------------------


@query
def clean_events(spark, sf_dir, source=traffic_from_events):
    return quality.clean(source(spark, sf_dir))


@query
def dedup_events(spark, sf_dir, source=traffic_from_events):
    return quality.dedup(quality.clean(source(spark, sf_dir)))


@query
def congestion_status(spark, sf_dir, source=traffic_from_events):
    return en.with_congestion(source(spark, sf_dir))


@query
def parsed_timestamp(spark, sf_dir, source=traffic_from_events):
    events = source(spark, sf_dir).select("sensor_id", "timestamp")
    return _plain_ts(en.with_parsed_ts(events))


@query
def sample_events(spark, sf_dir, source=traffic_from_events):
    return serving.sample_events(_clean(spark, sf_dir, source))


@query
def quality_report(spark, sf_dir, source=traffic_from_events):
    return quality.quality_report(source(spark, sf_dir))


@query
def traffic_profile(spark, sf_dir, source=traffic_from_events):
    return _plain_ts(en.with_traffic_profile(_clean(spark, sf_dir, source)))


@query
def incident_flag(spark, sf_dir, source=traffic_from_events):
    return _plain_ts(en.with_incident_flag(_clean(spark, sf_dir, source)))


@query
def partition_keys(spark, sf_dir, source=traffic_from_events):
    return en.with_partition_keys(source(spark, sf_dir))


# --- aggregations ------------------------------------------------------------------------------


@query
def kpi_road_type(spark, sf_dir, source=traffic_from_events):
    return kpis.kpi_road_type(_clean(spark, sf_dir, source))


@query
def kpi_zone(spark, sf_dir, source=traffic_from_events):
    return kpis.kpi_zone(_clean(spark, sf_dir, source))


@query
def kpi_hourly(spark, sf_dir, source=traffic_from_events):
    return kpis.kpi_hourly(_clean(spark, sf_dir, source))


@query
def kpi_hourly_volume(spark, sf_dir, source=traffic_from_events):
    return kpis.kpi_hourly_volume(_clean(spark, sf_dir, source))


@query
def kpi_congestion(spark, sf_dir, source=traffic_from_events):
    return kpis.kpi_congestion(_clean(spark, sf_dir, source))


@query
def kpi_all(spark, sf_dir, source=traffic_from_events):
    return kpis.kpi_all(_clean(spark, sf_dir, source))


# --- serving views -----------------------------------------------------------------------------


@query
def view_zones(spark, sf_dir, source=traffic_from_events):
    return serving.view_zones(kpis.kpi_zone(_clean(spark, sf_dir, source)))


@query
def view_congestion_top5(spark, sf_dir, source=traffic_from_events):
    return serving.view_congestion(kpis.kpi_zone(_clean(spark, sf_dir, source)))


@query
def view_speed(spark, sf_dir, source=traffic_from_events):
    return serving.view_speed(kpis.kpi_road_type(_clean(spark, sf_dir, source)))


@query
def view_trends(spark, sf_dir, source=traffic_from_events):
    return serving.view_trends(kpis.kpi_hourly(_clean(spark, sf_dir, source)))


def _kpi_base(spark: SparkSession, sf_dir: str, source: Source) -> str:
    scratch = scratch_dir(spark, "kpis")
    write_kpis(_clean(spark, sf_dir, source), f"{scratch}/analytics", f"{scratch}/kpi_all")
    return f"{scratch}/analytics"


@query
def metric_catalogue(spark, sf_dir, source=traffic_from_events):
    return serving.metric_catalogue(spark, _kpi_base(spark, sf_dir, source))


@query
def metric_series(spark, sf_dir, source=traffic_from_events):
    return serving.query_metrics(spark, _kpi_base(spark, sf_dir, source), METRIC_REQUEST)


@query
def metric_datapoints(spark, sf_dir, source=traffic_from_events):
    """The nested answer, its points spelled out as text so that SQL can be compared."""
    answers = serving.metric_datapoints(serving.query_metrics(spark, _kpi_base(spark, sf_dir, source), METRIC_REQUEST))
    as_text = F.transform(
        "datapoints", lambda p: F.concat_ws("=", p["label"], p["value"].cast("decimal(20,2)").cast("string"))
    )
    return answers.select(
        "request_pos", "target", F.size("datapoints").alias("n_points"), F.array_join(as_text, ";").alias("points")
    )


# --- raw lake, messages and streams ------------------------------------------------------------


def _raw_lake(spark: SparkSession, sf_dir: str, source: Source) -> str:
    lake = scratch_dir(spark, "raw")
    write_raw(source(spark, sf_dir), lake)
    return lake


def _messages(spark: SparkSession, sf_dir: str, source: Source) -> DataFrame:
    """All events as messages; five of every fifty are broken, each in its own way."""
    event = F.to_json(F.struct(*EVENT_COLUMNS))
    number, pick = F.col("event_id").cast("string"), F.col("event_id") % 50
    value = (
        F.when(pick == 0, F.concat(F.lit('{"sensor_id":'), number))
        .when(pick == 10, F.concat(F.lit('{"sensor_id":'), number, F.lit(',"vehicle_count":"x"}')))
        .when(pick == 20, F.concat(F.lit('{"sensor_id":'), number, F.lit(',"zone":"Centre-Ville"}')))
        .when(pick == 30, F.concat(F.lit('{"timestamp":"day '), number, F.lit('","zone":"Centre-Ville"}')))
        .when(pick == 40, F.concat(F.lit('{"timestamp":"2024-01-01T00:00:00+00:00","sensor_id":'), number, F.lit("}")))
        .otherwise(event)
    )
    return source(spark, sf_dir, "event_id").select(value.alias("value"))


@query
def raw_jsonl_scan(spark, sf_dir, source=traffic_from_events):
    return read_raw(spark, f"{_raw_lake(spark, sf_dir, source)}/*/*/*/*/*.json")


@query
def raw_day_range(spark, sf_dir, source=traffic_from_events):
    return read_raw_days(spark, _raw_lake(spark, sf_dir, source), *DAY_RANGE)


@query
def decode_events(spark, sf_dir, source=traffic_from_events):
    return codec.decode_events(_messages(spark, sf_dir, source))


@query
def quarantine(spark, sf_dir, source=traffic_from_events):
    return codec.quarantine(_messages(spark, sf_dir, source))


@query
def encode_decode_roundtrip(spark, sf_dir, source=traffic_from_events):
    return codec.decode_events(codec.encode_events(source(spark, sf_dir)))


@query
def stream_ingest(spark, sf_dir, source=traffic_from_events):
    scratch = scratch_dir(spark, "stream")
    _messages(spark, sf_dir, source).write.text(f"{scratch}/messages")
    stream = ingest_stream(
        read_file_stream(spark, f"{scratch}/messages", max_files=100),
        f"{scratch}/raw",
        f"{scratch}/checkpoint",
        trigger={"availableNow": True},
    )
    stream.awaitTermination()
    return read_lake(spark, f"{scratch}/raw")


@query
def stream_dedup(spark, sf_dir, source=traffic_from_events):
    """Keys of the stream's unique events. Which copy arrives first is chance, so only those."""
    scratch = scratch_dir(spark, "stream")
    _messages(spark, sf_dir, source).write.text(f"{scratch}/messages")
    events = codec.storable_events(read_file_stream(spark, f"{scratch}/messages"))
    unique = dedup_stream(events, delay="90 days").writeStream.format("parquet").outputMode("append")
    unique = unique.option("checkpointLocation", f"{scratch}/checkpoint").trigger(availableNow=True)
    unique.start(f"{scratch}/unique").awaitTermination()
    return spark.read.parquet(f"{scratch}/unique").select("sensor_id", "timestamp")


@query
def stream_dedup_late(spark, sf_dir, source=traffic_from_events):
    """Keys of a stream in three micro-batches with ``late``. Every seventh minute is held back to the last."""
    scratch = scratch_dir(spark, "stream")
    events = source(spark, sf_dir)
    held = F.substring("timestamp", 15, 2).cast("int") % 7 == 0
    early = F.col("timestamp") < "2024-01-20"
    for number, rows in enumerate((~held & early, ~held & ~early, held)):
        # One file, so one micro-batch, each.
        codec.encode_events(events.where(rows)).select("value").coalesce(1).write.text(f"{scratch}/messages/{number}")
    messages = read_file_stream(spark, f"{scratch}/messages/*", max_files=1)
    with session_settings(spark, STATE_STORE):
        tagged = dedup_stream_tagged(codec.storable_events(messages), "1 hour").writeStream.format("parquet")
        tagged = tagged.option("checkpointLocation", f"{scratch}/checkpoint").trigger(availableNow=True)
        tagged.start(f"{scratch}/unique").awaitTermination()
    return spark.read.parquet(f"{scratch}/unique").select("sensor_id", "timestamp", "late")


# --- KPI files ---------------------------------------------------------------------------------


def _kpi_roundtrip(spark: SparkSession, sf_dir: str, name: str, kpi: DataFrame) -> DataFrame:
    base = scratch_dir(spark, "kpi")
    write_kpi(kpi, base, name, KPI_PARTITIONING.get(name))
    return read_kpi(spark, base, name)


@query
def kpi_road_roundtrip(spark, sf_dir, source=traffic_from_events):
    return _kpi_roundtrip(spark, sf_dir, "kpi_road_type", kpis.kpi_road_type(_clean(spark, sf_dir, source)))


@query
def kpi_zone_roundtrip(spark, sf_dir, source=traffic_from_events):
    return _kpi_roundtrip(spark, sf_dir, "kpi_zone", kpis.kpi_zone(_clean(spark, sf_dir, source)))


@query
def sample_csv_roundtrip(spark, sf_dir, source=traffic_from_events):
    path = f"{scratch_dir(spark, 'sample')}/csv"
    write_sample(serving.sample_events(_clean(spark, sf_dir, source)), path)
    types = {f.name: f.dataType.simpleString() for f in EVENT_SCHEMA}
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in SAMPLE_COLUMNS)
    return spark.read.schema(schema).option("header", True).csv(path)


# --- the whole job and upkeep ------------------------------------------------------------------


@query
def batch_job(spark, sf_dir, source=traffic_from_events):
    """Raw JSON files to written KPI tables; returns the rows of all four, read back."""
    scratch = scratch_dir(spark, "job")
    write_raw(source(spark, sf_dir), f"{scratch}/raw")
    run_batch(spark, f"{scratch}/raw", f"{scratch}/analytics", f"{scratch}/sample")
    return _kpi_rows(spark, f"{scratch}/analytics")


def _kpi_rows(spark: SparkSession, analytics: str) -> DataFrame:
    tables = {name: read_kpi(spark, analytics, name) for name in KPI_ROWS}
    rows = [
        tables[name].select(
            F.lit(name).alias("kpi"),
            F.col(label).cast("string").alias("label"),
            F.col(count).alias("n"),
            (F.col(mean) if mean else F.lit(None).cast("double")).alias("mean"),
        )
        for name, (label, count, mean) in KPI_ROWS.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query
def batch_job_incremental(spark, sf_dir, source=traffic_from_events):
    """KPI tables after a first run over most events and a second over the two days that got the rest; a third finds
    nothing to do."""
    scratch = scratch_dir(spark, "job")
    places = [f"{scratch}/{name}" for name in ("raw", "partials", "analytics", "sample")]
    keyed = en.with_partition_keys(source(spark, sf_dir, "event_id"))
    late = F.concat_ws("-", "year", "month", "day").isin(*DAY_RANGE) & (F.col("event_id") % 3 > 0)
    write_raw(keyed.where(~late), places[0])
    run_incremental(spark, *places)
    write_raw(keyed.where(late), places[0])
    for days in (list(DAY_RANGE), []):
        if run_incremental(spark, *places).days != days:
            raise AssertionError(f"other days than {days} were read")
    return _kpi_rows(spark, places[2])


@query
def incremental_quality(spark, sf_dir, source=traffic_hard):
    """Stage counts added up over days, lines that cannot be read among them."""
    scratch = scratch_dir(spark, "job")
    keyed = en.with_partition_keys(source(spark, sf_dir, "event_id"))
    # By directory, as write_raw does it; the lines, longer than the columns, are made behind the shuffle.
    balanced = keyed.hint("rebalance", *[F.col(k) for k in PARTITION_KEYS])
    lines = balanced.select(_line_or_broken().alias("value"), *PARTITION_KEYS)
    lines.write.partitionBy(*PARTITION_KEYS).text(f"{scratch}/raw")
    return run_incremental(spark, *[f"{scratch}/{name}" for name in ("raw", "partials", "analytics", "sample")]).quality


def _line_or_broken() -> F.Column:
    event = F.to_json(F.struct(*codec.written_readings()))
    return F.when(F.col("event_id") % 50 == 1, F.lit('{"sensor_id":1,')).otherwise(event)


@query
def kpi_versions(spark, sf_dir, source=traffic_from_events):
    """Zones of two versions of the KPI tables: the first is read on after the second has replaced it."""
    base = scratch_dir(spark, "versions")
    events = source(spark, sf_dir, "event_id")
    write_kpis(traffic_clean(events.where("event_id % 2 = 0")), base, f"{base}-staging", versions=True)
    first = read_kpi(spark, base, "kpi_zone").withColumn("version", F.lit(1))
    write_kpis(traffic_clean(events), base, f"{base}-staging", versions=True)
    second = read_kpi(spark, base, "kpi_zone").withColumn("version", F.lit(2))
    return first.unionByName(second)


@query
def kpi_damaged_files(spark, sf_dir, source=traffic_from_events):
    """Rows and damaged files by directory of a KPI table to which two files that are no Parquet have been added."""
    base = scratch_dir(spark, "kpi")
    write_kpi(kpis.kpi_zone(_clean(spark, sf_dir, source)), base, "kpi_zone", ["zone"])
    for name, content in (("part-1.parquet", "PAR1 cut off"), ("part-2.parquet", "no Parquet")):
        write_text(spark, f"{base}/kpi_zone/zone=Broken/{name}", content)
    zone = F.regexp_extract(F.url_decode(F.col("path")), "zone=([^/]*)/", 1).alias("zone")
    damaged = F.count("error").alias("n_damaged")
    return check_files(spark, base, "kpi_zone").groupBy(zone).agg(F.sum("n_rows").alias("n_rows"), damaged)


@query
def validate_outputs(spark, sf_dir, source=traffic_from_events):
    checked = upkeep.validate_outputs(spark, _kpi_base(spark, sf_dir, source))
    return checked.select("folder", (F.col("n_files") > 0).alias("has_files"), "status")


@query
def retention_expired(spark, sf_dir, source=traffic_from_events):
    archived = upkeep.archive(spark, _raw_lake(spark, sf_dir, source), scratch_dir(spark, "archive"), RETENTION_AS_OF)
    return read_lake(spark, archived)


# --- messages and lines as they come -----------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str, source: Source) -> DataFrame:
    """All events as lines: every tenth with a field the library does not know and a speed with decimals,
    every fiftieth broken, every fiftieth with a count that is no number."""
    event = F.to_json(F.struct(*codec.written_readings()))
    pick = F.col("event_id") % 50
    extra = F.concat(F.lit('{"lane":'), pick.cast("string"), F.lit(","), F.substring(event, 2, 10_000))
    value = (
        F.when(pick == 1, F.lit('{"sensor_id":1,"lane":2'))
        .when(pick == 2, F.regexp_replace(event, r'"zone"', '"vehicle_count":"many","zone"'))
        .when(pick % 10 == 0, extra)
        .otherwise(event)
    )
    return source(spark, sf_dir, "event_id").select(value.alias("value"), "timestamp")


@query
def quality_mixed(spark, sf_dir, source=traffic_hard):
    """Counts over lines of which some cannot be read."""
    folder = f"{scratch_dir(spark, 'mixed')}/lines"
    _lines(spark, sf_dir, source).select("value").write.text(folder)
    return quality.quality_report(read_raw_checked(spark, folder))


@query
def raw_extra_fields(spark, sf_dir, source=traffic_from_events):
    """Events with fields that the library does not know, read with the rest in one parse."""
    folder = f"{scratch_dir(spark, 'extra')}/lines"
    event = F.to_json(F.struct(*codec.written_readings()))
    number, pick = F.col("event_id").cast("string"), F.col("event_id") % 10
    tail = F.substring(event, 2, 10_000)
    value = (
        F.when(pick == 0, F.concat(F.lit('{"lane":'), number, F.lit(',"weather":{"sky":"gris","wind":2.5},'), tail))
        .when(pick == 1, F.concat(F.lit('{"lane":null,"sensor_id":"x'), number, F.lit('","zone":7,"average_speed":40.5}')))
        .when(pick == 2, F.concat(F.lit('{"lane":'), number))
        .otherwise(event)
    )
    source(spark, sf_dir, "event_id").select(value.alias("value")).write.text(folder)
    events = read_raw(spark, folder, extra=True)
    return events.select(
        *EVENT_COLUMNS,
        F.size(F.map_keys("extra")).alias("n_extra"),
        F.try_variant_get(F.col("extra")["lane"], "$", "bigint").alias("lane"),
        F.try_variant_get(F.col("extra")["weather"], "$.sky", "string").alias("sky"),
        F.try_variant_get(F.col("extra")["weather"], "$.wind", "double").alias("wind"),
    )


@query
def stream_ingest_quarantine(spark, sf_dir, source=traffic_from_events):
    """Lake and quarantine of one query: every message, and where it went."""
    scratch = scratch_dir(spark, "stream")
    _messages(spark, sf_dir, source).write.text(f"{scratch}/messages")
    messages = read_file_stream(spark, f"{scratch}/messages", max_bytes=1_000_000)
    places = (f"{scratch}/raw", f"{scratch}/checkpoint", {"availableNow": True})
    ingest_stream(messages, *places, quarantine=f"{scratch}/aside").awaitTermination()
    stored = read_lake(spark, f"{scratch}/raw").select(
        "sensor_id", "timestamp", *PARTITION_KEYS, F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("reason")
    )
    aside = spark.read.schema("value string, reason string").json(f"{scratch}/aside")
    return stored.unionByName(aside, allowMissingColumns=True)


@query
def stream_ingest_extra(spark, sf_dir, source=traffic_from_events):
    """The unknown field of every tenth message, read from the lake that the stream wrote."""
    scratch = scratch_dir(spark, "stream")
    _lines(spark, sf_dir, source).select("value").write.text(f"{scratch}/messages")
    messages = read_file_stream(spark, f"{scratch}/messages", max_files=100)
    stream = ingest_stream(messages, f"{scratch}/raw", f"{scratch}/checkpoint", {"availableNow": True}, writers=4)
    stream.awaitTermination()
    lane = F.get_json_object("value", "$.lane").cast("bigint").alias("lane")
    lines = spark.read.schema("value string, year string, month string, day string, zone_key string")
    return lines.text(f"{scratch}/raw").where(lane.isNotNull()).select(lane, "year", "month", "day", "zone_key")


@query
def archive_bytes(spark, sf_dir, source=traffic_from_events):
    """Lines of the expired days after archiving, byte for byte, with their directories."""
    scratch = scratch_dir(spark, "archive")
    number = F.col("event_id").cast("string")
    value = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"sensor_id":'), number, F.lit(',"lane":3,"average_speed":40.50}')))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit("{broken "), number))
        .otherwise(F.concat(F.lit("  é "), number))
    )
    keyed = en.with_partition_keys(source(spark, sf_dir, "event_id")).select(value.alias("value"), *PARTITION_KEYS)
    keyed.write.partitionBy(*PARTITION_KEYS).text(f"{scratch}/raw")
    archived = upkeep.archive(spark, f"{scratch}/raw", f"{scratch}/old", RETENTION_AS_OF)
    return spark.read.schema("value string, year string, month string, day string, zone_key string").text(archived)


@query
def batch_job_days(spark, sf_dir, source=traffic_from_events):
    """Zones of the batch job over a range of days."""
    scratch = scratch_dir(spark, "job")
    write_raw(source(spark, sf_dir), f"{scratch}/raw")
    start, end = DAY_RANGE
    run_batch(spark, f"{scratch}/raw", f"{scratch}/analytics", f"{scratch}/sample", start=start, end=end)
    return read_kpi(spark, f"{scratch}/analytics", "kpi_zone")
