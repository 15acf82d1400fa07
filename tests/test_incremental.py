"""The job by day against the job over everything."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trafficlake.fixtures import traffic_hard
from trafficlake.operators.enrich import with_partition_keys
from trafficlake.paths import stamp
from trafficlake.plans import incremental, queries
from trafficlake.plans.batch import run_batch
from trafficlake.plans.incremental import changed_days, run_incremental
from trafficlake.schema import KPI_NAMES, PARTITION_KEYS, READINGS
from trafficlake.sinks.raw import write_raw
from trafficlake.sources.kpi import read_kpi
from trafficlake.sources.raw import UNDATED, lake_days

SMALL = "/root/testdata/sf0.001"
TWO_DAYS = ["2024-01-10", "2024-01-16"]


class Job:
    def __init__(self, spark, root: Path):
        self.spark, self.root = spark, root
        self.raw, self.partials, self.analytics, self.sample = (str(root / n) for n in ("raw", "partials", "analytics", "sample"))

    def run(self, **options):
        return run_incremental(self.spark, self.raw, self.partials, self.analytics, self.sample, **options)

    def results(self, analytics, sample):
        tables = {name: sorted(map(str, read_kpi(self.spark, analytics, name).collect())) for name in KPI_NAMES}
        return tables, sorted(map(str, self.spark.read.option("header", True).csv(sample).collect()))

    def check(self, result, **options):
        """Tables, sample and counts are those of a run over the whole lake."""
        whole = run_batch(self.spark, self.raw, f"{self.root}/a", f"{self.root}/s", **options)
        assert self.results(self.analytics, self.sample) == self.results(f"{self.root}/a", f"{self.root}/s")
        assert result.quality.collect() == whole.quality.collect()

    def folder(self, day):
        return Path(lake_days(self.spark, self.raw)[day].removeprefix("file:"))


@pytest.fixture
def job(spark, tmp_path):
    job = Job(spark, tmp_path)
    write_raw(traffic_hard(spark, SMALL), job.raw)
    return job


@pytest.fixture
def done(job):
    job.first = job.run(sample_rows=50)
    return job


def _add(job, day, *lines):
    folder = next(job.folder(day).iterdir())
    (folder / f"part-new{len(list(folder.iterdir()))}.json").write_text("".join(f"{line}\n" for line in lines))


def _event(sensor, time, speed=50, zone="New"):
    return f'{{"sensor_id":{sensor},"timestamp":"{time}","zone":"{zone}","road_type":"rue","average_speed":{speed},"occupancy_rate":10}}'


def test_first_run_is_the_whole_job(job, done):
    assert UNDATED in done.first.days and len(done.first.days) == 33 and done.first.gone == []
    job.check(done.first, sample_rows=50)


def test_only_changed_days_are_opened(job, done, monkeypatch):
    for day in TWO_DAYS:
        _add(job, day, _event(1, f"{day}T10:00:00+00:00"), _event(1, f"{day}T10:00:00+00:00", 20), "{broken")
    opened = []
    plain = incremental.read_day_folders

    def reading(*args):
        df = plain(*args)
        opened.extend(df.inputFiles())
        return df

    monkeypatch.setattr(incremental, "read_day_folders", reading)
    result = job.run(sample_rows=50)
    assert result.days == TWO_DAYS
    assert {Path(f).parts[-3][-2:] for f in opened} == {"10", "16"}
    job.check(result, sample_rows=50)
    opened.clear()
    assert job.run(sample_rows=50).days == [] and opened == []


def test_sizing_follows_the_days(job, done, monkeypatch):
    _add(job, TWO_DAYS[0], _event(1, f"{TWO_DAYS[0]}T10:00:00+00:00"))
    sizes = []
    plain = incremental.settings_for
    monkeypatch.setattr(incremental, "settings_for", lambda size: sizes.append(size) or plain(size))
    job.run(sample_rows=50)
    assert sizes == [sum(f.stat().st_size for f in job.folder(TWO_DAYS[0]).rglob("*.json"))]


def test_days_that_lose_their_events(job, done):
    """Nothing of a day in range any more, and a day whose folder is gone, leave no old sums behind."""
    folder = next(job.folder(TWO_DAYS[0]).iterdir())
    for other in job.folder(TWO_DAYS[0]).iterdir():
        shutil.rmtree(other)
    folder.mkdir()
    (folder / "part-0.json").write_text(_event(1, f"{TWO_DAYS[0]}T10:00:00+00:00", speed=-1) + "\n")
    shutil.rmtree(job.folder(TWO_DAYS[1]))
    shutil.rmtree(job.folder(UNDATED))
    result = job.run(sample_rows=50)
    assert (result.days, result.gone) == (TWO_DAYS[:1], [TWO_DAYS[1], UNDATED])
    job.check(result, sample_rows=50)


def test_new_days_and_early_events(job, done):
    """A day older than all others changes the sample."""
    keyed = with_partition_keys(traffic_hard(job.spark, SMALL)).limit(1)
    early = keyed.select(F.lit(_event(5, "1999-12-31T23:00:00+00:00")).alias("value"), F.lit("1999").alias("year"),
                         F.lit("12").alias("month"), F.lit("31").alias("day"), F.lit("New").alias("zone_key"))
    early.write.mode("append").partitionBy(*PARTITION_KEYS).text(job.raw)
    result = job.run(sample_rows=50)
    assert result.days == ["1999-12-31"]
    job.check(result, sample_rows=50)


@pytest.mark.parametrize("table", ["cube", "sample", "days"])
def test_failed_run_is_made_good(job, done, monkeypatch, table):
    for day in TWO_DAYS:
        _add(job, day, _event(1, f"{day}T10:00:00+00:00"))
    plain = incremental._replace

    def dies(rows, partials, name, *args, **marks):
        if name == table:
            raise RuntimeError("killed")
        plain(rows, partials, name, *args, **marks)

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "_replace", dies)
        with pytest.raises(RuntimeError, match="killed"):
            job.run(sample_rows=50)
    result = job.run(sample_rows=50)
    assert result.days == TWO_DAYS
    job.check(result, sample_rows=50)


def test_named_days_and_larger_samples(job, done):
    assert job.run(days=TWO_DAYS, sample_rows=50).days == TWO_DAYS
    with pytest.raises(ValueError, match="1970"):
        job.run(days=["1970-01-01"])
    larger = job.run(sample_rows=60)
    assert len(larger.days) == 33
    job.check(larger, sample_rows=60)


def test_versions_are_published(job):
    result = job.run(sample_rows=50, versions=True)
    job.check(result, sample_rows=50)
    assert not (job.root / "analytics" / "kpi_zone").exists()


def test_empty_lake(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    with pytest.raises(FileNotFoundError, match="no days"):
        Job(spark, tmp_path).run()


def test_stamp_sees_files_come_and_go(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_text("1")
    before = stamp(spark, str(tmp_path))
    assert stamp(spark, str(tmp_path)) == before
    (tmp_path / "a" / "y").write_text("")
    assert stamp(spark, str(tmp_path)) != before


def test_nothing_changed(job, done):
    assert changed_days(job.spark, job.raw, job.partials, 50) == ({}, [])


def test_logged_lakes_are_refused(spark, job):
    (job.root / "raw" / "_spark_metadata").mkdir()
    with pytest.raises(ValueError, match="file log"):
        job.run()


def test_no_aggregate_task_takes_all_days(spark, tmp_path, monkeypatch):
    """merged shuffle partitions end far below the memory of a task, and their rows are read back in smaller tasks."""
    noise = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"-{n}")), 256) for n in range(30)])
    second = F.date_format(F.timestamp_seconds(F.lit(1768003200) + F.col("id") % 172_800), "yyyy-MM-dd'T'HH:mm:ss")
    events = spark.range(0, 50_000, 1, 8).select(
        F.col("id").alias("sensor_id"), F.concat(second, F.lit("+00:00")).alias("timestamp"), F.lit("Centre").alias("zone"),
        F.lit("rue").alias("road_type"), *[F.lit(50).alias(c) for c in READINGS], noise.alias("event"),
    )
    key, seen = "spark.sql.files.maxPartitionBytes", []
    plain = incremental.kpi_cube
    note = lambda rows, by: seen.append((len(rows.inputFiles()), int(spark.conf.get(key)))) or plain(rows, by)
    monkeypatch.setattr(incremental, "kpi_cube", note)
    job = Job(spark, tmp_path)
    write_raw(events, job.raw)
    assert tuple(job.run().quality.first()) == (50_000, 0, 50_000, 50_000)
    ((files, scan_bytes),) = seen
    assert files > 1 and scan_bytes == 2**24


def test_lines_are_written_by_directory(spark, tmp_path, monkeypatch):
    """the lake's lines are not sorted, nor split into files, by the tasks that happen to read the events."""
    events = spark.range(0, 4_000, 1, 8).selectExpr(
        "id AS event_id", "timestamp_seconds(1704844800 + id) AS ts", "id % 7 AS user_id",
        "'view' AS event_type", "1.0D AS value", "'{}' AS props",
    )
    events.write.parquet(f"{tmp_path}/sf/events.parquet")
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}")
    counts = queries.QUERIES["incremental_quality"](spark, f"{tmp_path}/sf").first()
    assert (counts.rows_read, counts.rows_unreadable) == (4_000, 80)
    written = [f.parent for f in (tmp_path / "job/raw").rglob("part-*.txt")]
    assert len(written) == len(set(written)) > 10
