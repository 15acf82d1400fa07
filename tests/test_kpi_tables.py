"""Written KPI tables: sinks, reader, views, metrics, validation and the batch job."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from trafficlake.__main__ import main
from trafficlake.fixtures import traffic_from_events
from trafficlake.operators import kpis, serving
from trafficlake.operators.enrich import enrich
from trafficlake.operators.upkeep import validate_outputs
from trafficlake.plans import batch
from trafficlake.paths import overlap
from trafficlake.plans.batch import clean_events, run_batch, traffic_clean
from trafficlake.schema import KPI_NAMES, METRICS, READINGS, SAMPLE_COLUMNS
from trafficlake.session import scratch_dir, settings_for
from trafficlake.sinks.kpi import write_kpi, write_sample
from trafficlake.sinks.raw import write_raw
from trafficlake.sources.kpi import read_kpi

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    write_raw(traffic_from_events(spark, SMALL), f"{base}/raw")
    result = run_batch(spark, f"{base}/raw", f"{base}/analytics", f"{base}/sample", f"{base}/clean")
    return str(base), result


@pytest.fixture(scope="module")
def clean(spark):
    return traffic_clean(traffic_from_events(spark, SMALL))


def _rows(df):
    return sorted(map(str, df.collect()))


def test_job_counts_and_clean_table(spark, job, clean):
    _, result = job
    assert tuple(result.quality.first()) == (1000, 0, 857, 855)
    stored = clean_events(spark, result.clean_path)
    assert _rows(stored.select(*clean.columns)) == _rows(clean)


def test_scratch_is_removed(spark, job, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "scratch_dir", lambda spark, label: f"{tmp_path}/scratch")
    result = run_batch(spark, f"{job[0]}/raw", f"{tmp_path}/analytics", f"{tmp_path}/sample")
    assert result.clean_path is None
    assert not (tmp_path / "scratch").exists()
    assert tuple(result.quality.first()) == (1000, 0, 857, 855)


@pytest.mark.parametrize("name", KPI_NAMES)
def test_job_tables(spark, job, clean, name):
    table = read_kpi(spark, f"{job[0]}/analytics", name)
    expected = getattr(kpis, name)(clean).select(*table.columns)
    assert _rows(table) == _rows(expected)


def test_job_sample(spark, job, clean):
    sample = spark.read.option("header", True).csv(f"{job[0]}/sample")
    assert sample.columns == SAMPLE_COLUMNS
    assert sample.count() == 855


@pytest.mark.parametrize(
    "raw, analytics, sample",
    [
        ("/d/raw/*/*", "/d/raw/kpi", "/d/s"),
        ("/d/raw", "/d", "/s"),
        ("/d", "/a", "/a/s"),
        ("file:{base}/raw", "{base}/a", "{base}/raw"),
        ("{base}/raw", "{base}/a", "file://{base}/raw/x"),
        ("{base}/ra?", "{base}/a", "{base}/raw"),
        ("{base}/ra*", "{base}/a", "{base}/rawer"),
        ("{base}/ra[vw]", "{base}/raw", "{base}/s"),
        ("{base}/{{raw,x}}", "{base}/a", "{base}/raw"),
        ("{base}/{{raw/year=2024,x}}", "{base}/a", "{base}/raw/year=2024"),
        ("{base}//raw/", "{base}/a", "{base}/raw"),
        ("{base}/raw", "{base}/a", "{base}/./raw"),
        ("{base}/raw", "{base}/a/../raw", "{base}/s"),
        ("{base}/raw/*/*/*/*/*.json", "{base}/a", "{base}/raw"),
    ],
)
def test_job_refuses_overlapping_folders(spark, job, raw, analytics, sample):
    raw, analytics, sample = (x.format(base=job[0]) for x in (raw, analytics, sample))
    before = _tree(f"{job[0]}/raw")
    with pytest.raises(ValueError, match="overlap"):
        run_batch(spark, raw, analytics, sample)
    assert _tree(f"{job[0]}/raw") == before


def test_job_compares_relative_paths(spark, job, tmp_path, monkeypatch):
    system = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
    name = os.path.relpath(f"{job[0]}/raw", system.getWorkingDirectory().toUri().getPath())
    with pytest.raises(ValueError, match="overlap"):
        run_batch(spark, f"{job[0]}/raw", str(tmp_path / "a"), name)


def test_neighbours_do_not_overlap(spark, job):
    assert not overlap(spark, f"{job[0]}/raw", f"{job[0]}/raw2")
    assert not overlap(spark, f"{job[0]}/raw/*/x", f"{job[0]}/analytics")


def _tree(folder):
    return sorted(os.path.join(root, f) for root, _, files in os.walk(folder) for f in files)


def test_failed_job_leaves_no_scratch(spark, job, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "scratch_dir", lambda spark, label: f"{tmp_path}/scratch")
    monkeypatch.setattr(batch, "write_sample", lambda df, path: 1 / 0)
    settings = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    with pytest.raises(ZeroDivisionError):
        run_batch(spark, f"{job[0]}/raw", f"{tmp_path}/analytics", f"{tmp_path}/sample")
    assert not (tmp_path / "scratch").exists()
    assert settings == (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.files.maxPartitionBytes"))


def test_results_do_not_depend_on_the_sizing(spark, job, tmp_path):
    run_batch(spark, f"{job[0]}/raw", f"{tmp_path}/a", f"{tmp_path}/s", input_bytes=200 * 1024**3, sample_rows=7)
    for name in KPI_NAMES:
        assert _rows(read_kpi(spark, f"{tmp_path}/a", name)) == _rows(read_kpi(spark, f"{job[0]}/analytics", name))
    assert spark.read.option("header", True).csv(f"{tmp_path}/s").count() == 7


def test_job_over_chosen_days(spark, job, tmp_path):
    days = run_batch(spark, f"{job[0]}/raw", f"{tmp_path}/a", f"{tmp_path}/s", start="2024-01-10", end="2024-01-12")
    raw = traffic_from_events(spark, SMALL).where("substr(timestamp, 1, 10) BETWEEN '2024-01-10' AND '2024-01-12'")
    assert days.quality.first().rows_read == raw.count() > 0
    assert _rows(read_kpi(spark, f"{tmp_path}/a", "kpi_zone")) == _rows(
        kpis.kpi_zone(traffic_clean(raw)).select(*read_kpi(spark, f"{tmp_path}/a", "kpi_zone").columns)
    )


def test_kpi_folder_without_files_is_an_error(spark, tmp_path):
    (tmp_path / "kpi_zone").mkdir()
    with pytest.raises(FileNotFoundError):
        read_kpi(spark, str(tmp_path), "kpi_zone")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_kpi(spark, str(tmp_path), "kpi_hourly")


def test_each_metric_is_planned_once(spark, job, plan):
    text = plan(serving.query_metrics(spark, f"{job[0]}/analytics", ["traffic.zones"] * 20))
    assert text.count("Scan parquet") <= 2
    top = plan(serving.query_metrics(spark, f"{job[0]}/analytics", ["traffic.congestion"], top=2))
    assert "WindowGroupLimit" in top or "TakeOrderedAndProject" in top
    assert serving.query_metrics(spark, f"{job[0]}/analytics", ["traffic.congestion"], top=2).count() == 2


def test_overwrite_replaces_everything(spark, event, tmp_path):
    base = str(tmp_path)
    for zones in (["A", "B"], ["C d", None, "Périphérie"]):
        kpi = kpis.kpi_zone(enrich(event(*[{"zone": z} for z in zones])))
        write_kpi(kpi, base, "kpi_zone", ["zone"])
        got = [r.zone for r in read_kpi(spark, base, "kpi_zone").collect()]
        assert sorted(map(str, got)) == sorted(map(str, zones))
    assert {d for d in os.listdir(f"{base}/kpi_zone") if "zone=Périphérie" in d}


def test_corrupt_files_only_skipped_on_request(spark, event, tmp_path):
    base = str(tmp_path)
    write_kpi(kpis.kpi_congestion(enrich(event({}))), base, "kpi_congestion")
    (tmp_path / "kpi_congestion" / "part-bad.parquet").write_bytes(b"not parquet")
    assert read_kpi(spark, base, "kpi_congestion", ignore_corrupt=True).count() == 1
    with pytest.raises(Exception):
        read_kpi(spark, base, "kpi_congestion").collect()


def test_views(event):
    readings = [("A", 10), ("B", 20), ("C", 30), ("D", 40), ("E", 50), ("F", 60), (None, 70)]
    df = enrich(event(*[{"zone": z, "occupancy_rate": o} for z, o in readings], {"zone": "A", "occupancy_rate": 11},
                      {"zone": "A", "occupancy_rate": 11}))
    kpi = kpis.kpi_zone(df)
    assert [r.zone for r in serving.view_congestion(kpi).collect()] == ["Inconnu", "F", "E", "D", "C"]
    assert [r.zone for r in serving.view_congestion(kpi, k=1).collect()] == ["Inconnu"]
    zones = {r.zone: r for r in serving.view_zones(kpi).collect()}
    assert (zones["A"].avg_occupancy, zones["A"].total_events) == (10.67, 3)
    assert serving.view_trends(kpis.kpi_hourly(df)).columns == ["hour", "total_vehicles", "avg_vehicles_per_sensor"]


def test_top_k_needs_no_full_sort(clean, plan):
    assert "TakeOrderedAndProject" in plan(serving.view_congestion(kpis.kpi_zone(clean)))
    assert "TakeOrderedAndProject" in plan(serving.sample_events(clean))


def test_sample_is_deterministic(clean):
    ordered = clean.orderBy("timestamp", "sensor_id").select(*SAMPLE_COLUMNS).take(10)
    assert serving.sample_events(clean.repartition(7), n=10).collect() == ordered


def test_sample_csv(spark, event, tmp_path):
    path = str(tmp_path / "csv")
    write_sample(serving.sample_events(enrich(event({"vehicle_count": None}))), path)
    row = spark.read.option("header", True).csv(path).first()
    assert (row.sensor_id, row.vehicle_count, row.congestion_status) == ("1", None, "Fluide")


def test_metrics_follow_the_request(spark, job):
    base = f"{job[0]}/analytics"
    request = ["traffic.speed", "traffic.none", "traffic.zones", "traffic.speed"]
    rows = serving.query_metrics(spark, base, request).collect()
    assert {(r.request_pos, r.target) for r in rows} == {(0, request[0]), (2, request[2]), (3, request[3])}
    speed = sorted((r.pos, r.value, r.label) for r in rows if r.request_pos == 0)
    assert speed == sorted((r.pos, r.value, r.label) for r in rows if r.request_pos == 3)
    assert [v for _, v, _ in speed] == sorted((v for _, v, _ in speed), reverse=True)
    zones = sorted((r.pos, r.label) for r in rows if r.request_pos == 2)
    assert [z for _, z in zones] == sorted(z for _, z in zones) and [p for p, _ in zones] == [0, 1, 2, 3]


def test_metric_positions_follow_unrounded_values(spark, event, tmp_path):
    """Means of 30.001 and 30.002 are both shown as 30.0 but keep their order."""
    kpi = spark.createDataFrame([("A", 30.001, 1), ("B", 30.002, 1)], "road_type string, avg_speed double, total_events bigint")
    write_kpi(kpi, str(tmp_path), "kpi_road_type")
    rows = serving.query_metrics(spark, str(tmp_path), ["traffic.speed"]).orderBy("pos").collect()
    assert [(r.label, r.value) for r in rows] == [("B", 30.0), ("A", 30.0)]


def test_no_metrics(spark):
    empty = serving.query_metrics(spark, "/nowhere", ["traffic.none"])
    assert empty.count() == 0
    assert serving.query_metrics(spark, "/nowhere", []).dtypes == empty.dtypes
    assert empty.columns == ["request_pos", "target", "pos", "value", "label"]


def test_datapoints(spark, job):
    series = serving.query_metrics(spark, f"{job[0]}/analytics", ["traffic.trends"])
    (row,) = serving.metric_datapoints(series).collect()
    expected = [(r.value, r.label) for r in series.orderBy("pos").collect()]
    assert [tuple(p) for p in row.datapoints] == expected
    assert [label for _, label in expected] == [str(h) for h in range(24)]


def test_catalogue(spark, job):
    names = serving.metric_catalogue(spark).collect()
    assert sorted(r.target for r in names) == sorted(METRICS)


def test_validation(spark, job, event, tmp_path):
    complete = validate_outputs(spark, f"{job[0]}/analytics").collect()
    assert {r.folder: r.n_files > 0 for r in complete} == dict.fromkeys(KPI_NAMES, True)
    assert {r.status for r in complete} == {"OK"}
    assert {r.folder: r.n_files for r in complete}["kpi_zone"] >= 4

    write_kpi(kpis.kpi_congestion(enrich(event({}))), str(tmp_path), "kpi_congestion")
    partial = {r.folder: (r.n_files, r.status) for r in validate_outputs(spark, str(tmp_path)).collect()}
    assert partial["kpi_congestion"] == (1, "PARTIAL") and partial["kpi_zone"] == (0, "PARTIAL")

    assert {r.n_files for r in validate_outputs(spark, str(tmp_path / "nowhere")).collect()} == {0}


def test_validation_reads_no_content(spark, job, plan):
    text = plan(validate_outputs(spark, f"{job[0]}/analytics"))
    assert "content" not in text


def test_scratch_follows_the_session():
    def session(**settings):
        settings = {key.replace("_", "."): value for key, value in settings.items()}
        return SimpleNamespace(conf=SimpleNamespace(get=settings.get))

    shared = session(spark_checkpoint_dir="hdfs:///cp/", spark_master="yarn")
    assert scratch_dir(shared, "x").startswith("hdfs:///cp/trafficlake/x-")
    assert scratch_dir(shared, "x") != scratch_dir(shared, "x")
    assert scratch_dir(session(spark_master="local[2]"), "x").startswith("/tmp/run-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session(spark_master="yarn"), "x")


def test_settings_grow_with_input():
    small, large = settings_for(10**9), settings_for(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "1"
    assert 20_000 < int(large["spark.sql.shuffle.partitions"]) < 30_000
    assert 100 * 10**12 / int(large["spark.sql.files.maxPartitionBytes"]) < 101_000


def test_command_line(spark, tmp_path, capsys):
    write_raw(traffic_from_events(spark, SMALL), f"{tmp_path}/raw")
    main(["batch", f"{tmp_path}/raw/*/*/*/*/*.json", f"{tmp_path}/a", f"{tmp_path}/s", "--clean", f"{tmp_path}/c"])
    assert "855" in capsys.readouterr().out
    assert clean_events(spark, f"{tmp_path}/c").count() == 855
    main(["validate", f"{tmp_path}/a"])
    out = capsys.readouterr().out
    assert "kpi_zone" in out and "OK" in out and "PARTIAL" not in out


def _large_lake(spark, raw):
    """50,000 unique events on one day with texts that hardly shrink, about 60 MB once shuffled, in as many tasks' files."""
    noise = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"-{n}")), 256) for n in range(30)])
    second = F.date_format(F.timestamp_seconds(F.lit(1768003200) + F.col("id") % 3600), "yyyy-MM-dd'T'HH:mm:ss")
    events = spark.range(0, 50_000, 1, 8).select(
        F.col("id").alias("sensor_id"), F.concat(second, F.lit("+00:00")).alias("timestamp"), F.lit("Centre").alias("zone"),
        F.lit("rue").alias("road_type"), *[F.lit(50).alias(c) for c in READINGS], noise.alias("event"),
    )
    write_raw(events, raw)


def test_no_aggregate_task_takes_all(spark, tmp_path):
    """merged shuffle partitions end far below the memory of a task."""
    _large_lake(spark, f"{tmp_path}/raw")
    names = [f"{tmp_path}/{name}" for name in ("raw", "analytics", "sample", "clean")]
    assert tuple(run_batch(spark, *names).quality.first()) == (50_000, 0, 50_000, 50_000)
    stored = clean_events(spark, names[3]).groupBy(F.input_file_name()).count().collect()
    assert len(stored) > 1 and max(r["count"] for r in stored) < 40_000


def test_partitions_follow_the_input():
    for gib in (6, 600, 6_000):
        assert int(settings_for(gib * 2**30)["spark.sql.shuffle.partitions"]) == gib


def test_the_clean_table_is_read_in_smaller_tasks(spark, job, tmp_path, monkeypatch):
    """a byte of it holds ten times the rows of a byte of JSON."""
    key, seen = "spark.sql.files.maxPartitionBytes", []
    plain = batch.write_kpis
    monkeypatch.setattr(batch, "write_kpis", lambda *a: seen.append(int(spark.conf.get(key))) or plain(*a))
    before = spark.conf.get(key)
    run_batch(spark, f"{job[0]}/raw", f"{tmp_path}/analytics", f"{tmp_path}/sample")
    assert seen == [2**24] and spark.conf.get(key) == before


def test_sample_is_cut_per_task(spark, tmp_path):
    """Each task sends as many rows as the sample has, whatever their keys."""
    events = enrich(traffic_from_events(spark, "/root/testdata/sf0.01").repartition(4, "sensor_id"))
    sample = serving.sample_events(events, 20)
    order = serving.sample_order()
    assert sample.collect() == events.select(*SAMPLE_COLUMNS).orderBy(*order).limit(20).collect()
    parts = events.select(F.spark_partition_id().alias("id"), serving.sample_part().alias("part")).distinct()
    assert parts.groupBy("id").count().agg(F.max("count")).first()[0] == 1
