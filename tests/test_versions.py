"""Published versions of the KPI tables, and the check of their files."""

import pytest

from trafficlake import versions
from trafficlake.operators import kpis
from trafficlake.operators.enrich import enrich
from trafficlake.operators.serving import metric_catalogue, query_metrics
from trafficlake.operators.upkeep import validate_outputs
from trafficlake.plans.batch import write_kpis
from trafficlake.schema import KPI_NAMES, METRICS
from trafficlake.sinks.kpi import write_kpi
from trafficlake.sources.kpi import check_files, read_kpi
from trafficlake.versions import current, new_version, publish


def _write(event, base, zones):
    write_kpis(enrich(event(*[{"zone": z, "sensor_id": i} for i, z in enumerate(zones)])), base, f"{base}-staging", versions=True)


def _zones(df):
    return sorted(r.zone for r in df.collect())


def test_a_reader_sees_one_version_throughout(spark, event, tmp_path):
    base = str(tmp_path / "kpi")
    _write(event, base, ["A", "B"])
    reading = read_kpi(spark, base, "kpi_zone")
    _write(event, base, ["C"])
    assert _zones(reading) == ["A", "B"] and _zones(read_kpi(spark, base, "kpi_zone")) == ["C"]
    assert {r.status for r in validate_outputs(spark, base).collect()} == {"OK"}
    assert query_metrics(spark, base, ["traffic.zones"]).count() == 1


def test_nothing_is_seen_before_all_tables_are_there(spark, event, tmp_path, monkeypatch):
    """A writer that dies among the four tables leaves the version before."""
    base = str(tmp_path / "kpi")
    _write(event, base, ["A", "B"])
    from trafficlake.plans import batch

    plain = batch.write_kpi

    def dies(df, target, name, partition_by=None):
        if name == KPI_NAMES[2]:
            raise RuntimeError("killed")
        plain(df, target, name, partition_by)

    monkeypatch.setattr(batch, "write_kpi", dies)
    with pytest.raises(RuntimeError):
        _write(event, base, ["C"])
    assert _zones(read_kpi(spark, base, "kpi_zone")) == ["A", "B"]
    assert read_kpi(spark, base, "kpi_road_type").first().total_events == 2


def test_old_versions_go_after_the_grace_time(spark, tmp_path, monkeypatch):
    base, clock = str(tmp_path), [1000.0]
    monkeypatch.setattr(versions.time, "time", lambda: clock[0])

    def published():
        folder = new_version(base)
        write_kpi(spark.range(1).selectExpr("'x' congestion_status", "1L count"), folder, "kpi_congestion")
        return publish(spark, base, folder, grace=60)

    first, second = published(), published()
    assert first < second == current(spark, base)
    clock[0] += 59
    third = published()
    kept = {f.name for f in (tmp_path / "_versions").iterdir()}
    assert kept == {p.rpartition("/")[2] for p in (first, second, third)}
    clock[0] += 61
    fourth = published()
    kept = {f.name for f in (tmp_path / "_versions").iterdir()}
    assert kept == {p.rpartition("/")[2] for p in (third, fourth)}
    clock[0] -= 5000  # a clock that is set back does not bring an old version to the front
    assert published() == current(spark, base)


def test_without_versions_the_folder_itself_is_read(spark, event, tmp_path):
    assert current(spark, f"{tmp_path}/nowhere") == f"{tmp_path}/nowhere"
    write_kpi(kpis.kpi_congestion(enrich(event({}))), str(tmp_path), "kpi_congestion")
    assert read_kpi(spark, str(tmp_path), "kpi_congestion").count() == 1


def test_damaged_files_are_named(spark, event, tmp_path):
    write_kpi(kpis.kpi_zone(enrich(event({"zone": "A"}, {"zone": "B"}))), str(tmp_path), "kpi_zone", ["zone"])
    (good,) = (tmp_path / "kpi_zone" / "zone=A").glob("*.parquet")
    content = good.read_bytes()
    page = bytearray(content)
    page[4:40] = bytes(36)  # data pages, with the footer intact
    damaged = {"cut": content[: len(content) // 2], "tail": content[:-8] + b"\xff\xff\xff\x7fPAR1", "text": b"not parquet", "page": bytes(page)}
    for name, octets in damaged.items():
        (tmp_path / "kpi_zone" / "zone=B" / f"part-{name}.parquet").write_bytes(octets)
    rows = check_files(spark, str(tmp_path), "kpi_zone").collect()
    assert len(rows) == 6
    bad = {r.path.rpartition("-")[2].partition(".")[0]: r for r in rows if r.error}
    assert bad.keys() == damaged.keys() and all(r.n_rows is None for r in bad.values())
    assert sorted(r.n_rows for r in rows if r.error is None) == [1, 1]


def test_catalogue_counts_points(spark, event, tmp_path):
    write_kpis(enrich(event(*[{"zone": f"Z{i}"} for i in range(7)])), str(tmp_path), f"{tmp_path}-staging")
    points = {r.target: r.n_points for r in metric_catalogue(spark, str(tmp_path)).collect()}
    assert points == {"traffic.zones": 7, "traffic.congestion": 5, "traffic.speed": 1, "traffic.trends": 1}
    assert [r.target for r in metric_catalogue(spark).collect()] == METRICS
