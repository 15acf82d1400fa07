import pytest
from pyspark.sql import functions as F

from trafficlake.fixtures import traffic_from_events
from trafficlake.operators.serving import view_congestion
from trafficlake.operators import kpis
from trafficlake.operators.enrich import enrich
from trafficlake.plans.batch import traffic_clean
from trafficlake.schema import KPI_NAMES, KPI_SCHEMAS

STANDALONE = {
    "kpi_road_type": kpis.kpi_road_type,
    "kpi_zone": kpis.kpi_zone,
    "kpi_hourly": kpis.kpi_hourly,
    "kpi_congestion": kpis.kpi_congestion,
}


@pytest.fixture(scope="module")
def clean(spark):
    return traffic_clean(traffic_from_events(spark, "/root/testdata/sf0.001"))


@pytest.mark.parametrize("name", KPI_NAMES)
def test_one_pass_equals_standalone(clean, name):
    columns = KPI_SCHEMAS[name].names
    together = kpis.pick_kpi(kpis.kpi_all(clean), name)
    alone = STANDALONE[name](clean).select(*columns)
    assert together.dtypes == alone.dtypes == [(f.name, f.dataType.simpleString()) for f in KPI_SCHEMAS[name]]
    assert sorted(map(str, together.collect())) == sorted(map(str, alone.collect()))


def test_totals_agree(clean):
    n = clean.count()
    for name in ("kpi_road_type", "kpi_zone"):
        assert STANDALONE[name](clean).agg(F.sum("total_events")).first()[0] == n
    assert kpis.kpi_congestion(clean).agg(F.sum("count")).first()[0] == n
    counted = kpis.kpi_hourly(clean).agg(F.sum("total_vehicles_counted")).first()[0]
    assert counted == clean.where("vehicle_count IS NOT NULL").count()


def test_null_dimensions_and_readings(event):
    df = enrich(
        event(
            {"zone": None, "road_type": None, "timestamp": "soon", "vehicle_count": None},
            {"zone": "A", "road_type": "rue", "vehicle_count": 10},
        )
    )
    for name, kpi in STANDALONE.items():
        columns = KPI_SCHEMAS[name].names
        together = kpis.pick_kpi(kpis.kpi_all(df), name)
        assert sorted(map(str, together.collect())) == sorted(map(str, kpi(df).select(*columns).collect()))
    hourly = {r.hour: r for r in kpis.kpi_hourly(df).collect()}
    assert hourly[None].total_vehicles_counted == 0 and hourly[None].avg_vehicles_per_sensor is None


def test_count_is_of_readings_and_volume_is_a_sum(event):
    df = enrich(event({"vehicle_count": 10}, {"vehicle_count": 30}, {"vehicle_count": None}))
    row = kpis.kpi_hourly(df).first()
    assert (row.hour, row.total_vehicles_counted, row.avg_vehicles_per_sensor) == (10, 2, 20.0)
    assert kpis.kpi_hourly_volume(df).first().total_vehicles == 40


def test_order_of_results(event):
    df = enrich(
        event(
            {"zone": "B", "occupancy_rate": 50},
            {"zone": "A", "occupancy_rate": 50},
            {"zone": "C", "occupancy_rate": 60},
        )
    )
    assert [r.zone for r in view_congestion(kpis.kpi_zone(df)).collect()] == ["C", "A", "B"]


def test_events_are_reduced_before_the_grouping_sets(clean, plan):
    text = plan(kpis.kpi_all(clean)).split("\n\n")[0]
    # Lower in the plan comes later in the text: the copying step lies above an aggregate.
    assert text.index("Expand") < text.rindex("HashAggregate")
    assert text.count("SortAggregate") == 2  # only the dedup
