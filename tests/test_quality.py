import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from trafficlake.fixtures import traffic_from_events
from trafficlake.operators.quality import clean, dedup, observed_survivors, quality_report, survivors, tally, tally_report
from trafficlake.schema import EVENT_COLUMNS

SMALL = "/root/testdata/sf0.001"


def test_range_filter(event):
    cases = [(-1, 50), (0, 50), (None, 50), (10, -1), (10, 0), (10, 100), (10, 101), (10, None), (500, 50)]
    df = clean(event(*[{"average_speed": s, "occupancy_rate": o} for s, o in cases]))
    kept = {(r.average_speed, r.occupancy_rate) for r in df.collect()}
    assert kept == {(0, 50), (10, 0), (10, 100), (500, 50)}


def test_dedup_keys(event):
    df = event(
        {"sensor_id": 1, "vehicle_count": 5},
        {"sensor_id": 1, "vehicle_count": 3},
        {"sensor_id": 1, "vehicle_count": None},
        {"sensor_id": None, "timestamp": None},
        {"sensor_id": None, "timestamp": None},
        # One instant, two spellings: different keys.
        {"sensor_id": 2, "timestamp": "2026-01-08T10:00:00+00:00"},
        {"sensor_id": 2, "timestamp": "2026-01-08T11:00:00+01:00"},
    )
    rows = dedup(df).collect()
    assert len(rows) == 4
    assert [r.vehicle_count for r in rows if r.sensor_id == 1] == [None]


def test_dedup_is_idempotent_and_ignores_order(spark):
    raw = clean(traffic_from_events(spark, SMALL))
    doubled = raw.unionByName(raw.withColumn("vehicle_count", F.col("vehicle_count") + 1))
    once = dedup(doubled)
    shuffled = dedup(doubled.repartition(13).orderBy(F.desc("vehicle_count")))
    expected = sorted(map(str, once.collect()))
    assert sorted(map(str, shuffled.collect())) == expected
    assert sorted(map(str, dedup(once).collect())) == expected


def test_tally_agrees_with_clean_and_dedup(event):
    df = event(
        {"sensor_id": 1, "vehicle_count": 9},
        {"sensor_id": 1, "vehicle_count": 1, "average_speed": -1},
        {"sensor_id": 1, "vehicle_count": 4},
        {"sensor_id": 2, "occupancy_rate": 101},
        {"sensor_id": 3, "occupancy_rate": None},
        {"sensor_id": 4},
    )
    tallied = tally(df)
    assert sorted(survivors(tallied).collect()) == sorted(dedup(clean(df)).collect())
    assert tuple(tally_report(tallied).first()) == (6, 0, 3, 2)
    assert tuple(quality_report(df).first()) == (6, 0, 3, 2)


def test_report_of_nothing(event):
    assert tuple(quality_report(event({}).limit(0)).first()) == (0, 0, 0, 0)


@pytest.mark.parametrize("sf, counts", [("0.001", (1000, 0, 857, 855)), ("0.01", (10000, 0, 8494, 8458)), ("0.1", (100000, 0, 85006, 80982))])
def test_stage_counts(spark, sf, counts):
    assert tuple(quality_report(traffic_from_events(spark, f"/root/testdata/sf{sf}")).first()) == counts


def test_hot_key_collapses_before_the_shuffle(spark, event, plan):
    """A third of all rows on one key: each map task sends one row for it."""
    hot = event({"sensor_id": 7}).crossJoin(spark.range(30_000, numPartitions=8)).drop("id")
    rest = event({}).withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(59_999))))
    rest = rest.withColumn("timestamp", F.concat("timestamp", F.col("n").cast("string"))).drop("n")
    df = hot.unionByName(rest)
    assert dedup(df).count() == 60_001
    text = plan(dedup(df))
    assert text.index("partial_min") > text.index("Exchange")
    assert text.count("Exchange hashpartitioning") <= 1


def test_quality_report_reads_no_payload(spark, plan):
    text = plan(quality_report(traffic_from_events(spark, SMALL)))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_rejected_rows_leave_before_the_shuffle(spark, event, plan):
    """The range is checked below the exchange: rows that fail go through it as one row a task."""
    rejected = event({"average_speed": -1}).crossJoin(spark.range(20_000, numPartitions=4)).drop("id")
    rejected = rejected.withColumn("timestamp", F.concat("timestamp", F.monotonically_increasing_id().cast("string")))
    df = rejected.unionByName(event({}, {"sensor_id": 2}, {"sensor_id": None, "timestamp": None}))
    tallied = tally(df)
    assert tuple(tally_report(tallied).first()) == (20_003, 0, 3, 3)
    assert tallied.where("not kept").count() == 1 and survivors(tallied).count() == 3
    text = plan(tallied)
    below = text[text.index("Exchange") :]
    assert "average_speed" in below and "partial_min" in below
    tallied.collect()
    assert 0 < _shuffled_rows(tallied) <= 3 + df.rdd.getNumPartitions()


def _shuffled_rows(df):
    """Rows that the exchanges of a plan wrote, by their own counters."""
    rows, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                rows += node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            todo.extend(children.apply(i) for i in range(children.size()))
    return rows


def test_observed_counts(spark, event, tmp_path):
    """What the writing stage observes is what the report says, also where nothing is left or there is nothing."""
    cases = [event({}, {}, {"average_speed": -1}), event({"average_speed": -1}), event({}).limit(0)]
    for i, df in enumerate(cases):
        counts = Observation()
        observed_survivors(tally(df), counts).write.parquet(f"{tmp_path}/{i}")
        assert counts.get == tally_report(tally(df)).first().asDict()
        assert spark.read.parquet(f"{tmp_path}/{i}").columns == EVENT_COLUMNS
