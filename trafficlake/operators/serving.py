"""Views for readers of the KPI tables.

These work on aggregates: one row per zone, road type or hour, whatever the number of events.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficlake.functions import round_half_even
from trafficlake.schema import METRICS, SAMPLE_COLUMNS, SAMPLE_ROWS, TOP_CONGESTED_ZONES, UNKNOWN_LABEL
from trafficlake.sources.kpi import read_kpi

_SAMPLE_TASKS = 64


def _label(column: str) -> F.Column:
    return F.coalesce(F.col(column), F.lit(UNKNOWN_LABEL)).alias(column)


def _rounded(column: str) -> F.Column:
    return round_half_even(F.col(column)).alias(column)


def view_zones(kpi: DataFrame) -> DataFrame:
    return kpi.select(_label("zone"), _rounded("avg_occupancy"), _rounded("avg_speed"), "total_events")


def view_congestion(kpi: DataFrame, k: int = TOP_CONGESTED_ZONES) -> DataFrame:
    """The ``k`` zones with the highest mean occupancy; ties go by name."""
    return view_zones(kpi.orderBy(F.desc("avg_occupancy"), "zone").limit(k))


def view_speed(kpi: DataFrame) -> DataFrame:
    ordered = kpi.orderBy(F.desc("avg_speed"), "road_type")
    return ordered.select(_label("road_type"), _rounded("avg_speed"), "total_events")


def view_trends(kpi: DataFrame) -> DataFrame:
    return kpi.orderBy("hour").select(
        "hour",
        F.col("total_vehicles_counted").alias("total_vehicles"),
        _rounded("avg_vehicles_per_sensor"),
    )


class _Series(NamedTuple):
    table: str
    value: str
    label: str
    order: str
    descending: bool = False
    top: bool = False


_SERIES = {
    "traffic.zones": _Series("kpi_zone", "total_events", "zone", order="zone"),
    "traffic.congestion": _Series(
        "kpi_zone", "avg_occupancy", "zone", order="avg_occupancy", descending=True, top=True
    ),
    "traffic.speed": _Series("kpi_road_type", "avg_speed", "road_type", order="avg_speed", descending=True),
    "traffic.trends": _Series("kpi_hourly", "total_vehicles_counted", "hour", order="hour"),
}


def _points(kpi: DataFrame, target: str, series: _Series, top: int) -> DataFrame:
    # One answer is one ordered list of KPI rows, so it is numbered in one place.
    order = F.desc(series.order) if series.descending else F.asc(series.order)
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order, series.label))
    label = F.col(series.label) if series.label == "hour" else _label(series.label)
    value = _rounded(series.value) if series.value.startswith("avg_") else F.col(series.value)
    numbered = kpi.withColumn("number", number)
    # The limit is on the bare number, which Spark recognises: no more than that many rows are sorted.
    numbered = numbered.where(F.col("number") <= top) if series.top else numbered
    return numbered.select(
        F.lit(target).alias("target"),
        (F.col("number") - 1).alias("pos"),
        value.cast("double").alias("value"),
        label.cast("string").alias("label"),
    )


def query_metrics(
    spark: SparkSession, base: str, targets: list[str], top: int = TOP_CONGESTED_ZONES
) -> DataFrame:
    """Points of the requested metrics, one row each.

    Requests are answered in order (``request_pos``), repeated ones again, unknown ones not at
    all; each metric is computed once. ``pos`` numbers the points of one answer. ``top`` is the
    number of most congested zones.
    """
    wanted = [(i, target) for i, target in enumerate(targets) if target in _SERIES]
    if not wanted:
        return spark.createDataFrame([], "request_pos int, target string, pos int, value double, label string")
    series = {target: _SERIES[target] for _, target in wanted}
    points = [_points(read_kpi(spark, base, s.table), target, s, top) for target, s in series.items()]
    requests = spark.createDataFrame(wanted, "request_pos int, target string")
    # The request is as long as the caller's list.
    answers = reduce(DataFrame.unionByName, points).join(F.broadcast(requests), "target")
    return answers.select("request_pos", "target", "pos", "value", "label")


def metric_datapoints(series: DataFrame) -> DataFrame:
    """One row per answer with its points as a list of (value, label)."""
    points = F.array_sort(F.collect_list(F.struct("pos", "value", "label")))
    return series.groupBy("request_pos", "target").agg(
        F.transform(points, lambda p: F.struct(p["value"], p["label"])).alias("datapoints")
    )


def metric_catalogue(spark: SparkSession, base: str | None = None) -> DataFrame:
    """Names of the metrics that can be asked for; with the folder of the KPI tables also ``n_points``, how many points
    each of them has now."""
    names = spark.createDataFrame([(name,) for name in METRICS], "target string")
    if base is None:
        return names
    points = query_metrics(spark, base, METRICS).groupBy("target").agg(F.count(F.lit(1)).alias("n_points"))
    # Both sides have one row a metric.
    return names.join(F.broadcast(points), "target", "left").fillna(0, ["n_points"])


def sample_order() -> list[str]:
    """Columns by which events are first: time and sensor, then the rest."""
    return ["timestamp", "sensor_id", *[c for c in SAMPLE_COLUMNS if c not in ("timestamp", "sensor_id")]]


def sample_part() -> F.Column:
    """The part of a row's task, so that a task's rows are cut to the first ones before the shuffle, whatever their keys."""
    return F.spark_partition_id() % _SAMPLE_TASKS


def sample_events(df: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The ``n`` earliest events in a fixed column order.

    Each task keeps its first ``n`` rows; gathered by task into ``_SAMPLE_TASKS`` parts these are cut to ``n`` again,
    so that the last task sees ``n`` rows from each of those only, however many tasks there were.
    """
    order = sample_order()
    rows = df.select(*SAMPLE_COLUMNS)
    number = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    # row_number limits are applied before the shuffle too.
    first = rows.withColumn("part", sample_part()).withColumn("number", number).where(F.col("number") <= n)
    return first.select(*SAMPLE_COLUMNS).orderBy(*order).limit(n)
