"""KPI tables from clean, enriched events.

All measures are exact sums (of decimals) and counts until the last division, so they can be
pre-aggregated before any shuffle and rolled up again without changing the result. Rows come in no
order; the views sort.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.operators.enrich import with_hour
from trafficlake.schema import KPI_SCHEMAS, READINGS

_DIMENSIONS = {
    "kpi_road_type": "road_type",
    "kpi_zone": "zone",
    "kpi_hourly": "hour",
    "kpi_congestion": "congestion_status",
}


def _mean(reading: str) -> Column:
    """The exact sum over the count of present readings, as a double."""
    return F.try_divide(F.sum(reading).cast("double"), F.count(reading))


# Each measure of the KPI tables by name.
_MEASURES = {
    "avg_speed": lambda: _mean("average_speed"),
    "avg_occupancy": lambda: _mean("occupancy_rate"),
    "avg_vehicles_per_sensor": lambda: _mean("vehicle_count"),
    "total_vehicles_counted": lambda: F.count("vehicle_count"),
    "total_events": lambda: F.count(F.lit(1)),
    "count": lambda: F.count(F.lit(1)),
}


def _kpi(df: DataFrame, name: str) -> DataFrame:
    dimension = _DIMENSIONS[name]
    measures = [_MEASURES[c]().alias(c) for c in KPI_SCHEMAS[name].names if c != dimension]
    return df.groupBy(dimension).agg(*measures)


def kpi_road_type(df: DataFrame) -> DataFrame:
    """Mean speed and events by road type."""
    return _kpi(df, "kpi_road_type")


def kpi_zone(df: DataFrame) -> DataFrame:
    """Mean occupancy and speed and events by zone."""
    return _kpi(df, "kpi_zone")


def kpi_hourly(df: DataFrame) -> DataFrame:
    """``total_vehicles_counted`` is the number of readings with a vehicle count, not their sum."""
    return _kpi(with_hour(df), "kpi_hourly")


def kpi_hourly_volume(df: DataFrame) -> DataFrame:
    """Vehicles per hour of day, summed."""
    return with_hour(df).groupBy("hour").agg(F.sum("vehicle_count").cast("double").alias("total_vehicles"))


def kpi_congestion(df: DataFrame) -> DataFrame:
    """Events by congestion level."""
    return _kpi(df, "kpi_congestion")


def kpi_cube(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums and counts for each combination of the four dimensions, and of ``by``; cubes of parts of the events add up
    to the cube of all."""
    return with_hour(df).groupBy(*by, *_DIMENSIONS.values()).agg(
        F.count(F.lit(1)).alias("events"),
        *[F.sum(r).alias(f"{r}_sum") for r in READINGS],
        *[F.count(r).alias(f"{r}_n") for r in READINGS],
    )


def kpi_all(df: DataFrame) -> DataFrame:
    """All KPI tables in one pass over the events, as one long table.

    Events are first reduced to one row per combination of the four dimensions; the grouping
    sets, which copy each input row four times, then run on those few rows only.
    """
    return kpi_rollup(kpi_cube(df))


def kpi_rollup(cube: DataFrame) -> DataFrame:
    """``kpi_all`` from one cube, or several in a row."""
    dimensions = list(_DIMENSIONS.values())

    def mean(reading: str) -> Column:
        return F.try_divide(F.sum(f"{reading}_sum").cast("double"), F.sum(f"{reading}_n"))

    # grouping() is 0 for the one dimension a row is grouped by.
    kpi = F.coalesce(*[F.when(F.grouping(d) == 0, F.lit(name)) for name, d in _DIMENSIONS.items()])
    return cube.groupingSets([[d] for d in dimensions], *dimensions).agg(
        kpi.alias("kpi"),
        mean("average_speed").alias("avg_speed"),
        mean("occupancy_rate").alias("avg_occupancy"),
        mean("vehicle_count").alias("avg_vehicles_per_sensor"),
        F.sum("vehicle_count_n").alias("total_vehicles_counted"),
        F.sum("events").alias("total_events"),
    )


def pick_kpi(all_kpis: DataFrame, name: str) -> DataFrame:
    """One KPI table out of ``kpi_all``."""
    renamed = {"count": "total_events"}
    columns = [F.col(renamed.get(c, c)).alias(c) for c in KPI_SCHEMAS[name].names]
    return all_kpis.where(F.col("kpi") == name).select(*columns)
