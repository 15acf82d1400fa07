"""Columns derived from a single event."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.functions import (
    congestion_level,
    dated_timestamp,
    incident_flag,
    parsed_timestamp,
    profile_bounds,
    utc_day,
    utc_hour,
    within_profile,
)


def with_congestion(df: DataFrame) -> DataFrame:
    return df.withColumn("congestion_status", congestion_level(F.col("occupancy_rate"), F.col("average_speed")))


def with_parsed_ts(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp_parsed", parsed_timestamp(F.col("timestamp")))


def with_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("hour", utc_hour(F.col("timestamp_parsed")))


def enrich(df: DataFrame) -> DataFrame:
    return with_parsed_ts(with_congestion(df))


def with_partition_keys(df: DataFrame) -> DataFrame:
    """Directory keys of the raw lake: UTC date parts as text and the zone without spaces.

    The zone itself stays in the payload with its spelling. A timestamp without a full date gives NULL keys.
    """
    day = utc_day(dated_timestamp(F.col("timestamp"))).cast("string")
    return df.withColumns(
        {
            "year": F.substring(day, 1, 4),
            "month": F.substring(day, 6, 2),
            "day": F.substring(day, 9, 2),
            "zone_key": F.replace(F.col("zone"), F.lit(" "), F.lit("_")),
        }
    )


def with_traffic_profile(df: DataFrame) -> DataFrame:
    """Time-of-day slot, its six bounds, and whether the readings lie inside them."""
    bounds = profile_bounds(utc_hour(F.col("timestamp_parsed")))
    inside = within_profile(
        F.col("vehicle_count"), F.col("average_speed"), F.col("occupancy_rate"), F.col("profile")
    )
    return df.withColumn("profile", bounds).select(*df.columns, "profile.*", inside.alias("in_profile"))


def with_incident_flag(df: DataFrame) -> DataFrame:
    bounds = profile_bounds(utc_hour(F.col("timestamp_parsed")))
    flag = incident_flag(F.col("occupancy_rate"), F.col("average_speed"), F.col("event"), bounds)
    return df.withColumn("incident", flag)
