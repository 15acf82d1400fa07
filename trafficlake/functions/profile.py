from pyspark.sql import Column
from pyspark.sql import functions as F

from trafficlake.schema import (
    INCIDENT_OCCUPANCY,
    INCIDENT_SPEED_DIVISOR,
    INCIDENT_TAG,
    PROFILE_BOUNDS,
    PROFILE_HOURS,
)


def _slot_struct(slot: str) -> Column:
    bounds = [
        F.lit(limit).cast("bigint").alias(f"{reading}_{side}")
        for reading, limits in PROFILE_BOUNDS[slot].items()
        for side, limit in zip(("min", "max"), limits)
    ]
    return F.struct(F.lit(slot).alias("slot"), *bounds)


def profile_bounds(hour: Column) -> Column:
    """Struct of the time-of-day slot and the bounds of its readings; NULL for a NULL hour."""
    daytime = [F.when(hour.isin(hours), _slot_struct(s)) for s, hours in PROFILE_HOURS.items()]
    return F.when(hour.isNotNull(), F.coalesce(*daytime, _slot_struct("night")))


def within_profile(vehicles: Column, speed: Column, occupancy: Column, bounds: Column) -> Column:
    readings = {"vehicle": vehicles, "speed": speed, "occupancy": occupancy}
    inside = F.lit(True)
    for name, reading in readings.items():
        inside = inside & reading.between(bounds[f"{name}_min"], bounds[f"{name}_max"])
    return inside


def incident_flag(occupancy: Column, speed: Column, tag: Column, bounds: Column) -> Column:
    """True for a tagged reading, or one with full occupancy and a quarter of the slot's speed."""
    slowest = F.greatest(F.lit(1), F.floor(bounds["speed_max"] / INCIDENT_SPEED_DIVISOR))
    signature = (occupancy == INCIDENT_OCCUPANCY) & (speed <= slowest)
    return tag.eqNullSafe(INCIDENT_TAG) | F.coalesce(signature, F.lit(False))
