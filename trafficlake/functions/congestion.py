from pyspark.sql import Column
from pyspark.sql import functions as F

from trafficlake.schema import CONGESTION_BANDS, CONGESTION_FREE, UNKNOWN_LABEL


def congestion_level(occupancy: Column, speed: Column) -> Column:
    """Label of the most severe band reached by either reading; unknown if one is missing."""
    bands = [
        F.when((occupancy >= from_occupancy) | (speed <= up_to_speed), F.lit(label))
        for label, from_occupancy, up_to_speed in CONGESTION_BANDS
    ]
    known = occupancy.isNotNull() & speed.isNotNull()
    return F.when(known, F.coalesce(*bands, F.lit(CONGESTION_FREE))).otherwise(UNKNOWN_LABEL)
