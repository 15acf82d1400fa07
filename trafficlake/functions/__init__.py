"""Column expressions. All are built-in functions, so they stay inside generated code."""

from trafficlake.functions.congestion import congestion_level
from trafficlake.functions.profile import incident_flag, profile_bounds, within_profile
from trafficlake.functions.rounding import round_half_even
from trafficlake.functions.timestamps import dated_timestamp, parsed_timestamp, utc_day, utc_hour

__all__ = [
    "congestion_level",
    "dated_timestamp",
    "incident_flag",
    "parsed_timestamp",
    "profile_bounds",
    "round_half_even",
    "utc_day",
    "utc_hour",
    "within_profile",
]
