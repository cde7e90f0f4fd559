"""Column functions built from Spark's own; there is no Python UDF in the package."""

from fleetlake.functions.geo import haversine_km, region_of
from fleetlake.functions.lines import line_number, line_suffix, parse_target_ids
from fleetlake.functions.times import (
    day_period,
    gps_to_local,
    local_time,
    minutes_between,
    parse_local,
    parse_utc,
    seconds_of_day,
)

__all__ = [
    "day_period",
    "gps_to_local",
    "haversine_km",
    "line_number",
    "line_suffix",
    "local_time",
    "minutes_between",
    "parse_local",
    "parse_target_ids",
    "parse_utc",
    "region_of",
    "seconds_of_day",
]
