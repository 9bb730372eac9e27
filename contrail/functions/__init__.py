"""Scalar column expressions; all JVM-side (no Python UDFs)."""

from contrail.functions.geo import bearing_deg, haversine_km
from contrail.functions.numeric import (floor_step, null_default_int, range_label,
                                        round2, tolerant_int, value_map,
                                        visibility_level)
from contrail.functions.text import code_equals_ci, contains_ci
from contrail.functions.time import (epoch_micros, epoch_seconds, epoch_seconds_to_ts,
                                     hour_utc, iso_weekday, local_date, minute_label,
                                     to_local, truncate_minutes, utc_bounds)

__all__ = [
    "bearing_deg", "haversine_km", "floor_step", "null_default_int", "range_label",
    "round2", "tolerant_int", "value_map", "visibility_level", "code_equals_ci",
    "contains_ci", "epoch_micros", "epoch_seconds", "epoch_seconds_to_ts", "hour_utc",
    "iso_weekday", "local_date", "minute_label", "to_local", "truncate_minutes",
    "utc_bounds",
]
