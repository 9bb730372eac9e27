"""Declared schemas of the silver and gold tables (section 1.3 of the survey).

Operators always return these columns, also on empty input.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, I, L, TS, B = (T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(),
                     T.TimestampNTZType(), T.BooleanType())


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


AIRPORTS = _st(("iata_code", S), ("name", S), ("lat", D), ("lng", D))
AIRLINES = _st(("iata_code", S), ("name", S))
FLEETS = _st(("reg_number", S), ("manufacturer", S), ("model", S), ("built", L), ("age", L))

SCHEDULES = _st(
    ("flight_code", S), ("status", S), ("departure_airport", S), ("arrival_airport", S),
    ("airline_code", S), ("scheduled_departure_utc", TS), ("scheduled_arrival_utc", TS),
    ("departure_delay_mins", I), ("arrival_delay_mins", I),
    ("dep_airport_name", S), ("dep_lat", D), ("dep_lng", D),
    ("arr_airport_name", S), ("arr_lat", D), ("arr_lng", D), ("airline_name", S))

FLIGHTS = _st(
    ("flight_code", S), ("reg_number", S), ("icao_24bit_hex", S), ("lat", D), ("lng", D),
    ("altitude_ft", L), ("ground_speed_knt", D), ("heading_deg", D), ("status", S),
    ("airline_code", S), ("last_updated_utc", TS),
    ("aircraft_manufacturer", S), ("aircraft_model", S),
    ("aircraft_built_year", L), ("aircraft_age_years", L))

WEATHER = _st(
    ("airport_city", S), ("observation_time_utc", TS), ("temp_celsius", D),
    ("feels_like_celsius", D), ("pressure_hpa", I), ("humidity_percent", I),
    ("wind_speed_mps", D), ("cloudiness_percent", I), ("visibility_meters", I))

ARRIVALS = _st(
    ("flight_code", S), ("departure_airport", S), ("arrival_airport", S), ("status", S),
    ("airline_code", S), ("lat", D), ("lng", D), ("last_updated_utc", TS),
    ("dep_airport_name", S), ("dep_lat", D), ("dep_lng", D), ("airline_name", S))

# Right-hand columns of the schedule/flight facts (J2), in output order.
FACT_FLIGHT_COLUMNS = [
    ("last_updated_utc", TS), ("reg_number", S), ("icao_24bit_hex", S),
    ("live_lat", D), ("live_lng", D), ("altitude_ft", L), ("ground_speed_knt", D),
    ("heading_deg", D), ("live_status", S), ("aircraft_manufacturer", S),
    ("aircraft_model", S), ("aircraft_built_year", L), ("aircraft_age_years", L)]

AIRLINE_PERFORMANCE = _st(("airline_code", S), ("airline_name", S),
                          ("avg_departure_delay_mins", D), ("total_flights", L))
WEATHER_IMPACT = _st(("metric", S), ("bucket_label", S), ("bucket_start", D),
                     ("bucket_end", D), ("avg_departure_delay_mins", D), ("flight_count", L))
HOURLY_TRAFFIC = _st(("departure_hour_utc", I), ("flight_count", L))
ACTIVE_ROUTES = _st(("departure_airport", S), ("arrival_airport", S), ("dep_lat", D),
                    ("dep_lng", D), ("arr_airport_name", S), ("arr_lat", D), ("arr_lng", D),
                    ("flight_count", L), ("last_scheduled_departure_utc", TS))

# Ingest order of a silver row, kept beside the declared columns.
INGEST = "_ingest"


def conform(df: DataFrame, schema: T.StructType, also: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns in their declared types (a missing one is null), and
    those of ``also`` that exist."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields], *[c for c in also if c in have])
