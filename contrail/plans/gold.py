"""Gold layer: facts, correlations and the five analytical tables.

J2 / J3 use the sort-based as-of operator; every aggregate is a single
``groupBy`` with map-side partial aggregation.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail import schemas as S
from contrail.functions.numeric import floor_step, range_label, round2, visibility_level
from contrail.functions.time import hour_utc
from contrail.operators.align import optional_col
from contrail.operators.asof import asof_nearest
from contrail.operators.dedup import keep_last
from contrail.operators.joins import airport_columns, dictionary_order, join_airlines

# The reference's matching tolerances and origin airport.
FLIGHT_SCHEDULE_MATCH_TOLERANCE = timedelta(hours=12)
WEATHER_MATCH_TOLERANCE = timedelta(hours=1)
ORIGIN_AIRPORT = "KRK"

GOLD_DATASETS = ("weather_correlation", "airline_performance", "weather_impact",
                 "hourly_traffic", "active_routes")


def _flight_side(flights: DataFrame) -> DataFrame:
    """Right side of J2: live columns renamed, optional ones typed nulls."""
    rename = {"lat": "live_lat", "lng": "live_lng", "status": "live_status"}
    cols = [F.col("flight_code")]
    for name, dtype in S.FACT_FLIGHT_COLUMNS:
        src = next((k for k, v in rename.items() if v == name), name)
        cols.append(optional_col(flights, src, dtype, alias=name))
    return flights.select(cols)


def schedule_flight_facts(schedules: DataFrame, flights: DataFrame,
                          tolerance: timedelta = FLIGHT_SCHEDULE_MATCH_TOLERANCE,
                          right_order: list[str] | None = None,
                          split_rows: int | None = None) -> DataFrame:
    """Each scheduled departure + the nearest live snapshot of the same
    flight code within ``tolerance`` (left join semantics)."""
    return asof_nearest(schedules, _flight_side(flights),
                        left_on="scheduled_departure_utc", right_on="last_updated_utc",
                        by=["flight_code"], tolerance=tolerance, right_order=right_order,
                        split_rows=split_rows)


def match_weather(facts: DataFrame, weather: DataFrame, tolerance: timedelta = WEATHER_MATCH_TOLERANCE,
                  split_rows: int | None = None) -> DataFrame:
    """J3 + J4, also where ``weather`` holds nothing: all rows are misses then."""
    matched = facts.where(F.col("last_updated_utc").isNotNull())
    out = asof_nearest(matched, weather, left_on="last_updated_utc",
                       right_on="observation_time_utc", tolerance=tolerance, split_rows=split_rows)
    return out.withColumn("has_weather_match", F.col("observation_time_utc").isNotNull())


def weather_correlation(facts: DataFrame, weather: DataFrame,
                        tolerance: timedelta = WEATHER_MATCH_TOLERANCE,
                        split_rows: int | None = None) -> DataFrame:
    """J3 + J4: matched facts + the nearest weather observation (no key);
    ``has_weather_match`` flags a found observation."""
    out = match_weather(facts, weather, tolerance, split_rows)
    # no observations at all -> no correlation table (not a table of misses): a
    # semi-join with at most one row, which the plan looks up when it runs
    any_weather = F.broadcast(weather.limit(1).select(F.lit(1).alias("__any")))
    return out.withColumn("__any", F.lit(1)).join(any_weather, "__any", "left_semi").drop("__any")


def airline_performance(facts: DataFrame, airlines: DataFrame | None,
                        airlines_order: list[str] | None = None) -> DataFrame:
    """A1: per airline, rounded mean departure delay and matched-flight count;
    ordered by count desc, code asc."""
    base = facts.where(F.col("last_updated_utc").isNotNull()
                       & F.col("airline_code").isNotNull())
    base = join_airlines(base, airlines, dedup_order=list(airlines_order or []), replace=True)
    return (base.groupBy("airline_code", "airline_name")
                .agg(round2(F.avg("departure_delay_mins")).alias("avg_departure_delay_mins"),
                     F.count(F.lit(1)).alias("total_flights"))
                .orderBy(F.desc_nulls_first("total_flights"), F.asc("airline_code")))


# Bucket widths and metric names of the weather impact table.
TEMP_STEP = 5.0
WIND_STEP = 2.0
METRICS = ("temperature_celsius", "wind_speed_mps", "visibility_level")


def impact_members(correlation: DataFrame, *columns) -> DataFrame:
    """Each delayed flight with weather as its three (metric, bucket) memberships
    ``m``, with its delay and ``columns``."""
    base = correlation.where(F.col("has_weather_match")
                             & F.col("departure_delay_mins").isNotNull())
    t0 = floor_step("temp_celsius", TEMP_STEP)
    w0 = floor_step("wind_speed_mps", WIND_STEP)
    null_d = F.lit(None).cast("double")

    def member(rank, metric, label, start, end):
        return F.struct(F.lit(rank).alias("rank"), F.lit(metric).alias("metric"),
                        label.alias("bucket_label"), start.alias("bucket_start"),
                        end.alias("bucket_end"))

    m = F.explode(F.array(
        member(0, METRICS[0], range_label(t0, TEMP_STEP, " C"), t0, t0 + TEMP_STEP),
        member(1, METRICS[1], range_label(w0, WIND_STEP, " m/s"), w0, w0 + WIND_STEP),
        member(2, METRICS[2], visibility_level("visibility_meters"), null_d, null_d)))
    return base.select(m.alias("m"), "departure_delay_mins", *columns)


def weather_impact(correlation: DataFrame) -> DataFrame:
    """A2: mean delay and count by temperature band (5 C), wind band (2 m/s)
    and visibility level, stacked.  One pass: each row is exploded into its
    three (metric, bucket) memberships, then a single aggregation."""
    exploded = impact_members(correlation)
    return (exploded.groupBy("m.rank", "m.metric", "m.bucket_label", "m.bucket_start",
                             "m.bucket_end")
                    .agg(round2(F.avg("departure_delay_mins")).alias("avg_departure_delay_mins"),
                         F.count(F.lit(1)).alias("flight_count"))
                    .orderBy("rank", F.asc_nulls_first("bucket_start"), "bucket_label")
                    .drop("rank"))


def hourly_traffic(schedules: DataFrame) -> DataFrame:
    """A3: departures per UTC hour."""
    return (schedules.groupBy(hour_utc("scheduled_departure_utc").alias("departure_hour_utc"))
                     .agg(F.count(F.lit(1)).alias("flight_count"))
                     .orderBy("departure_hour_utc"))


def active_routes(schedules: DataFrame, airports: DataFrame,
                  origin: str = ORIGIN_AIRPORT,
                  airports_order: list[str] | None = None) -> DataFrame:
    """A5: departures from ``origin`` whose both airports have coordinates,
    grouped by route: count and last scheduled departure."""
    dim = keep_last(airports, ["iata_code"], list(airports_order or dictionary_order(airports)))
    dep = airport_columns(dim, "departure_airport", "dep", with_name=False)
    arr = airport_columns(dim, "arrival_airport", "arr")
    routes = (schedules.where((F.col("departure_airport") == F.lit(origin))
                              & F.col("arrival_airport").isNotNull())
                       .select("departure_airport", "arrival_airport", "scheduled_departure_utc")
                       .join(dep, "departure_airport", "left")
                       .join(arr, "arrival_airport", "left")
                       .dropna(subset=["dep_lat", "dep_lng", "arr_lat", "arr_lng"]))
    return (routes.groupBy("departure_airport", "arrival_airport", "dep_lat", "dep_lng",
                           "arr_airport_name", "arr_lat", "arr_lng")
                  .agg(F.count(F.lit(1)).alias("flight_count"),
                       F.max("scheduled_departure_utc").alias("last_scheduled_departure_utc"))
                  .orderBy(F.desc_nulls_first("flight_count"), F.asc("arrival_airport")))


def build_gold_datasets(schedules: DataFrame, flights: DataFrame, weather: DataFrame,
                        airlines: DataFrame | None, airports: DataFrame | None,
                        flight_tolerance: timedelta = FLIGHT_SCHEDULE_MATCH_TOLERANCE,
                        weather_tolerance: timedelta = WEATHER_MATCH_TOLERANCE,
                        origin: str = ORIGIN_AIRPORT,
                        facts: DataFrame | None = None,
                        correlation: DataFrame | None = None) -> dict[str, DataFrame]:
    """The five gold tables.  The facts and the correlation feed two each;
    pass checkpointed ones to compute them once."""
    spark = schedules.sparkSession
    if facts is None:
        facts = schedule_flight_facts(schedules, flights, flight_tolerance)
    corr = correlation if correlation is not None else weather_correlation(facts, weather, weather_tolerance)
    routes = active_routes(schedules, airports, origin) if airports is not None \
        else spark.createDataFrame([], S.ACTIVE_ROUTES)
    return {
        "weather_correlation": corr,
        "airline_performance": airline_performance(facts, airlines),
        "weather_impact": weather_impact(corr),
        "hourly_traffic": hourly_traffic(schedules),
        "active_routes": routes,
    }
