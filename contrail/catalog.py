"""Registered queries: one per operator of the survey's inventory.

Every query reads the driver tables (through the role analogues of
:mod:`contrail.plans.analogues`) over their whole extent; ``SQL`` holds the
DuckDB oracle of each query that has one.  Column names match between the
two so results can be compared by name.
"""

from __future__ import annotations

from datetime import date, datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions import geo, numeric, text, time as tm
from contrail.operators import align, dedup, filters, ordering, tracks as trk
from contrail.plans import analogues as A
from contrail.plans import dashboard as D
from contrail.plans import gold as G
from contrail.plans import silver as SV
from contrail.plans import tracks as TR
from contrail.sources import raw as RAW
from contrail.sources import tables as TB
from contrail.sources import versions as VS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None, ctes: bool = True, extra: str = "",
             recursive: bool = False):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = A.with_ctes(sql, extra, recursive) if ctes else sql.strip()
        return fn
    return deco


# Fixed query parameters (dates fall inside the driver's events range).
RANGE_START, RANGE_END = date(2024, 1, 10), date(2024, 1, 20)
ONE_DAY = date(2024, 1, 15)
WARSAW = "Europe/Warsaw"


def _local_date_sql(col: str) -> str:
    return f"CAST(timezone('{WARSAW}', {col} AT TIME ZONE 'UTC') AS DATE)"


def _ts_sql(col: str) -> str:
    return f"make_timestamp(epoch_us({col}))"


def hav_sql(a, b, c, d):
    return (f"6371.0 * 2 * asin(sqrt(pow(sin((radians({c}) - radians({a})) / 2), 2) + "
            f"cos(radians({a})) * cos(radians({c})) * pow(sin((radians({d}) - radians({b})) / 2), 2)))")


def bearing_sql(a, b, c, d):
    x = f"sin(radians({d} - {b})) * cos(radians({c}))"
    y = (f"cos(radians({a})) * sin(radians({c})) - sin(radians({a})) * cos(radians({c})) * "
         f"cos(radians({d} - {b}))")
    return f"((degrees(atan2({x}, {y})) + 360.0) - 360.0 * floor((degrees(atan2({x}, {y})) + 360.0) / 360.0))"


# ======================================================================
# C: composite pipelines (silver / gold)
# ======================================================================

@register("c1_clean_schedules", "SELECT * FROM schedules")
def c1(spark, d):
    return A.schedules(spark, d)


@register("c2_clean_flights", "SELECT * FROM flights")
def c2(spark, d):
    return A.flights(spark, d)


@register("c3_clean_weather", "SELECT * FROM weather")
def c3(spark, d):
    return A.weather(spark, d)


@register("c4_transform_arrivals", "SELECT * FROM arrivals")
def c4(spark, d):
    return A.arrivals(spark, d)


@register("c5_gold_datasets", f"""
SELECT 'weather_correlation' AS dataset, count(*) AS row_count FROM correlation
UNION ALL SELECT 'airline_performance', count(*) FROM (
  SELECT airline_code FROM facts WHERE last_updated_utc IS NOT NULL AND airline_code IS NOT NULL
  GROUP BY airline_code)
UNION ALL SELECT 'weather_impact', count(*) FROM (
  SELECT DISTINCT 't' AS m, floor(temp_celsius / 5) FROM correlation WHERE has_weather_match
  UNION ALL SELECT DISTINCT 'w', floor(wind_speed_mps / 2) FROM correlation WHERE has_weather_match
  UNION ALL SELECT DISTINCT 'v', CASE WHEN visibility_meters < 3000 THEN 0
                                     WHEN visibility_meters < 8000 THEN 1 ELSE 2 END
            FROM correlation WHERE has_weather_match)
UNION ALL SELECT 'hourly_traffic', count(DISTINCT hour(scheduled_departure_utc)) FROM schedules
UNION ALL SELECT 'active_routes', count(*) FROM (
  SELECT DISTINCT arrival_airport FROM schedules s JOIN airports d ON d.iata_code = s.departure_airport
  JOIN airports a ON a.iata_code = s.arrival_airport
  WHERE s.departure_airport = '{A.ORIGIN}' AND d.lat IS NOT NULL AND d.lng IS NOT NULL
    AND a.lat IS NOT NULL AND a.lng IS NOT NULL)
""")
def c5(spark, d):
    sched = A.schedules(spark, d)
    data = G.build_gold_datasets(sched, A.flights(spark, d), A.weather(spark, d),
                                 A.airlines(spark, d), A.airports(spark, d),
                                 weather_tolerance=A.J3_TOLERANCE, origin=A.ORIGIN)
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("dataset"), "row_count") for name, df in data.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ======================================================================
# J: joins
# ======================================================================

@register("j1a_join_departure_airport", """
SELECT flight_code, scheduled_departure_utc, departure_airport, dep_airport_name, dep_lat, dep_lng
FROM schedules""")
def j1a(spark, d):
    return A.schedules(spark, d).select("flight_code", "scheduled_departure_utc",
                                        "departure_airport", "dep_airport_name", "dep_lat", "dep_lng")


@register("j1b_join_arrival_airport", """
SELECT flight_code, scheduled_departure_utc, arrival_airport, arr_airport_name, arr_lat, arr_lng
FROM schedules""")
def j1b(spark, d):
    return A.schedules(spark, d).select("flight_code", "scheduled_departure_utc",
                                        "arrival_airport", "arr_airport_name", "arr_lat", "arr_lng")


@register("j1c_join_airline", """
SELECT flight_code, scheduled_departure_utc, airline_code, airline_name FROM schedules""")
def j1c(spark, d):
    return A.schedules(spark, d).select("flight_code", "scheduled_departure_utc",
                                        "airline_code", "airline_name")


@register("j1d_join_fleet", """
SELECT flight_code, last_updated_utc, reg_number, aircraft_manufacturer, aircraft_model,
       aircraft_built_year, aircraft_age_years FROM flights""")
def j1d(spark, d):
    return A.flights(spark, d).select("flight_code", "last_updated_utc", "reg_number",
                                      "aircraft_manufacturer", "aircraft_model",
                                      "aircraft_built_year", "aircraft_age_years")


@register("j1e_join_dedup_dictionary", """
SELECT flight_code, last_updated_utc, airline_code, airline_name FROM arrivals""")
def j1e(spark, d):
    return A.arrivals(spark, d).select("flight_code", "last_updated_utc", "airline_code",
                                       "airline_name")


@register("j2_asof_nearest_keyed", "SELECT * FROM facts")
def j2(spark, d):
    return A.facts(spark, d)


@register("j3_asof_nearest_unkeyed", "SELECT * EXCLUDE (has_weather_match) FROM correlation")
def j3(spark, d):
    return A.correlation(spark, d).drop("has_weather_match")


@register("j4_match_flag", """
SELECT flight_code, scheduled_departure_utc, last_updated_utc, has_weather_match FROM correlation""")
def j4(spark, d):
    return A.correlation(spark, d).select("flight_code", "scheduled_departure_utc",
                                          "last_updated_utc", "has_weather_match")


# ======================================================================
# A: aggregations
# ======================================================================

@register("a1_airline_performance", """
SELECT f.airline_code, l.name AS airline_name,
       round_even(avg(f.departure_delay_mins), 2) AS avg_departure_delay_mins,
       count(*) AS total_flights
FROM facts f LEFT JOIN airlines l ON l.iata_code = f.airline_code
WHERE f.last_updated_utc IS NOT NULL AND f.airline_code IS NOT NULL
GROUP BY f.airline_code, l.name""")
def a1(spark, d):
    return G.airline_performance(A.facts(spark, d), A.airlines(spark, d))


WEATHER_IMPACT_SQL = """
SELECT metric, bucket_label, bucket_start, bucket_end,
       round_even(avg(departure_delay_mins), 2) AS avg_departure_delay_mins,
       count(*) AS flight_count
FROM (
  SELECT 'temperature_celsius' AS metric, departure_delay_mins,
         CAST(floor(temp_celsius / 5) AS DOUBLE) * 5 AS bucket_start,
         CAST(floor(temp_celsius / 5) AS DOUBLE) * 5 + 5 AS bucket_end,
         CAST(CAST(CAST(floor(temp_celsius / 5) AS DOUBLE) * 5 AS BIGINT) AS VARCHAR) || '-' ||
         CAST(CAST(CAST(floor(temp_celsius / 5) AS DOUBLE) * 5 + 5 AS BIGINT) AS VARCHAR) || ' C'
           AS bucket_label
  FROM correlation WHERE has_weather_match AND departure_delay_mins IS NOT NULL
  UNION ALL
  SELECT 'wind_speed_mps', departure_delay_mins,
         CAST(floor(wind_speed_mps / 2) AS DOUBLE) * 2,
         CAST(floor(wind_speed_mps / 2) AS DOUBLE) * 2 + 2,
         CAST(CAST(CAST(floor(wind_speed_mps / 2) AS DOUBLE) * 2 AS BIGINT) AS VARCHAR) || '-' ||
         CAST(CAST(CAST(floor(wind_speed_mps / 2) AS DOUBLE) * 2 + 2 AS BIGINT) AS VARCHAR) || ' m/s'
  FROM correlation WHERE has_weather_match AND departure_delay_mins IS NOT NULL
  UNION ALL
  SELECT 'visibility_level', departure_delay_mins, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
         CASE WHEN visibility_meters < 3000 THEN 'low' WHEN visibility_meters < 8000 THEN 'medium'
              ELSE 'high' END
  FROM correlation WHERE has_weather_match AND departure_delay_mins IS NOT NULL)
GROUP BY metric, bucket_label, bucket_start, bucket_end"""


@register("a2_weather_impact", WEATHER_IMPACT_SQL)
def a2(spark, d):
    return G.weather_impact(A.correlation(spark, d))


@register("a3_hourly_traffic", """
SELECT CAST(hour(scheduled_departure_utc) AS INTEGER) AS departure_hour_utc, count(*) AS flight_count
FROM schedules GROUP BY 1""")
def a3(spark, d):
    return G.hourly_traffic(A.schedules(spark, d))


@register("a4_delays_by_hour", """
SELECT CAST(hour(scheduled_departure_utc) AS INTEGER) AS departure_hour_utc,
       round_even(avg(departure_delay_mins), 2) AS avg_delay_mins, count(*) AS flight_count
FROM schedules GROUP BY 1""")
def a4(spark, d):
    return D.delays_by_hour(A.schedules(spark, d))


ACTIVE_ROUTES_SQL = f"""
SELECT s.departure_airport, s.arrival_airport, d.lat AS dep_lat, d.lng AS dep_lng,
       a.name AS arr_airport_name, a.lat AS arr_lat, a.lng AS arr_lng,
       count(*) AS flight_count, max(s.scheduled_departure_utc) AS last_scheduled_departure_utc
FROM schedules s
LEFT JOIN airports d ON d.iata_code = s.departure_airport
LEFT JOIN airports a ON a.iata_code = s.arrival_airport
WHERE s.departure_airport = '{A.ORIGIN}' AND s.arrival_airport IS NOT NULL
  AND d.lat IS NOT NULL AND d.lng IS NOT NULL AND a.lat IS NOT NULL AND a.lng IS NOT NULL
GROUP BY ALL"""


@register("a5_active_routes", ACTIVE_ROUTES_SQL)
def a5(spark, d):
    return G.active_routes(A.schedules(spark, d), A.airports(spark, d), origin=A.ORIGIN)


@register("a6_weekday_patterns", """
SELECT weekday, CAST(sum(daily_count) AS BIGINT) AS flight_count,
       avg(daily_count) AS avg_flights_per_day, direction,
       CASE weekday WHEN 1 THEN 'Poniedziałek' WHEN 2 THEN 'Wtorek' WHEN 3 THEN 'Środa'
         WHEN 4 THEN 'Czwartek' WHEN 5 THEN 'Piątek' WHEN 6 THEN 'Sobota'
         WHEN 7 THEN 'Niedziela' ELSE 'Nieznany' END AS weekday_label
FROM (
  SELECT CAST(isodow(scheduled_departure_utc) AS INTEGER) AS weekday,
         CAST(scheduled_departure_utc AS DATE) AS flight_date, count(*) AS daily_count,
         'Z Krakowa' AS direction FROM schedules GROUP BY 1, 2
  UNION ALL
  SELECT CAST(isodow(last_updated_utc) AS INTEGER), CAST(last_updated_utc AS DATE), count(*),
         'Do Krakowa' FROM arrivals GROUP BY 1, 2)
GROUP BY weekday, direction""")
def a6(spark, d):
    return D.weekday_patterns(A.schedules(spark, d), A.arrivals(spark, d))


@register("a7_position_buckets", """
SELECT flight_code, time_bucket, lat, lng, last_updated_utc, heading_deg,
       strftime(time_bucket, '%Y-%m-%d %H:%M') AS time_label
FROM (
  SELECT *, make_timestamp((epoch_us(last_updated_utc) // 900000000) * 900000000) AS time_bucket,
         row_number() OVER (PARTITION BY flight_code,
                              make_timestamp((epoch_us(last_updated_utc) // 900000000) * 900000000)
                            ORDER BY last_updated_utc DESC, lat DESC, lng DESC) AS rn
  FROM flights WHERE lat IS NOT NULL AND lng IS NOT NULL AND last_updated_utc IS NOT NULL)
WHERE rn = 1""")
def a7(spark, d):
    f = A.flights(spark, d).select("flight_code", "lat", "lng", "last_updated_utc", "heading_deg")
    return trk.bucket_positions(f, 15)


@register("a8_dashboard_kpis", f"""
SELECT (SELECT count(*) FROM schedules
        WHERE {_local_date_sql('scheduled_departure_utc')} BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}') AS departures,
       (SELECT count(*) FROM arrivals
        WHERE {_local_date_sql('last_updated_utc')} BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}') AS arrivals,
       (SELECT round(coalesce(avg(departure_delay_mins), 0.0), 9) FROM schedules
        WHERE {_local_date_sql('scheduled_departure_utc')} BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}') AS avg_delay_mins,
       (SELECT count(DISTINCT arrival_airport) + coalesce(max(CASE WHEN arrival_airport IS NULL THEN 1 ELSE 0 END), 0)
        FROM schedules
        WHERE {_local_date_sql('scheduled_departure_utc')} BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}') AS active_routes
""")
def a8(spark, d):
    s = filters.filter_local_date_range(A.schedules(spark, d), "scheduled_departure_utc",
                                        RANGE_START, RANGE_END)
    a = filters.filter_local_date_range(A.arrivals(spark, d), "last_updated_utc",
                                        RANGE_START, RANGE_END)
    return D.kpis(s, a).select("departures", "arrivals",
                               F.round(F.col("avg_delay_mins"), 9).alias("avg_delay_mins"),
                               "active_routes")


@register("a10_max_and_counts", """
SELECT 'schedules' AS dataset, count(*) AS row_count, max(scheduled_departure_utc) AS newest FROM schedules
UNION ALL SELECT 'flights', count(*), max(last_updated_utc) FROM flights
UNION ALL SELECT 'arrivals', count(*), max(last_updated_utc) FROM arrivals
UNION ALL SELECT 'weather', count(*), max(observation_time_utc) FROM weather""")
def a10(spark, d):
    parts = [
        ("schedules", A.schedules(spark, d), "scheduled_departure_utc"),
        ("flights", A.flights(spark, d), "last_updated_utc"),
        ("arrivals", A.arrivals(spark, d), "last_updated_utc"),
        ("weather", A.weather(spark, d), "observation_time_utc"),
    ]
    out = None
    for name, df, ts in parts:
        one = df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("row_count"),
                     F.max(ts).alias("newest"))
        out = one if out is None else out.unionByName(one)
    return out


# ======================================================================
# W: window-like operators and tracks
# ======================================================================

@register("w1_dedup_keep_last", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def w1(spark, d):
    return dedup.keep_last(A.table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@register("w2_dedup_keep_any", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) AS rn
  FROM customer) WHERE rn = 1""")
def w2(spark, d):
    return dedup.keep_any(A.table(spark, d, "customer"), ["c_nationkey"])


_GAP_SQL = """
SELECT event_id, user_id, ts,
       coalesce(CAST(date_sub('hour', lag(ts) OVER (PARTITION BY user_id ORDER BY ts), ts) AS DOUBLE), 0.0)
         AS gap_hours
FROM events"""


@register("w3_gap_hours", _GAP_SQL)
def w3(spark, d):
    ev = A.table(spark, d, "events").select("event_id", "user_id", "ts")
    return trk.gap_hours(ev, ["user_id"], "ts").select("event_id", "user_id", "ts", "gap_hours")


@register("w4_sessionize", f"""
SELECT event_id, user_id, ts, gap_hours,
       CAST(sum(CASE WHEN gap_hours > 15 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS segment_id
FROM ({_GAP_SQL})""")
def w4(spark, d):
    ev = A.table(spark, d, "events").select("event_id", "user_id", "ts")
    return trk.with_segments(ev, ["user_id"], "ts", 15.0).select(
        "event_id", "user_id", "ts", "gap_hours", "segment_id")


@register("w5_latest_segment", f"""
SELECT g.event_id, g.user_id, g.ts FROM (
  SELECT *, CASE WHEN prev_ts IS NULL OR date_sub('hour', prev_ts, ts) > 15 THEN ts END AS start_ts
  FROM (SELECT event_id, user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev_ts
        FROM events)) g
JOIN (SELECT user_id, max(start_ts) AS latest FROM (
        SELECT user_id, ts, CASE WHEN prev_ts IS NULL OR date_sub('hour', prev_ts, ts) > 15 THEN ts END AS start_ts
        FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev_ts FROM events))
      GROUP BY user_id) m ON m.user_id = g.user_id
WHERE g.ts >= m.latest""")
def w5(spark, d):
    ev = A.table(spark, d, "events").select("event_id", "user_id", "ts")
    return trk.latest_segment(ev, ["user_id"], "ts", 15.0)


def _track_ctes(src: str, p: str, label: str) -> str:
    """SQL of the track pipeline (C6) over positions CTE ``src``."""
    hav = hav_sql("w.klat", "w.klng", "o.lat", "o.lng")
    return f"""
{p}_pts AS (
  SELECT flight_code, lat, lng, last_updated_utc, heading_deg, upper(flight_code) AS track
  FROM {src}
  WHERE lat IS NOT NULL AND lng IS NOT NULL AND last_updated_utc IS NOT NULL
    AND (abs(lat) > 0.01 OR abs(lng) > 0.01) AND lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180),
{p}_seg AS (
  SELECT *, CASE WHEN prev_t IS NULL OR date_sub('hour', prev_t, last_updated_utc) > 15
                 THEN last_updated_utc END AS start_t
  FROM (SELECT *, lag(last_updated_utc) OVER (PARTITION BY track
          ORDER BY last_updated_utc, flight_code, lat, lng) AS prev_t FROM {p}_pts)),
{p}_latest AS (
  SELECT s.* EXCLUDE (prev_t, start_t) FROM {p}_seg s
  JOIN (SELECT track, max(start_t) AS ls FROM {p}_seg GROUP BY track) m ON m.track = s.track
  WHERE s.last_updated_utc >= m.ls),
{p}_ord AS (
  SELECT *, row_number() OVER (PARTITION BY track ORDER BY last_updated_utc, flight_code, lat, lng) AS rn
  FROM {p}_latest),
{p}_walk(track, rn, klat, klng, kept) AS (
  SELECT track, rn, lat, lng, true FROM {p}_ord WHERE rn = 1
  UNION ALL
  SELECT o.track, o.rn,
         CASE WHEN {hav} <= 400.0 THEN o.lat ELSE w.klat END,
         CASE WHEN {hav} <= 400.0 THEN o.lng ELSE w.klng END,
         {hav} <= 400.0
  FROM {p}_walk w JOIN {p}_ord o ON o.track = w.track AND o.rn = w.rn + 1),
{p}_kept AS (
  SELECT o.* EXCLUDE (rn) FROM {p}_ord o JOIN {p}_walk w ON w.track = o.track AND w.rn = o.rn
  WHERE w.kept),
{p}_track AS (
  SELECT flight_code, time_bucket, lat, lng, last_updated_utc, '{label}' AS flight_type, heading_deg,
         strftime(time_bucket, '%Y-%m-%d %H:%M') AS time_label, upper(flight_code) AS track
  FROM (SELECT *, make_timestamp((epoch_us(last_updated_utc) // 900000000) * 900000000) AS time_bucket,
          row_number() OVER (PARTITION BY flight_code,
                               (epoch_us(last_updated_utc) // 900000000)
                             ORDER BY last_updated_utc DESC, lat DESC, lng DESC) AS brn
        FROM {p}_kept) WHERE brn = 1)"""


DEP_TRACK = _track_ctes("flights", "dep", TR.DEPARTURE_LABEL)
ARR_TRACK = _track_ctes("(SELECT *, CAST(NULL AS DOUBLE) AS heading_deg FROM arrivals)", "arr",
                        TR.ARRIVAL_LABEL)


@register("w6_jump_filter",
          "SELECT flight_code, lat, lng, last_updated_utc, heading_deg, track FROM dep_kept",
          extra=DEP_TRACK, recursive=True)
def w6(spark, d):
    return TR.track_points(A.flights(spark, d))


@register("w6_jump_filter_ranges",
          "SELECT flight_code, lat, lng, last_updated_utc, heading_deg, track FROM dep_kept",
          extra=DEP_TRACK, recursive=True)
def w6_ranges(spark, d):
    """The same over five ranges, which cut tracks."""
    return TR.track_points(A.flights(spark, d), chunks=5)


@register("w7_bearing", f"""
SELECT *, round(CASE
  WHEN lag(lat) OVER w IS NOT NULL THEN {bearing_sql('lag(lat) OVER w', 'lag(lng) OVER w', 'lat', 'lng')}
  WHEN lead(lat) OVER w IS NOT NULL THEN {bearing_sql('lat', 'lng', 'lead(lat) OVER w', 'lead(lng) OVER w')}
  ELSE 0.0 END, 9) AS bearing
FROM dep_track WINDOW w AS (PARTITION BY track ORDER BY time_bucket, flight_code)""",
          extra=DEP_TRACK, recursive=True)
def w7(spark, d):
    pts = TR.path_points(TR.flight_tracks(A.flights(spark, d), TR.DEPARTURE_LABEL))
    return pts.withColumn("bearing", F.round("bearing", 9))


@register("c6_flight_track", "SELECT * FROM dep_track", extra=DEP_TRACK, recursive=True)
def c6(spark, d):
    return TR.flight_tracks(A.flights(spark, d), TR.DEPARTURE_LABEL)


@register("c7_pick_flight_track", """
SELECT * EXCLUDE (side) FROM (
  SELECT *, 1 AS side FROM dep_track UNION ALL SELECT *, 0 AS side FROM arr_track) t
WHERE side = (
  SELECT arg_max(side, newest * 10 + side) FROM (
    SELECT track, side, epoch_us(max(last_updated_utc)) AS newest FROM (
      SELECT track, last_updated_utc, 1 AS side FROM dep_track
      UNION ALL SELECT track, last_updated_utc, 0 AS side FROM arr_track) GROUP BY track, side) n
  WHERE n.track = t.track)""", extra=DEP_TRACK + "," + ARR_TRACK, recursive=True)
def c7(spark, d):
    return TR.pick_flight_tracks(A.flights(spark, d), A.arrivals(spark, d))


@register("c11_path_points", f"""
SELECT track, flight_code, time_bucket, lat, lng, time_label, round(CASE
  WHEN lag(lat) OVER w IS NOT NULL THEN {bearing_sql('lag(lat) OVER w', 'lag(lng) OVER w', 'lat', 'lng')}
  WHEN lead(lat) OVER w IS NOT NULL THEN {bearing_sql('lat', 'lng', 'lead(lat) OVER w', 'lead(lng) OVER w')}
  ELSE 0.0 END, 9) AS bearing
FROM arr_track WINDOW w AS (PARTITION BY track ORDER BY time_bucket, flight_code)""",
          extra=ARR_TRACK, recursive=True)
def c11(spark, d):
    pts = TR.path_points(TR.flight_tracks(A.arrivals(spark, d), TR.ARRIVAL_LABEL))
    return pts.select("track", "flight_code", "time_bucket", "lat", "lng", "time_label",
                      F.round("bearing", 9).alias("bearing"))


@register("a9_track_bounds", f"""
SELECT track,
  least(min(lat), {TR.AIRPORT_LAT}) - greatest((greatest(max(lat), {TR.AIRPORT_LAT}) - least(min(lat), {TR.AIRPORT_LAT})) * 0.15, 0.08) AS south,
  least(min(lng), {TR.AIRPORT_LNG}) - greatest((greatest(max(lng), {TR.AIRPORT_LNG}) - least(min(lng), {TR.AIRPORT_LNG})) * 0.15, 0.08) AS west,
  greatest(max(lat), {TR.AIRPORT_LAT}) + greatest((greatest(max(lat), {TR.AIRPORT_LAT}) - least(min(lat), {TR.AIRPORT_LAT})) * 0.15, 0.08) AS north,
  greatest(max(lng), {TR.AIRPORT_LNG}) + greatest((greatest(max(lng), {TR.AIRPORT_LNG}) - least(min(lng), {TR.AIRPORT_LNG})) * 0.15, 0.08) AS east
FROM dep_track GROUP BY track""", extra=DEP_TRACK, recursive=True)
def a9(spark, d):
    return TR.tracks_bounds(TR.flight_tracks(A.flights(spark, d), TR.DEPARTURE_LABEL))


# ======================================================================
# F: filters
# ======================================================================

@register("f1_local_date_range", f"""
SELECT flight_code, scheduled_departure_utc FROM schedules
WHERE {_local_date_sql('scheduled_departure_utc')} BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'""")
def f1(spark, d):
    return filters.filter_local_date_range(A.schedules(spark, d), "scheduled_departure_utc",
                                           RANGE_START, RANGE_END) \
        .select("flight_code", "scheduled_departure_utc")


@register("f2_single_local_day", f"""
SELECT flight_code, last_updated_utc FROM arrivals
WHERE {_local_date_sql('last_updated_utc')} = DATE '{ONE_DAY}'""")
def f2(spark, d):
    return filters.filter_local_day(A.arrivals(spark, d), "last_updated_utc", ONE_DAY) \
        .select("flight_code", "last_updated_utc")


@register("f3_contains_ci", """
SELECT p_partkey, p_name FROM part WHERE contains(lower(CAST(p_name AS VARCHAR)), 'ring')""")
def f3(spark, d):
    return filters.filter_text(A.table(spark, d, "part"), "p_name", "RiNg").select("p_partkey", "p_name")


@register("f4_code_or_name_contains", """
SELECT flight_code, scheduled_departure_utc, arrival_airport, arr_airport_name FROM schedules
WHERE contains(lower(arrival_airport), 'ion_1') OR contains(lower(arr_airport_name), 'ion_1')""")
def f4(spark, d):
    return filters.filter_code_or_name(A.schedules(spark, d), "arrival_airport",
                                       "arr_airport_name", "ION_1") \
        .select("flight_code", "scheduled_departure_utc", "arrival_airport", "arr_airport_name")


@register("f5_valid_coordinate", """
SELECT flight_code, last_updated_utc, lat, lng FROM flights
WHERE (abs(lat) > 0.01 OR abs(lng) > 0.01) AND lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180""")
def f5(spark, d):
    return filters.filter_valid_coordinates(A.flights(spark, d)) \
        .select("flight_code", "last_updated_utc", "lat", "lng")


@register("f6_code_match", """
SELECT flight_code, last_updated_utc FROM arrivals WHERE upper(flight_code) = 'FL7'""")
def f6(spark, d):
    return filters.filter_flight_code(A.arrivals(spark, d), "  fl7 ") \
        .select("flight_code", "last_updated_utc")


@register("f7_drop_nulls_subset", """
SELECT flight_code, scheduled_departure_utc, departure_airport, arrival_airport, ingest_order
FROM sched_typed""")
def f7(spark, d):
    raw = A.raw_schedules(spark, d).select(
        F.col("flight_iata").alias("flight_code"),
        tm.epoch_seconds_to_ts("dep_time_ts").alias("scheduled_departure_utc"),
        F.col("dep_iata").alias("departure_airport"), F.col("arr_iata").alias("arrival_airport"),
        "ingest_order")
    return filters.drop_null_keys(raw, ["flight_code", "departure_airport", "arrival_airport"])


@register("f8_conjunction_filters", """
SELECT flight_code, scheduled_departure_utc, airline_code FROM facts
WHERE last_updated_utc IS NOT NULL AND airline_code IS NOT NULL""")
def f8(spark, d):
    return A.facts(spark, d).where(F.col("last_updated_utc").isNotNull()
                                   & F.col("airline_code").isNotNull()) \
        .select("flight_code", "scheduled_departure_utc", "airline_code")


# ======================================================================
# O: sorts and top-k (order is part of the result, the oracle checks rows)
# ======================================================================

@register("o1_mixed_direction_sort", f"""
SELECT *, row_number() OVER (ORDER BY flight_count DESC, arrival_airport) AS place
FROM ({ACTIVE_ROUTES_SQL})""")
def o1(spark, d):
    return ordering.with_row_number(
        G.active_routes(A.schedules(spark, d), A.airports(spark, d), origin=A.ORIGIN), "place")


@register("o2_ascending_sort", """
SELECT departure_hour_utc, flight_count, row_number() OVER (ORDER BY departure_hour_utc) AS place FROM (
  SELECT CAST(hour(scheduled_departure_utc) AS INTEGER) AS departure_hour_utc, count(*) AS flight_count
  FROM schedules GROUP BY 1)""")
def o2(spark, d):
    return ordering.with_row_number(G.hourly_traffic(A.schedules(spark, d)), "place")


O3_COLUMNS = ", ".join(D.DEPARTURE_COLUMNS)
O3_TIES = ", ".join(f"{c} NULLS FIRST" for c in D.DEPARTURE_COLUMNS if c != "scheduled_departure_utc")


@register("o3_newest_first", f"""
SELECT {O3_COLUMNS}, row_number() OVER (ORDER BY scheduled_departure_utc DESC NULLS FIRST, {O3_TIES}) AS place
FROM schedules""")
def o3(spark, d):
    # flights of one time stand in any order in the table; the places here need one
    table = D.departures_table(A.schedules(spark, d))
    ties = [F.col(c).asc_nulls_first() for c in D.DEPARTURE_COLUMNS if c != "scheduled_departure_utc"]
    return ordering.with_row_number(
        table.orderBy(F.col("scheduled_departure_utc").desc_nulls_first(), *ties), "place")


@register("o4_top10_destinations", f"""
SELECT * FROM ({ACTIVE_ROUTES_SQL}) ORDER BY flight_count DESC, arrival_airport LIMIT 10""")
def o4(spark, d):
    return D.top_k(G.active_routes(A.schedules(spark, d), A.airports(spark, d), origin=A.ORIGIN),
                   10, "flight_count", "arrival_airport")


@register("o5_top15_airlines", """
SELECT * FROM (
  SELECT f.airline_code, l.name AS airline_name,
         round_even(avg(f.departure_delay_mins), 2) AS avg_departure_delay_mins,
         count(*) AS total_flights
  FROM facts f LEFT JOIN airlines l ON l.iata_code = f.airline_code
  WHERE f.last_updated_utc IS NOT NULL AND f.airline_code IS NOT NULL
  GROUP BY f.airline_code, l.name)
ORDER BY total_flights DESC, airline_code LIMIT 15""")
def o5(spark, d):
    return D.top_k(G.airline_performance(A.facts(spark, d), A.airlines(spark, d)),
                   15, "total_flights", "airline_code")


@register("o6_head_zero", "SELECT * FROM schedules LIMIT 0")
def o6(spark, d):
    return A.schedules(spark, d).limit(0)


# ======================================================================
# U: set operations
# ======================================================================

@register("u1_concat_same_schema", """
SELECT flight_code, scheduled_departure_utc AS ts, 'Z Krakowa' AS direction FROM schedules
UNION ALL SELECT flight_code, last_updated_utc, 'Do Krakowa' FROM arrivals""")
def u1(spark, d):
    s = A.schedules(spark, d).select("flight_code", F.col("scheduled_departure_utc").alias("ts"),
                                     F.lit(D.DEPARTURES_DIRECTION).alias("direction"))
    a = A.arrivals(spark, d).select("flight_code", F.col("last_updated_utc").alias("ts"),
                                    F.lit(D.ARRIVALS_DIRECTION).alias("direction"))
    return s.unionByName(a)


@register("u2_concat_frames", """
SELECT event_id, ts, user_id, CAST(value AS VARCHAR) AS value FROM events""")
def u2(spark, d):
    ev = A.table(spark, d, "events").select("event_id", "ts", "user_id", "value", "event_type")
    a = ev.where(F.col("event_type") == "purchase").drop("event_type")
    b = ev.where(F.col("event_type") != "purchase").drop("event_type") \
        .withColumn("value", F.col("value").cast("string"))
    return align.concat_frames([a, b])


@register("u3_schema_aligned_union", """
SELECT CAST(c_custkey AS DOUBLE) AS k, c_name AS name, CAST(NULL AS INTEGER) AS region FROM customer
UNION ALL
SELECT CAST(n_nationkey AS DOUBLE), n_name, n_regionkey FROM nation""")
def u3(spark, d):
    c = A.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    n = A.table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"),
                                           F.col("n_regionkey").alias("region"))
    return align.align_union([c, n])


# ======================================================================
# X: scalar functions
# ======================================================================

def _events(spark, d):
    return A.table(spark, d, "events")


@register("x1_time_parts", """
SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS epoch_s,
       CAST(hour(ts) AS INTEGER) AS hour_utc, CAST(isodow(ts) AS INTEGER) AS weekday,
       CAST(ts AS DATE) AS day_utc, CAST(year(ts) AS INTEGER) AS y,
       CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d
FROM events""")
def x1(spark, d):
    return _events(spark, d).select(
        "event_id", tm.epoch_seconds("ts").alias("epoch_s"), tm.hour_utc("ts").alias("hour_utc"),
        tm.iso_weekday("ts").alias("weekday"), F.to_date("ts").alias("day_utc"),
        F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofmonth("ts").alias("d"))


@register("x2_truncate_format", """
SELECT event_id, make_timestamp((epoch_us(ts) // 900000000) * 900000000) AS time_bucket,
       strftime(make_timestamp((epoch_us(ts) // 900000000) * 900000000), '%Y-%m-%d %H:%M') AS time_label
FROM events""")
def x2(spark, d):
    b = tm.truncate_minutes("ts", 15)
    return _events(spark, d).select("event_id", b.alias("time_bucket"),
                                    tm.minute_label(b).alias("time_label"))


@register("x3_bearing", f"""
SELECT flight_code, last_updated_utc,
       round({bearing_sql(str(TR.AIRPORT_LAT), str(TR.AIRPORT_LNG), 'lat', 'lng')}, 9) AS bearing
FROM flights""")
def x3(spark, d):
    return A.flights(spark, d).select(
        "flight_code", "last_updated_utc",
        F.round(geo.bearing_deg(TR.AIRPORT_LAT, TR.AIRPORT_LNG, "lat", "lng"), 9).alias("bearing"))


@register("x4_haversine", f"""
SELECT flight_code, last_updated_utc,
       round({hav_sql(str(TR.AIRPORT_LAT), str(TR.AIRPORT_LNG), 'lat', 'lng')}, 9) AS distance_km
FROM flights""")
def x4(spark, d):
    return A.flights(spark, d).select(
        "flight_code", "last_updated_utc",
        F.round(geo.haversine_km(TR.AIRPORT_LAT, TR.AIRPORT_LNG, "lat", "lng"), 9).alias("distance_km"))


@register("x5_timezone", f"""
SELECT event_id, timezone('{WARSAW}', ts AT TIME ZONE 'UTC') AS local_ts,
       {_local_date_sql('ts')} AS local_date
FROM events""")
def x5(spark, d):
    return _events(spark, d).select("event_id", tm.to_local("ts", WARSAW).alias("local_ts"),
                                    tm.local_date("ts", WARSAW).alias("local_date"))


@register("x6_floor_bucket", """
SELECT airport_city, observation_time_utc,
       CAST(floor(temp_celsius / 5) AS DOUBLE) * 5 AS temp_bucket,
       CAST(floor(wind_speed_mps / 2) AS DOUBLE) * 2 AS wind_bucket
FROM weather""")
def x6(spark, d):
    return A.weather(spark, d).select(
        "airport_city", "observation_time_utc",
        numeric.floor_step("temp_celsius", 5).alias("temp_bucket"),
        numeric.floor_step("wind_speed_mps", 2).alias("wind_bucket"))


@register("x7_bucket_label", """
SELECT airport_city, observation_time_utc,
       CAST(CAST(CAST(floor(temp_celsius / 5) AS DOUBLE) * 5 AS BIGINT) AS VARCHAR) || '-' ||
       CAST(CAST(CAST(floor(temp_celsius / 5) AS DOUBLE) * 5 + 5 AS BIGINT) AS VARCHAR) || ' C' AS temp_label
FROM weather""")
def x7(spark, d):
    t0 = numeric.floor_step("temp_celsius", 5)
    return A.weather(spark, d).select("airport_city", "observation_time_utc",
                                      numeric.range_label(t0, 5, " C").alias("temp_label"))


@register("x8_case_when", """
SELECT airport_city, observation_time_utc,
       CASE WHEN visibility_meters < 3000 THEN 'low' WHEN visibility_meters < 8000 THEN 'medium'
            ELSE 'high' END AS visibility_level
FROM weather""")
def x8(spark, d):
    return A.weather(spark, d).select("airport_city", "observation_time_utc",
                                      numeric.visibility_level("visibility_meters")
                                      .alias("visibility_level"))


@register("x9_round2", "SELECT event_id, round_even(value / 3, 2) AS v FROM events")
def x9(spark, d):
    return _events(spark, d).select("event_id", numeric.round2(F.col("value") / 3).alias("v"))


@register("x10_basic_aggregates", """
SELECT event_type, round(avg(value), 6) AS mean_value, max(value) AS max_value,
       round(sum(value), 6) AS sum_value, count(*) AS n, count(DISTINCT user_id) AS users,
       arg_max(value, ts) AS last_value
FROM events GROUP BY event_type""")
def x10(spark, d):
    return _events(spark, d).groupBy("event_type").agg(
        F.round(F.avg("value"), 6).alias("mean_value"), F.max("value").alias("max_value"),
        F.round(F.sum("value"), 6).alias("sum_value"), F.count(F.lit(1)).alias("n"),
        F.count_distinct("user_id").alias("users"), F.max_by("value", "ts").alias("last_value"))


@register("x11_string_functions", """
SELECT p_partkey, upper(p_name) AS name_upper, lower(p_brand) AS brand_lower,
       trim('  ' || p_type || ' ') AS type_trimmed,
       contains(lower(p_name), 'bolt') AS has_bolt
FROM part""")
def x11(spark, d):
    return A.table(spark, d, "part").select(
        "p_partkey", F.upper("p_name").alias("name_upper"), F.lower("p_brand").alias("brand_lower"),
        F.trim(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("type_trimmed"),
        text.contains_ci("p_name", "BOLT").alias("has_bolt"))


@register("x12_value_map", """
SELECT event_id,
  CASE CAST(user_id % 9 AS INTEGER) WHEN 1 THEN 'Poniedziałek' WHEN 2 THEN 'Wtorek' WHEN 3 THEN 'Środa'
    WHEN 4 THEN 'Czwartek' WHEN 5 THEN 'Piątek' WHEN 6 THEN 'Sobota' WHEN 7 THEN 'Niedziela'
    ELSE 'Nieznany' END AS label
FROM events""")
def x12(spark, d):
    return _events(spark, d).select(
        "event_id", numeric.value_map((F.col("user_id") % 9).cast("int"), D.WEEKDAY_LABELS,
                                      D.UNKNOWN_LABEL).alias("label"))


@register("x13_null_and_range", """
SELECT flight_code, last_updated_utc, abs(lat - 45.0) AS lat_offset,
       lat BETWEEN 42 AND 46 AS in_band, heading_deg IS NULL AS no_heading,
       coalesce(aircraft_model, 'unknown') AS model
FROM flights""")
def x13(spark, d):
    return A.flights(spark, d).select(
        "flight_code", "last_updated_utc", F.abs(F.col("lat") - 45.0).alias("lat_offset"),
        F.col("lat").between(42, 46).alias("in_band"), F.col("heading_deg").isNull().alias("no_heading"),
        F.coalesce("aircraft_model", F.lit("unknown")).alias("model"))


@register("x14_diff_cumsum_row_index", """
SELECT event_id, value - lag(value) OVER w AS diff,
       round(sum(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS running,
       CAST(row_number() OVER w - 1 AS INTEGER) AS row_index,
       event_type IN ('view', 'click') AS is_position
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def x14(spark, d):
    return ordering.running(_events(spark, d), "user_id", "ts", "event_id", "value").select(
        "event_id", "diff", F.round("running", 6).alias("running"), "row_index",
        F.col("event_type").isin("view", "click").alias("is_position"))


@register("x15_cast_matrix", """
SELECT event_id, CAST(value AS VARCHAR) AS as_text,
       CAST(trunc(value) AS INTEGER) AS as_int, CAST(trunc(value * 100) AS BIGINT) AS as_long,
       CAST(CAST(value AS VARCHAR) AS DOUBLE) AS round_trip,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS some_text,
       CAST(user_id AS DOUBLE) AS as_double
FROM events""")
def x15(spark, d):
    ev = _events(spark, d)
    text = F.concat(F.when(F.col("event_id") % 3 == 0, "n/a ").otherwise(""), F.col("user_id").cast("string"))
    return ev.select(
        "event_id", F.col("value").cast("string").alias("as_text"),
        F.col("value").cast("int").alias("as_int"), (F.col("value") * 100).cast("long").alias("as_long"),
        F.col("value").cast("string").cast("double").alias("round_trip"),
        tm.tolerant_long(text, strict=False).alias("some_text"),
        F.col("user_id").cast("double").alias("as_double"))


# ======================================================================
# P: projections
# ======================================================================

@register("p1_rename_cast_select", """
SELECT name AS airport_city, make_timestamp(CAST(trunc(CAST(dt AS DOUBLE)) AS BIGINT) * 1000000) AS observation_time_utc,
       CAST("main.temp" AS DOUBLE) AS temp_celsius, CAST("main.feels_like" AS DOUBLE) AS feels_like_celsius,
       CAST(trunc(CAST("main.pressure" AS DOUBLE)) AS INTEGER) AS pressure_hpa,
       CAST(trunc(CAST("main.humidity" AS DOUBLE)) AS INTEGER) AS humidity_percent,
       CAST("wind.speed" AS DOUBLE) AS wind_speed_mps,
       CAST(trunc(CAST("clouds.all" AS DOUBLE)) AS INTEGER) AS cloudiness_percent,
       CAST(trunc(CAST(visibility AS DOUBLE)) AS INTEGER) AS visibility_meters
FROM raw_weather""")
def p1(spark, d):
    return SV.project_weather(A.raw_weather(spark, d), order=[])


@register("p2_tolerant_number_cast", """
SELECT event_id, CAST(trunc(CAST(CAST(value AS VARCHAR) AS DOUBLE)) AS INTEGER) AS delay_mins
FROM events""")
def p2(spark, d):
    return _events(spark, d).select("event_id", numeric.tolerant_int(F.col("value").cast("string"))
                                    .alias("delay_mins"))


@register("p3_epoch_to_utc", """
SELECT ingest_order, updated, make_timestamp(updated * 1000000) AS last_updated_utc FROM raw_flights""")
def p3(spark, d):
    return A.raw_flights(spark, d).select("ingest_order", "updated",
                                          tm.epoch_seconds_to_ts("updated").alias("last_updated_utc"))


@register("p4_optional_column", """
SELECT flight_code, last_updated_utc, reg_number, icao_24bit_hex, lat AS live_lat, lng AS live_lng,
       altitude_ft, ground_speed_knt, CAST(NULL AS DOUBLE) AS heading_deg, status AS live_status,
       aircraft_manufacturer, CAST(NULL AS VARCHAR) AS aircraft_model, aircraft_built_year,
       aircraft_age_years
FROM flights""")
def p4(spark, d):
    return G._flight_side(A.flights(spark, d).drop("heading_deg", "aircraft_model"))


@register("p5_null_default", """
SELECT ingest_order, CAST(trunc(coalesce(CAST(arr_delayed AS DOUBLE), 0.0)) AS INTEGER) AS arrival_delay_mins
FROM raw_schedules""")
def p5(spark, d):
    return A.raw_schedules(spark, d).select(
        "ingest_order", numeric.null_default_int("arr_delayed").alias("arrival_delay_mins"))


def _weather_body():
    """A nested weather payload per click event (JSON text)."""
    v = F.format_string("%.2f", F.col("value"))
    return F.concat(
        F.lit('{"cod": '), F.when(F.col("value") > 100, F.lit("404")).otherwise(F.lit("200")),
        F.lit(', "name": "'), F.lit(A.CITY), F.lit('", "dt": '), tm.epoch_seconds("ts").cast("string"),
        F.lit(', "main": {"temp": '), v, F.lit(', "humidity": '), (F.col("event_id") % 100).cast("string"),
        F.lit('}, "wind": {"speed": '), v, F.lit('}, "weather": [{"id": 800}]}'))


_WEATHER_RECORD = T.StructType([
    T.StructField("cod", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("dt", T.LongType()),
    T.StructField("main", T.StructType([T.StructField("temp", T.DoubleType()),
                                        T.StructField("humidity", T.LongType())])),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
    T.StructField("weather", T.ArrayType(T.StructType([T.StructField("id", T.LongType())])))])


@register("p6_flatten_nested", f"""
SELECT event_id, CAST(CASE WHEN value > 100 THEN 404 ELSE 200 END AS BIGINT) AS cod,
       '{A.CITY}' AS name, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS dt,
       CAST(printf('%.2f', value) AS DOUBLE) AS "main.temp",
       CAST(event_id % 100 AS BIGINT) AS "main.humidity",
       CAST(printf('%.2f', value) AS DOUBLE) AS "wind.speed"
FROM events""")
def p6(spark, d):
    ev = _events(spark, d).select("event_id", _weather_body().alias("body"))
    flat = RAW.parse_weather(ev, _WEATHER_RECORD, keep=["event_id"])
    return flat.drop("weather")


@register("p7_ordered_subset", """
SELECT flight_code, airline_name, departure_airport, dep_airport_name, last_updated_utc, status,
       lat, lng FROM arrivals""")
def p7(spark, d):
    return D.visible_columns(A.arrivals(spark, d), D.ARRIVAL_COLUMNS)


@register("p8_display_labels", """
SELECT flight_code AS "Numer lotu", airline_name AS "Linia lotnicza", arrival_airport AS "Kod lotniska",
       arr_airport_name AS "Lotnisko docelowe", scheduled_departure_utc AS "Planowany odlot",
       scheduled_arrival_utc AS "Planowany przylot",
       departure_delay_mins AS "Opóźnienie odlotu (min)",
       arrival_delay_mins AS "Opóźnienie przylotu (min)", status AS "Status"
FROM schedules""")
def p8(spark, d):
    return D.with_labels(D.visible_columns(A.schedules(spark, d), D.DEPARTURE_COLUMNS),
                         D.DEPARTURE_COLUMN_LABELS)


@register("p9_literal_columns", f"""
SELECT flight_code, last_updated_utc, 'Do Krakowa' AS direction, '{TR.ARRIVAL_LABEL}' AS flight_type,
       CAST(NULL AS DOUBLE) AS bucket_start
FROM arrivals""")
def p9(spark, d):
    return A.arrivals(spark, d).select(
        "flight_code", "last_updated_utc", F.lit(D.ARRIVALS_DIRECTION).alias("direction"),
        F.lit(TR.ARRIVAL_LABEL).alias("flight_type"), F.lit(None).cast("double").alias("bucket_start"))


@register("p10_column_drop_replace", """
SELECT f.flight_code, f.scheduled_departure_utc, f.airline_code, l.name AS airline_name
FROM facts f LEFT JOIN airlines l ON l.iata_code = f.airline_code""")
def p10(spark, d):
    from contrail.operators.joins import join_airlines
    f = A.facts(spark, d).select("flight_code", "scheduled_departure_utc", "airline_code",
                                 F.lit("stale").alias("airline_name"))
    return join_airlines(f, A.airlines(spark, d), dedup_order=[], replace=True)


# ======================================================================
# Q: data quality
# ======================================================================

@register("q1_non_empty_check", """
SELECT 'schedules' AS dataset, count(*) AS row_count, count(*) > 0 AS passed FROM schedules
UNION ALL SELECT 'flights', count(*), count(*) > 0 FROM flights
UNION ALL SELECT 'weather', count(*), count(*) > 0 FROM weather""")
def q1(spark, d):
    out = None
    for name, df in (("schedules", A.schedules(spark, d)), ("flights", A.flights(spark, d)),
                     ("weather", A.weather(spark, d))):
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("dataset"), "row_count", (F.col("row_count") > 0).alias("passed"))
        out = one if out is None else out.unionByName(one)
    return out


@register("q2_no_null_key", """
SELECT count(*) AS row_count, count(*) FILTER (WHERE flight_code IS NULL) AS null_keys,
       count(*) > 0 AND count(*) FILTER (WHERE flight_code IS NULL) = 0 AS passed
FROM schedules""")
def q2(spark, d):
    return SV.dq_metrics(A.schedules(spark, d))


@register("q3_row_contract", f"""
SELECT flight_iata AS flight_code, {A._ts('dep_time_ts')} AS scheduled_departure_utc,
       concat_ws(',', CASE WHEN arr_iata IS NULL THEN 'arrival_airport' END) AS violations
FROM raw_schedules WHERE arr_iata IS NULL""")
def q3(spark, d):
    typed = A.raw_schedules(spark, d).select(
        F.col("flight_iata").alias("flight_code"), F.col("status"),
        F.col("dep_iata").alias("departure_airport"), F.col("arr_iata").alias("arrival_airport"),
        tm.epoch_seconds_to_ts("dep_time_ts").alias("scheduled_departure_utc"),
        tm.epoch_seconds_to_ts("arr_time_ts").alias("scheduled_arrival_utc"))
    bad = SV.contract_violations(typed, SV.SCHEDULE_REQUIRED)
    return bad.select("flight_code", "scheduled_departure_utc",
                      F.array_join("violations", ",").alias("violations"))


# ======================================================================
# S: sources and sinks (payload parsing, schema-grouped reads, day lists)
# ======================================================================

_FLIGHT_RECORD = T.StructType([T.StructField("flight_iata", T.StringType()),
                               T.StructField("updated", T.LongType())])


def _payload_bodies(spark, d):
    """One API-like JSON payload per event: purchases carry a two-record
    ``response`` list, views a bare record, errors / signups error bodies,
    clicks weather bodies."""
    ev = _events(spark, d)
    ep = tm.epoch_seconds("ts").cast("string")
    uid = F.col("user_id").cast("string")
    body = (F.when(F.col("event_type") == "purchase", F.concat(
                F.lit('{"response": [{"flight_iata": "FL'), uid, F.lit('", "updated": '), ep,
                F.lit('}, {"flight_iata": "FL'), uid, F.lit('B", "updated": '),
                (tm.epoch_seconds("ts") + 1).cast("string"), F.lit("}]}")))
             .when(F.col("event_type") == "view", F.concat(
                F.lit('{"flight_iata": "FL'), uid, F.lit('", "updated": '), ep, F.lit("}")))
             .when(F.col("event_type") == "error", F.lit('{"error": {"message": "limit reached"}}'))
             .when(F.col("event_type") == "signup", F.lit('{"cod": "month_limit_exceeded"}'))
             .otherwise(_weather_body()))
    kind = F.when(F.col("event_type") == "click", "weather").otherwise("flights")
    return ev.select("event_id", kind.alias("kind"), body.alias("body"))


@register("s1_read_raw_json", """
SELECT event_id, 0 AS record_pos, 'FL' || CAST(user_id AS VARCHAR) AS flight_iata,
       CAST(epoch_us(ts) // 1000000 AS BIGINT) AS updated
FROM events WHERE event_type IN ('purchase', 'view')
UNION ALL
SELECT event_id, 1, 'FL' || CAST(user_id AS VARCHAR) || 'B', CAST(epoch_us(ts) // 1000000 AS BIGINT) + 1
FROM events WHERE event_type = 'purchase'""")
def s1(spark, d):
    b = _payload_bodies(spark, d).where((F.col("kind") == "flights") & RAW.payload_ok("body"))
    return RAW.parse_records(b, _FLIGHT_RECORD, keep=["event_id"])


@register("s2_skip_error_payloads", """
SELECT event_id, CASE WHEN event_type = 'click' THEN 'weather' ELSE 'flights' END AS kind
FROM events WHERE event_type IN ('purchase', 'view') OR (event_type = 'click' AND value <= 100)""")
def s2(spark, d):
    b = _payload_bodies(spark, d)
    ok = F.when(F.col("kind") == "weather", RAW.payload_ok("body", weather=True)) \
          .otherwise(RAW.payload_ok("body"))
    return b.where(ok).select("event_id", "kind")


@register("s3_read_raw_parquet", """
SELECT r_regionkey, r_name, CAST(NULL AS INTEGER) AS n_nationkey, CAST(NULL AS VARCHAR) AS n_name,
       CAST(NULL AS INTEGER) AS n_regionkey FROM region
UNION ALL SELECT NULL, NULL, n_nationkey, n_name, n_regionkey FROM nation""")
def s3(spark, d):
    df = RAW.read_raw_parquet(spark, [f"{d}/region.parquet", f"{d}/nation.parquet"])
    return df.drop(*RAW.FILE_ORDER)


@register("s9_day_list", """
SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE) - 1, CAST(max(ts) AS DATE) + 1,
                                   INTERVAL 1 DAY)) AS DATE) AS day
FROM events""")
def s9(spark, d):
    lo, hi = _events(spark, d).agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    return TB.day_sequence(spark, lo, hi, pad=True)


@register("s11_combined_fleets", "SELECT * FROM fleets")
def s11(spark, d):
    base, fleets = _scratch(spark, "s11"), A.fleets(spark, d)
    carriers = [r[0] for r in fleets.select("manufacturer").distinct().collect()]
    for c in carriers:
        fleets.where(F.col("manufacturer") == c).write.parquet(f"{base}/{c}")
    return RAW.combined_fleets(spark, base, [*carriers, "no such carrier"]).drop(*_RAW_FILE_COLS)


# ======================================================================
# Dashboard tables
# ======================================================================

@register("c10_flight_table", """
SELECT flight_code, airline_name, arrival_airport, arr_airport_name, scheduled_departure_utc,
       scheduled_arrival_utc, departure_delay_mins, arrival_delay_mins, status
FROM schedules
WHERE contains(lower(airline_name), 'a')
  AND (contains(lower(arrival_airport), 'ion_1') OR contains(lower(arr_airport_name), 'ion_1'))""")
def c10(spark, d):
    return D.departures_table(A.schedules(spark, d), airline_filter="A", airport_filter="ION_1")


@register("c12_load_range", f"""
SELECT flight_code, airline_name, departure_airport, dep_airport_name, last_updated_utc, status, lat, lng
FROM arrivals
WHERE {_local_date_sql('last_updated_utc')} BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'""")
def c12(spark, d):
    base = _scratch(spark, "c12")
    TB.write_partitioned(A.schedules(spark, d), "scheduled_departure_utc", f"{base}/silver/schedules")
    TB.write_partitioned(A.flights(spark, d), "last_updated_utc", f"{base}/silver/flights")
    _land_arrivals(spark, d, f"{base}/arrivals")
    for name, fn in (("airports", A.airports), ("airlines", A.airlines)):
        RAW.load_dictionary(spark, f"{base}/dict/{name}", fetch=lambda fn=fn: fn(spark, d))
    tables = D.load_dashboard_tables(spark, f"{base}/silver", f"{base}/arrivals", f"{base}/dict",
                                     RANGE_START, RANGE_END)
    return D.arrivals_table(tables["arrivals"])


def _land_arrivals(spark, d, base):
    """Arrivals as bronze snapshots, one a day in its day's folder, JSON and Parquet in
    turn.  Revisions are of the same day and come later in the file."""
    raw, day = A.raw_arrivals(spark, d), tm.epoch_seconds_to_ts("updated")
    even = F.dayofmonth(day) % 2 == 0
    TB.land_days(raw.where(even), base, day, ["ingest_order"])
    TB.land_days(raw.where(~even), base, day, ["ingest_order"], fmt="json")


# ======================================================================
# R: streaming
# ======================================================================

@register("r2_live_position_buckets", """
SELECT flight_code, time_bucket, lat, lng, heading_deg, last_updated_utc, time_label FROM (
  SELECT flight_code, make_timestamp((epoch_us(last_updated_utc) // 900000000) * 900000000) AS time_bucket,
         lat, lng, heading_deg, last_updated_utc,
         strftime(make_timestamp((epoch_us(last_updated_utc) // 900000000) * 900000000), '%Y-%m-%d %H:%M') AS time_label,
         row_number() OVER (PARTITION BY flight_code, epoch_us(last_updated_utc) // 900000000
                            ORDER BY last_updated_utc DESC, lat DESC, lng DESC, heading_deg DESC) AS rn
  FROM flights_typed WHERE lat IS NOT NULL AND lng IS NOT NULL)
WHERE rn = 1
  AND time_bucket + INTERVAL 15 MINUTE <= (SELECT max(last_updated_utc) FROM flights_typed) - INTERVAL 1 HOUR""")
def r2(spark, d):
    from contrail.streaming.incremental import live_position_buckets, run_to_table
    ev = spark.readStream.schema(A.table(spark, d, "events").schema) \
        .option("pathGlobFilter", "events.parquet").parquet(d) \
        .where(F.col("event_type") == "view")
    raw = A.raw_flights_from(A.with_revisions(ev))
    pos = raw.select(F.col("flight_iata").alias("flight_code"), "lat", "lng",
                     F.col("dir").alias("heading_deg"),
                     tm.epoch_seconds_to_ts("updated").alias("last_updated_utc"))
    return run_to_table(live_position_buckets(pos), "r2")


# ======================================================================
# S (storage round trips), C8, C9, R1, R3: these write into the session's
# shared checkpoint folder and read the result back.
# ======================================================================

def _scratch(spark, name):
    from contrail.session import scratch_path
    return scratch_path(spark, name)


_RAW_FILE_COLS = RAW.FILE_ORDER

_SCHEDULE_RECORD = T.StructType([
    T.StructField("flight_iata", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("dep_iata", T.StringType()), T.StructField("arr_iata", T.StringType()),
    T.StructField("airline_iata", T.StringType()), T.StructField("dep_time_ts", T.LongType()),
    T.StructField("arr_time_ts", T.LongType()), T.StructField("dep_delayed", T.DoubleType()),
    T.StructField("arr_delayed", T.DoubleType()), T.StructField("ingest_order", T.LongType())])


@register("s12_bronze_landing", "SELECT * FROM raw_flights")
def s12(spark, d):
    base = _scratch(spark, "s12")
    TB.land_snapshot(A.raw_flights(spark, d), f"{base}/flights")
    return RAW.read_raw(spark, f"{base}/flights").drop(*_RAW_FILE_COLS)


@register("s13_raw_json_landing", "SELECT * FROM raw_schedules")
def s13(spark, d):
    base = _scratch(spark, "s13")
    TB.land_json(A.raw_schedules(spark, d), f"{base}/schedules")
    return RAW.read_raw(spark, f"{base}/schedules", _SCHEDULE_RECORD).drop(*_RAW_FILE_COLS)


@register("s5_prefix_scan_mixed_formats", """
SELECT * FROM raw_schedules UNION ALL SELECT * FROM raw_schedules""")
def s5(spark, d):
    base = _scratch(spark, "s5")
    raw = A.raw_schedules(spark, d)
    TB.land_snapshot(raw, f"{base}/KRK/parquet")
    TB.land_json(raw, f"{base}/KRK/json")
    return RAW.read_raw(spark, f"{base}/KRK", _SCHEDULE_RECORD).drop(*_RAW_FILE_COLS)


@register("s14_partitioned_write", "SELECT * FROM weather")
def s14(spark, d):
    base = _scratch(spark, "s14")
    TB.write_partitioned(A.weather(spark, d), "observation_time_utc", f"{base}/weather")
    from contrail import schemas as SCH
    return TB.read_silver(spark, f"{base}/weather", SCH.WEATHER)


@register("s6_silver_scan", "SELECT * FROM flights")
def s6(spark, d):
    base = _scratch(spark, "s6")
    TB.write_partitioned(A.flights(spark, d), "last_updated_utc", f"{base}/flights")
    return TB.read_silver(spark, f"{base}/flights")


@register("s7_partition_range_scan", f"""
SELECT * FROM weather
WHERE CAST(observation_time_utc AS DATE) BETWEEN DATE '{RANGE_START}' - 1 AND DATE '{RANGE_END}' + 1""")
def s7(spark, d):
    base = _scratch(spark, "s7")
    TB.write_partitioned(A.weather(spark, d), "observation_time_utc", f"{base}/weather")
    return TB.read_silver_range(spark, f"{base}/weather", RANGE_START, RANGE_END)


@register("s8_raw_range_scan", f"""
SELECT * FROM raw_arrivals
WHERE CAST(make_timestamp(updated * 1000000) AS DATE) BETWEEN DATE '{RANGE_START}' - 1 AND DATE '{RANGE_END}' + 1""")
def s8(spark, d):
    base = _scratch(spark, "s8")
    _land_arrivals(spark, d, base)
    return TB.read_raw_range(spark, base, RANGE_START, RANGE_END).drop(*_RAW_FILE_COLS)


@register("s10_dictionary_scan", "SELECT * FROM airports")
def s10(spark, d):
    path = _scratch(spark, "s10") + "/airports"
    first = RAW.load_dictionary(spark, path, fetch=lambda: A.airports(spark, d))
    again = RAW.load_dictionary(spark, path, fetch=None)  # now served from storage
    assert first is not None and again is not None
    return again.drop(*_RAW_FILE_COLS)


@register("s15_table_write", ACTIVE_ROUTES_SQL)
def s15(spark, d):
    path = _scratch(spark, "s15") + "/active_routes"
    TB.write_table(G.active_routes(A.schedules(spark, d), A.airports(spark, d), origin=A.ORIGIN), path)
    return spark.read.parquet(path)


@register("s14_versioned_days", "SELECT * FROM weather")
def s14_versions(spark, d):
    """Two commits whose days overlap; the second one's replace the first one's."""
    base, table, day = _scratch(spark, "s14v"), A.weather(spark, d), F.to_date("observation_time_utc")
    VS.commit_days(table.where(day <= F.lit(RANGE_END)), "observation_time_utc", base)
    VS.commit_days(table.where(day >= F.lit(RANGE_START)), "observation_time_utc", base)
    return VS.read_version(spark, base)


@register("s7_versioned_range", f"""
SELECT * FROM weather
WHERE CAST(observation_time_utc AS DATE) >= DATE '{RANGE_START}'
  AND CAST(observation_time_utc AS DATE) < DATE '{RANGE_END}'""")
def s7_versions(spark, d):
    base = _scratch(spark, "s7v")
    VS.commit_days(A.weather(spark, d), "observation_time_utc", base)
    start, end = (datetime.combine(day, datetime.min.time()) for day in (RANGE_START, RANGE_END))
    return VS.read_version(spark, base, start=start, end=end)


@register("s15_versioned_table", ACTIVE_ROUTES_SQL)
def s15_versions(spark, d):
    base = _scratch(spark, "s15v")
    VS.commit_table(G.active_routes(A.schedules(spark, d), A.airports(spark, d), origin=A.ORIGIN), base)
    return VS.read_version(spark, base)


@register("s17_named_gold_read", ACTIVE_ROUTES_SQL)
def s17(spark, d):
    base = _scratch(spark, "s17")
    TB.write_table(G.active_routes(A.schedules(spark, d), A.airports(spark, d), origin=A.ORIGIN),
                   f"{base}/active_routes")
    return TB.load_gold(spark, base, "active_routes")


@register("s16_csv_export", """
SELECT flight_code, airline_name, arrival_airport, arr_airport_name, scheduled_departure_utc,
       scheduled_arrival_utc, departure_delay_mins, arrival_delay_mins, status
FROM schedules""")
def s16(spark, d):
    path = _scratch(spark, "s16")
    table = D.departures_table(A.schedules(spark, d))
    TB.write_csv(table, path)
    return (spark.read.schema(table.schema).option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))


def _land_bronze(spark, d):
    from contrail.plans import jobs
    raw_base, dict_base = _scratch(spark, "bronze"), _scratch(spark, "dict")
    # JSON, whose schema is found from the data, beside Parquet
    sched, odd = A.raw_schedules(spark, d), F.col("ingest_order") % 2 == 1
    jobs.land_raw(sched.where(odd), raw_base, f"schedules/{A.ORIGIN}", "json", datetime(2024, 1, 1, 10, 15))
    jobs.land_raw(sched.where(~odd), raw_base, f"schedules/{A.ORIGIN}", "parquet", datetime(2024, 1, 1, 10, 30))
    jobs.land_raw(A.raw_flights(spark, d), raw_base, f"flights/departures/{A.ORIGIN}")
    jobs.land_raw(A.raw_weather(spark, d), raw_base, f"weather/{A.ORIGIN}")
    for name, fn in (("airports", A.airports), ("airlines", A.airlines), ("fleets", A.fleets)):
        RAW.load_dictionary(spark, f"{dict_base}/{name}", fetch=lambda fn=fn: fn(spark, d))
    return raw_base, dict_base


def _run_silver(spark, d):
    from contrail.plans import jobs
    raw_base, dict_base = _land_bronze(spark, d)
    silver = _scratch(spark, "silver")
    jobs.process_silver_layer(spark, raw_base, dict_base, silver, order=["ingest_order"],
                              airport=A.ORIGIN)
    return silver, dict_base


def _silver_table(name):
    def query(spark, d):
        from contrail import schemas as SCH
        silver, _ = _run_silver(spark, d)
        return TB.read_silver(spark, f"{silver}/{name}", getattr(SCH, name.upper()))
    return query


register("c8_process_silver_layer", "SELECT * FROM schedules")(_silver_table("schedules"))
register("c8_silver_flights", "SELECT * FROM flights")(_silver_table("flights"))
register("c8_silver_weather", "SELECT * FROM weather")(_silver_table("weather"))


def _gold_table(name):
    def query(spark, d):
        from contrail.plans import jobs
        silver, dict_base = _run_silver(spark, d)
        gold = _scratch(spark, "gold")
        # the test's tolerance, as the oracle's
        jobs.process_gold_layer(spark, silver, dict_base, gold, origin=A.ORIGIN, weather_tolerance=A.J3_TOLERANCE)
        return spark.read.parquet(f"{gold}/{name}")
    return query


register("c9_process_gold_layer", """
SELECT f.airline_code, l.name AS airline_name,
       round_even(avg(f.departure_delay_mins), 2) AS avg_departure_delay_mins,
       count(*) AS total_flights
FROM facts f LEFT JOIN airlines l ON l.iata_code = f.airline_code
WHERE f.last_updated_utc IS NOT NULL AND f.airline_code IS NOT NULL
GROUP BY f.airline_code, l.name""")(_gold_table("airline_performance"))
register("c9_gold_correlation", "SELECT * FROM correlation")(_gold_table("weather_correlation"))
register("c9_gold_weather_impact", SQL["a2_weather_impact"], ctes=False)(_gold_table("weather_impact"))
register("c9_gold_hourly_traffic", """
SELECT CAST(hour(scheduled_departure_utc) AS INTEGER) AS departure_hour_utc, count(*) AS flight_count
FROM schedules GROUP BY 1""")(_gold_table("hourly_traffic"))
register("c9_gold_active_routes", ACTIVE_ROUTES_SQL)(_gold_table("active_routes"))


def _refreshed_table(name):
    """The gold table after two refreshes: silver up to a day, then the rest of it."""
    def query(spark, d):
        from contrail.plans import refresh
        silver, gold, dicts = _scratch(spark, "silver"), _scratch(spark, "gold"), _scratch(spark, "dict")
        for kind, fn in (("airports", A.airports), ("airlines", A.airlines), ("fleets", A.fleets)):
            RAW.load_dictionary(spark, f"{dicts}/{kind}", fetch=lambda fn=fn: fn(spark, d))
        tables = [(fn(spark, d).checkpoint(), col, f"{silver}/{kind}") for kind, fn, col in (
            ("schedules", A.schedules, "scheduled_departure_utc"), ("flights", A.flights, "last_updated_utc"),
            ("weather", A.weather, "observation_time_utc"))]
        early = F.lit(RANGE_START)
        for part in (lambda day: day <= early, lambda day: day > early):
            for table, col, path in tables:
                TB.write_partitioned(table.where(part(F.to_date(col))), col, path)
            refresh.refresh_gold(spark, silver, dicts, gold, A.ORIGIN, weather_tolerance=A.J3_TOLERANCE)
        return spark.read.parquet(f"{gold}/{name}").drop("on", *TB.PARTITION_COLS)
    return query


register("c9_refresh_gold", SQL["c9_process_gold_layer"], ctes=False)(_refreshed_table("airline_performance"))
register("c9_refresh_correlation", "SELECT * FROM correlation")(_refreshed_table("weather_correlation_by_day"))
register("c9_refresh_weather_impact", SQL["a2_weather_impact"], ctes=False)(_refreshed_table("weather_impact"))
register("c9_refresh_hourly_traffic", SQL["c9_gold_hourly_traffic"], ctes=False)(_refreshed_table("hourly_traffic"))
register("c9_refresh_active_routes", ACTIVE_ROUTES_SQL)(_refreshed_table("active_routes"))


def _streamed_weather(spark, d, versions):
    from contrail.streaming.incremental import incremental_silver
    raw, base, ckpt = _scratch(spark, "r1-raw"), _scratch(spark, "r1-silver"), _scratch(spark, "r1-ckpt")
    seen = A.raw_weather(spark, d)
    later = F.col("ingest_order") >= 1_000_000_000
    # the newer snapshot arrives first, the older one, as JSON, in a later batch
    for part, land, when in ((seen.where(later), TB.land_snapshot, datetime(2024, 3, 2, 12)),
                             (seen.where(~later), TB.land_json, datetime(2024, 3, 1, 12))):
        land(part.drop("ingest_order"), raw, when)
        incremental_silver(spark, raw, None, lambda b: SV.clean_weather(b, ingest=True), base,
                           ["airport_city", "observation_time_utc"], "observation_time_utc",
                           checkpoint=ckpt, weather=True, versions=versions).awaitTermination()
    return base


@register("r1_incremental_silver", "SELECT * FROM weather")
def r1(spark, d):
    from contrail import schemas as SCH
    return TB.read_silver(spark, _streamed_weather(spark, d, False), SCH.WEATHER)


@register("r1_versioned_silver", "SELECT * FROM weather")
def r1_versions(spark, d):
    from contrail import schemas as SCH
    return VS.read_version(spark, _streamed_weather(spark, d, True), SCH.WEATHER)


@register("r3_keep_last_within_watermark", """
SELECT flight_iata, updated, status, ingest_order FROM (
  SELECT *, row_number() OVER (PARTITION BY flight_iata, stay ORDER BY updated DESC, ingest_order DESC) AS rn FROM (
    SELECT *, sum(opens) OVER (PARTITION BY flight_iata ORDER BY updated, ingest_order) AS stay FROM (
      SELECT flight_iata, updated, status, ingest_order, CASE WHEN updated - lag(updated) OVER (
               PARTITION BY flight_iata ORDER BY updated, ingest_order) <= 3600 THEN 0 ELSE 1 END AS opens
      FROM raw_flights WHERE updated IS NOT NULL)))
WHERE rn = 1 AND updated + 3600 <= (SELECT max(updated) FROM raw_flights) - 3600""")
def r3_last(spark, d):
    """The last position of every stay of a flight (positions an hour apart at most)
    that the watermark has passed."""
    from contrail.streaming.incremental import keep_last_within_watermark, run_to_table
    ev = spark.readStream.schema(A.table(spark, d, "events").schema) \
        .option("pathGlobFilter", "events.parquet").parquet(d) \
        .where(F.col("event_type") == "view")
    pos = A.raw_flights_from(A.with_revisions(ev)).select(
        "flight_iata", "updated", "status", "ingest_order", tm.epoch_seconds_to_ts("updated").alias("ts"))
    return run_to_table(keep_last_within_watermark(pos, ["flight_iata"], "ts", ["ts", "ingest_order"]),
                        "r3-last").drop("ts")


@register("r3_dedup_within_watermark", """
SELECT DISTINCT flight_iata, updated FROM raw_flights""")
def r3(spark, d):
    from contrail.streaming.incremental import dedup_first_within_watermark, run_to_table
    ev = spark.readStream.schema(A.table(spark, d, "events").schema) \
        .option("pathGlobFilter", "events.parquet").parquet(d) \
        .where(F.col("event_type") == "view")
    pos = A.raw_flights_from(A.with_revisions(ev)).select("flight_iata", "updated",
                                        tm.epoch_seconds_to_ts("updated").alias("ts"))
    return run_to_table(dedup_first_within_watermark(pos, ["flight_iata", "updated"], "ts"),
                        "r3").select("flight_iata", "updated")


@register("s4_format_dispatch", "SELECT * FROM raw_flights UNION ALL SELECT * FROM raw_flights")
def s4(spark, d):
    base = _scratch(spark, "s4")
    raw = A.raw_flights(spark, d)
    TB.land_snapshot(raw, f"{base}/snap/a")          # .parquet -> Parquet reader
    TB.land_json(raw, f"{base}/snap/b")              # .json    -> JSON reader
    raw.select(F.col("flight_iata")).write.text(f"{base}/snap/c")  # .txt -> ignored
    rec = T.StructType([raw.schema[c] for c in raw.columns])
    return RAW.read_raw(spark, f"{base}/snap", rec).drop(*_RAW_FILE_COLS)


@register("q4_argument_checks", """
SELECT flight_code, scheduled_departure_utc FROM schedules WHERE false""")
def q4(spark, d):
    """Inverted date range -> no rows (schema kept); unknown gold name -> ValueError."""
    try:
        TB.load_gold(spark, _scratch(spark, "q4"), "hourly_traffic")
        raise AssertionError("unknown gold dataset accepted")
    except ValueError:
        pass
    return filters.filter_local_date_range(A.schedules(spark, d), "scheduled_departure_utc",
                                           RANGE_END, RANGE_START) \
        .select("flight_code", "scheduled_departure_utc")
