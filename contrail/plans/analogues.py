"""Role tables of the flight model, derived from the driver's tables.

The driver supplies TPC-H-like tables plus an ``events`` stream.  Each role
of the flight data model is a deterministic projection of them (the same
definitions exist as SQL CTEs in :data:`SQL_CTES`, used by the DuckDB
oracle):

=============  =======================================================
raw schedules  ``events`` where ``event_type='purchase'`` (+ customer, nation)
raw flights    ``events`` where ``event_type='view'`` (position snapshots)
raw weather    ``events`` where ``event_type='error'`` (one city)
raw arrivals   ``events`` where ``event_type='click'`` (some lower-case codes)
airports       ``nation`` (region 4 has no coordinates)
airlines       ``region``
fleets         ``customer``
=============  =======================================================

``event_id`` is the ingest order used by every keep-last deduplication.
All work grows with the driver tables; nothing is sampled or capped.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.time import epoch_seconds
from contrail.operators.joins import dimension_join
from contrail.plans import gold, silver

# Fixed values of the analogue mapping (shared with the SQL below).
ORIGIN = "NATION_0"
CITY = "Krakow"
J3_TOLERANCE = timedelta(minutes=10)


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (read-only input), one DataFrame per application and path."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(key[1])
    return _TABLES[key]


def with_revisions(events: DataFrame) -> DataFrame:
    """The events as seen by snapshots: every sixth one is seen again later, with
    the same keys and another value, so that keep-last has work to do."""
    again = events.where(F.col("event_id") % 6 == 0) \
        .withColumn("event_id", F.col("event_id") + 1_000_000_000) \
        .withColumn("value", F.col("value") * 0.75 + 1)
    return events.unionByName(again)


def _events(spark, d, kind):
    return with_revisions(table(spark, d, "events").where(F.col("event_type") == kind))


def _s(c):
    return F.col(c).cast("string")


def _pos(expr_id, mult, base):
    return F.lit(base) + ((F.col(expr_id) * mult) % 1000).cast("double") / 100


def raw_schedules(spark, d) -> DataFrame:
    e = _events(spark, d, "purchase")
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"),
                                              F.col("c_nationkey").alias("n_nationkey"))
    nat = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = dimension_join(dimension_join(e, cust, "user_id", "inner"), nat, "n_nationkey", "inner")
    dep = epoch_seconds("ts")
    return j.select(
        F.concat(F.lit("FL"), _s("user_id")).alias("flight_iata"),
        F.when(F.col("value") >= 100, "delayed").otherwise("scheduled").alias("status"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 5).cast("string")).alias("dep_iata"),
        F.when(F.col("value") > 300, F.lit(None)).otherwise(F.col("n_name")).alias("arr_iata"),
        F.concat(F.lit("R"), _s("n_regionkey")).alias("airline_iata"),
        dep.alias("dep_time_ts"), (dep + 7200).alias("arr_time_ts"),
        F.col("value").alias("dep_delayed"),
        F.when(F.col("value") < 5, F.lit(None)).otherwise(F.col("value") / 2).alias("arr_delayed"),
        F.col("event_id").alias("ingest_order"))


def _lat(mult=1):
    return (F.when(F.col("value") < 0.5, F.lit(0.0))
             .when(F.col("value") > 400, F.lit(95.0))
             .otherwise(_pos("event_id", mult, 40.0)))


def raw_flights(spark, d) -> DataFrame:
    return raw_flights_from(_events(spark, d, "view"))


def raw_flights_from(e: DataFrame) -> DataFrame:
    """Raw position snapshots from view events (batch or stream)."""
    return e.select(
        F.concat(F.lit("FL"), _s("user_id")).alias("flight_iata"),
        F.concat(F.lit("SP-"), _s("user_id")).alias("reg_number"),
        F.concat(F.lit("H"), (F.col("user_id") * 7).cast("string")).alias("hex"),
        _lat().alias("lat"),
        F.when(F.col("value") < 0.5, F.lit(0.0)).otherwise(_pos("event_id", 7, 10.0)).alias("lng"),
        F.floor(F.col("value") * 100).alias("alt"),
        (F.col("value") * 2).alias("speed"),
        ((F.col("event_id") * 37) % 360).cast("double").alias("dir"),
        F.lit("en-route").alias("status"),
        F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string")).alias("airline_iata"),
        epoch_seconds("ts").alias("updated"),
        F.col("event_id").alias("ingest_order"))


def raw_weather(spark, d) -> DataFrame:
    e = _events(spark, d, "error")
    v = F.col("value")
    return e.select(
        F.lit(CITY).alias("name"),
        epoch_seconds("ts").alias("dt"),
        (v / 10 - 5).alias("main.temp"),
        (v / 10 - 7).alias("main.feels_like"),
        (F.lit(990) + F.floor(v / 10)).alias("main.pressure"),
        F.floor(v / 5).alias("main.humidity"),
        (v / 25).alias("wind.speed"),
        F.floor(v / 4).alias("clouds.all"),
        F.floor(v * 60).alias("visibility"),
        F.col("event_id").alias("ingest_order"))


def raw_arrivals(spark, d) -> DataFrame:
    e = _events(spark, d, "click")
    prefix = F.when(F.col("event_id") % 10 == 0, F.lit("fl")).otherwise(F.lit("FL"))
    return e.select(
        F.concat(prefix, _s("user_id")).alias("flight_iata"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("dep_iata"),
        F.lit(ORIGIN).alias("arr_iata"),
        F.lit("landed").alias("status"),
        F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string")).alias("airline_iata"),
        _lat(11).alias("lat"),
        F.when(F.col("value") < 0.5, F.lit(0.0)).otherwise(_pos("event_id", 13, 10.0)).alias("lng"),
        epoch_seconds("ts").alias("updated"),
        F.col("event_id").alias("ingest_order"))


def airports(spark, d) -> DataFrame:
    n = table(spark, d, "nation")
    return n.select(
        F.col("n_name").alias("iata_code"),
        F.concat(F.col("n_name"), F.lit(" Airport")).alias("name"),
        F.when(F.col("n_regionkey") == 4, F.lit(None).cast("double"))
         .otherwise(F.lit(40.0) + F.col("n_nationkey").cast("double") * 0.5).alias("lat"),
        (F.lit(10.0) + F.col("n_nationkey").cast("double") * 0.75).alias("lng"),
        F.concat(F.lit("C"), _s("n_regionkey")).alias("country_code"))


def airlines(spark, d) -> DataFrame:
    r = table(spark, d, "region")
    return r.select(F.concat(F.lit("R"), _s("r_regionkey")).alias("iata_code"),
                    F.col("r_name").alias("name"))


def fleets(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    built = (F.lit(1980) + F.col("c_nationkey")).cast("long")
    return c.select(F.concat(F.lit("SP-"), _s("c_custkey")).alias("reg_number"),
                    F.col("c_mktsegment").alias("manufacturer"),
                    F.col("c_name").alias("model"),
                    built.alias("built"), (F.lit(2024) - built).alias("age"))


# ---- silver / gold on the analogues ---------------------------------------

def schedules(spark, d) -> DataFrame:
    return silver.clean_schedules(raw_schedules(spark, d), airports(spark, d), airlines(spark, d))


def flights(spark, d) -> DataFrame:
    return silver.clean_flights(raw_flights(spark, d), fleets(spark, d))


def weather(spark, d) -> DataFrame:
    return silver.clean_weather(raw_weather(spark, d))


def arrivals(spark, d) -> DataFrame:
    return silver.transform_arrivals(raw_arrivals(spark, d), airports(spark, d), airlines(spark, d))


def facts(spark, d) -> DataFrame:
    return gold.schedule_flight_facts(schedules(spark, d), flights(spark, d))


def correlation(spark, d) -> DataFrame:
    return gold.weather_correlation(facts(spark, d), weather(spark, d), J3_TOLERANCE)


# ---- the same definitions in SQL (DuckDB dialect) ------------------------

EPOCH_S = "CAST(epoch_us({c}) // 1000000 AS BIGINT)"
TS_OF = "make_timestamp(CAST(trunc(CAST({c} AS DOUBLE)) AS BIGINT) * 1000000)"


def _ep(c):
    return EPOCH_S.format(c=c)


def _ts(c):
    return TS_OF.format(c=c)


def _lat_sql(mult):
    return (f"CASE WHEN value < 0.5 THEN 0.0 WHEN value > 400 THEN 95.0 "
            f"ELSE 40.0 + CAST((event_id * {mult}) % 1000 AS DOUBLE) / 100 END")


SQL_CTES = f"""
seen AS (
  SELECT * FROM events
  UNION ALL BY NAME
  SELECT * REPLACE (event_id + 1000000000 AS event_id, value * 0.75 + 1 AS value)
  FROM events WHERE event_id % 6 = 0),
raw_schedules AS (
  SELECT 'FL' || CAST(e.user_id AS VARCHAR) AS flight_iata,
         CASE WHEN e.value >= 100 THEN 'delayed' ELSE 'scheduled' END AS status,
         'NATION_' || CAST(e.user_id % 5 AS VARCHAR) AS dep_iata,
         CASE WHEN e.value > 300 THEN NULL ELSE n.n_name END AS arr_iata,
         'R' || CAST(n.n_regionkey AS VARCHAR) AS airline_iata,
         {_ep('e.ts')} AS dep_time_ts,
         {_ep('e.ts')} + 7200 AS arr_time_ts,
         e.value AS dep_delayed,
         CASE WHEN e.value < 5 THEN NULL ELSE e.value / 2 END AS arr_delayed,
         e.event_id AS ingest_order
  FROM seen e JOIN customer c ON c.c_custkey = e.user_id
       JOIN nation n ON n.n_nationkey = c.c_nationkey
  WHERE e.event_type = 'purchase'),
raw_flights AS (
  SELECT 'FL' || CAST(user_id AS VARCHAR) AS flight_iata,
         'SP-' || CAST(user_id AS VARCHAR) AS reg_number,
         'H' || CAST(user_id * 7 AS VARCHAR) AS hex,
         {_lat_sql(1)} AS lat,
         CASE WHEN value < 0.5 THEN 0.0 ELSE 10.0 + CAST((event_id * 7) % 1000 AS DOUBLE) / 100 END AS lng,
         CAST(floor(value * 100) AS BIGINT) AS alt,
         value * 2 AS speed,
         CAST((event_id * 37) % 360 AS DOUBLE) AS dir,
         'en-route' AS status,
         'R' || CAST(user_id % 5 AS VARCHAR) AS airline_iata,
         {_ep('ts')} AS updated,
         event_id AS ingest_order
  FROM seen WHERE event_type = 'view'),
raw_weather AS (
  SELECT '{CITY}' AS name, {_ep('ts')} AS dt,
         value / 10 - 5 AS "main.temp", value / 10 - 7 AS "main.feels_like",
         990 + CAST(floor(value / 10) AS BIGINT) AS "main.pressure",
         CAST(floor(value / 5) AS BIGINT) AS "main.humidity",
         value / 25 AS "wind.speed",
         CAST(floor(value / 4) AS BIGINT) AS "clouds.all",
         CAST(floor(value * 60) AS BIGINT) AS visibility,
         event_id AS ingest_order
  FROM seen WHERE event_type = 'error'),
raw_arrivals AS (
  SELECT CASE WHEN event_id % 10 = 0 THEN 'fl' ELSE 'FL' END || CAST(user_id AS VARCHAR) AS flight_iata,
         'NATION_' || CAST(user_id % 25 AS VARCHAR) AS dep_iata,
         '{ORIGIN}' AS arr_iata, 'landed' AS status,
         'R' || CAST(user_id % 5 AS VARCHAR) AS airline_iata,
         {_lat_sql(11)} AS lat,
         CASE WHEN value < 0.5 THEN 0.0 ELSE 10.0 + CAST((event_id * 13) % 1000 AS DOUBLE) / 100 END AS lng,
         {_ep('ts')} AS updated,
         event_id AS ingest_order
  FROM seen WHERE event_type = 'click'),
airports AS (
  SELECT n_name AS iata_code, n_name || ' Airport' AS name,
         CASE WHEN n_regionkey = 4 THEN NULL ELSE 40.0 + CAST(n_nationkey AS DOUBLE) * 0.5 END AS lat,
         10.0 + CAST(n_nationkey AS DOUBLE) * 0.75 AS lng,
         'C' || CAST(n_regionkey AS VARCHAR) AS country_code
  FROM nation),
airlines AS (SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS iata_code, r_name AS name FROM region),
fleets AS (
  SELECT 'SP-' || CAST(c_custkey AS VARCHAR) AS reg_number, c_mktsegment AS manufacturer,
         c_name AS model, CAST(1980 + c_nationkey AS BIGINT) AS built,
         2024 - CAST(1980 + c_nationkey AS BIGINT) AS age
  FROM customer),
sched_typed AS (
  SELECT flight_iata AS flight_code, status, dep_iata AS departure_airport,
         arr_iata AS arrival_airport, airline_iata AS airline_code,
         {_ts('dep_time_ts')} AS scheduled_departure_utc,
         {_ts('arr_time_ts')} AS scheduled_arrival_utc,
         CAST(trunc(coalesce(CAST(dep_delayed AS DOUBLE), 0.0)) AS INTEGER) AS departure_delay_mins,
         CAST(trunc(coalesce(CAST(arr_delayed AS DOUBLE), 0.0)) AS INTEGER) AS arrival_delay_mins,
         ingest_order
  FROM raw_schedules
  WHERE flight_iata IS NOT NULL AND dep_iata IS NOT NULL AND arr_iata IS NOT NULL),
sched_dedup AS (
  SELECT * EXCLUDE (rn, ingest_order) FROM (
    SELECT *, row_number() OVER (PARTITION BY flight_code, scheduled_departure_utc
                                 ORDER BY ingest_order DESC) AS rn FROM sched_typed) WHERE rn = 1),
schedules AS (
  SELECT s.*, d.name AS dep_airport_name, d.lat AS dep_lat, d.lng AS dep_lng,
         a.name AS arr_airport_name, a.lat AS arr_lat, a.lng AS arr_lng, l.name AS airline_name
  FROM sched_dedup s
  LEFT JOIN airports d ON d.iata_code = s.departure_airport
  LEFT JOIN airports a ON a.iata_code = s.arrival_airport
  LEFT JOIN airlines l ON l.iata_code = s.airline_code),
flights_typed AS (
  SELECT flight_iata AS flight_code, reg_number, hex AS icao_24bit_hex,
         CAST(lat AS DOUBLE) AS lat, CAST(lng AS DOUBLE) AS lng,
         CAST(trunc(CAST(alt AS DOUBLE)) AS BIGINT) AS altitude_ft,
         CAST(speed AS DOUBLE) AS ground_speed_knt, CAST(dir AS DOUBLE) AS heading_deg,
         status, airline_iata AS airline_code, {_ts('updated')} AS last_updated_utc, ingest_order
  FROM raw_flights WHERE flight_iata IS NOT NULL AND reg_number IS NOT NULL),
flights AS (
  SELECT f.* EXCLUDE (rn, ingest_order), p.manufacturer AS aircraft_manufacturer,
         p.model AS aircraft_model, p.built AS aircraft_built_year, p.age AS aircraft_age_years
  FROM (SELECT *, row_number() OVER (PARTITION BY flight_code, last_updated_utc
                                     ORDER BY ingest_order DESC) AS rn FROM flights_typed) f
  LEFT JOIN fleets p ON p.reg_number = f.reg_number
  WHERE f.rn = 1),
weather AS (
  SELECT * EXCLUDE (rn, ingest_order) FROM (
    SELECT name AS airport_city, {_ts('dt')} AS observation_time_utc,
           CAST("main.temp" AS DOUBLE) AS temp_celsius,
           CAST("main.feels_like" AS DOUBLE) AS feels_like_celsius,
           CAST(trunc(CAST("main.pressure" AS DOUBLE)) AS INTEGER) AS pressure_hpa,
           CAST(trunc(CAST("main.humidity" AS DOUBLE)) AS INTEGER) AS humidity_percent,
           CAST("wind.speed" AS DOUBLE) AS wind_speed_mps,
           CAST(trunc(CAST("clouds.all" AS DOUBLE)) AS INTEGER) AS cloudiness_percent,
           CAST(trunc(CAST(visibility AS DOUBLE)) AS INTEGER) AS visibility_meters,
           ingest_order,
           row_number() OVER (PARTITION BY name, {_ts('dt')} ORDER BY event_order DESC) AS rn
    FROM (SELECT *, ingest_order AS event_order FROM raw_weather)) WHERE rn = 1),
arr_typed AS (
  SELECT flight_iata AS flight_code, dep_iata AS departure_airport, arr_iata AS arrival_airport,
         status, airline_iata AS airline_code, CAST(lat AS DOUBLE) AS lat, CAST(lng AS DOUBLE) AS lng,
         {_ts('updated')} AS last_updated_utc, ingest_order
  FROM raw_arrivals WHERE flight_iata IS NOT NULL AND updated IS NOT NULL),
arrivals AS (
  SELECT r.* EXCLUDE (rn, ingest_order, airline_name), l.name AS airline_name FROM (
    SELECT t.*, d.name AS dep_airport_name, d.lat AS dep_lat, d.lng AS dep_lng,
           CAST(NULL AS VARCHAR) AS airline_name,
           row_number() OVER (PARTITION BY t.flight_code, t.last_updated_utc
                              ORDER BY t.ingest_order DESC) AS rn
    FROM arr_typed t LEFT JOIN airports d ON d.iata_code = t.departure_airport) r
  LEFT JOIN airlines l ON l.iata_code = r.airline_code
  WHERE r.rn = 1),
fact_match AS (
  SELECT * FROM (
    SELECT s.flight_code AS m_code, s.scheduled_departure_utc AS m_time, f.*,
           row_number() OVER (PARTITION BY s.flight_code, s.scheduled_departure_utc
             ORDER BY abs(epoch_us(f.last_updated_utc) - epoch_us(s.scheduled_departure_utc)),
                      f.last_updated_utc DESC) AS rn
    FROM schedules s JOIN flights f ON f.flight_code = s.flight_code
     AND f.last_updated_utc BETWEEN s.scheduled_departure_utc - INTERVAL 12 HOUR
                                AND s.scheduled_departure_utc + INTERVAL 12 HOUR)
  WHERE rn = 1),
facts AS (
  SELECT s.*, m.last_updated_utc, m.reg_number, m.icao_24bit_hex, m.lat AS live_lat,
         m.lng AS live_lng, m.altitude_ft, m.ground_speed_knt, m.heading_deg,
         m.status AS live_status, m.aircraft_manufacturer, m.aircraft_model,
         m.aircraft_built_year, m.aircraft_age_years
  FROM schedules s LEFT JOIN fact_match m
    ON m.m_code = s.flight_code AND m.m_time = s.scheduled_departure_utc),
weather_match AS (
  SELECT * FROM (
    SELECT f.flight_code AS m_code, f.scheduled_departure_utc AS m_time, w.*,
           row_number() OVER (PARTITION BY f.flight_code, f.scheduled_departure_utc
             ORDER BY abs(epoch_us(w.observation_time_utc) - epoch_us(f.last_updated_utc)),
                      w.observation_time_utc DESC) AS rn
    FROM facts f JOIN weather w
      ON w.observation_time_utc BETWEEN f.last_updated_utc - INTERVAL 10 MINUTE
                                    AND f.last_updated_utc + INTERVAL 10 MINUTE)
  WHERE rn = 1),
correlation AS (
  SELECT f.*, m.airport_city, m.observation_time_utc, m.temp_celsius, m.feels_like_celsius,
         m.pressure_hpa, m.humidity_percent, m.wind_speed_mps, m.cloudiness_percent,
         m.visibility_meters, m.observation_time_utc IS NOT NULL AS has_weather_match
  FROM facts f LEFT JOIN weather_match m
    ON m.m_code = f.flight_code AND m.m_time = f.scheduled_departure_utc
  WHERE f.last_updated_utc IS NOT NULL)
"""


def with_ctes(select: str, extra: str = "", recursive: bool = False) -> str:
    """An oracle query: the shared CTEs (+ ``extra`` ones), then ``select``."""
    head = "WITH RECURSIVE" if recursive else "WITH"
    more = f",\n{extra.strip()}" if extra.strip() else ""
    return f"{head} {SQL_CTES.strip()}{more}\n{select.strip()}"
