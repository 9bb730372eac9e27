"""Silver layer: raw snapshots -> cleaned, deduplicated, enriched tables
(C1-C4) and their data-quality checks (Q1-Q3).

``order`` names the ingest-order column(s) that define "last" for the
keep-last deduplication (snapshot time, position in file ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from contrail.functions.numeric import null_default_int, tolerant_int
from contrail.functions.time import epoch_seconds_to_ts
from contrail.operators.dedup import keep_any, keep_last
from contrail.operators.filters import drop_null_keys
from contrail.operators.joins import join_airlines, join_airports, join_fleets
from contrail import schemas as S

DEFAULT_ORDER = ("ingest_order",)


def _order(raw: DataFrame, order) -> list[str]:
    return [o for o in (order or []) if o in raw.columns]


def _last(df: DataFrame, keys: list[str], order: list[str], ingest: bool) -> DataFrame:
    """W1 by ingest order; with ``ingest`` the order is kept as one text that
    sorts alike, so that later merges can rank by it."""
    df = keep_last(df, keys, order)
    if ingest:
        parts = [F.lpad(F.col(o).cast("string"), 20, "0") if df.schema[o].dataType.simpleString() in ("int", "bigint")
                 else F.col(o).cast("string") for o in order]
        df = df.withColumn(S.INGEST, F.concat_ws("#", *parts))
    return df.drop(*order)


def clean_schedules(raw: DataFrame, airports: DataFrame | None,
                    airlines: DataFrame | None, order=DEFAULT_ORDER,
                    strict: bool = True, ingest: bool = False) -> DataFrame:
    """P1/P2/P3/P5 projection, F7, W1 keep-last on (code, departure),
    then J1a/J1b/J1c (dictionaries not deduplicated: duplicates fan out)."""
    order = _order(raw, order)
    df = raw.select(
        F.col("flight_iata").cast("string").alias("flight_code"),
        F.col("status").cast("string").alias("status"),
        F.col("dep_iata").cast("string").alias("departure_airport"),
        F.col("arr_iata").cast("string").alias("arrival_airport"),
        F.col("airline_iata").cast("string").alias("airline_code"),
        epoch_seconds_to_ts("dep_time_ts", strict).alias("scheduled_departure_utc"),
        epoch_seconds_to_ts("arr_time_ts", strict).alias("scheduled_arrival_utc"),
        null_default_int("dep_delayed").alias("departure_delay_mins"),
        null_default_int("arr_delayed").alias("arrival_delay_mins"),
        *order)
    df = drop_null_keys(df, ["flight_code", "departure_airport", "arrival_airport"])
    df = _last(df, ["flight_code", "scheduled_departure_utc"], order, ingest)
    df = join_airports(df, airports, "departure_airport", "dep")
    df = join_airports(df, airports, "arrival_airport", "arr")
    df = join_airlines(df, airlines)
    return S.conform(df, S.SCHEDULES, (S.INGEST,))


def clean_flights(raw: DataFrame, fleets: DataFrame | None, order=DEFAULT_ORDER,
                  strict: bool = True, ingest: bool = False) -> DataFrame:
    """Projection, F7, W1 keep-last on (code, update time), J1d fleets."""
    order = _order(raw, order)
    df = raw.select(
        F.col("flight_iata").cast("string").alias("flight_code"),
        F.col("reg_number").cast("string").alias("reg_number"),
        F.col("hex").cast("string").alias("icao_24bit_hex"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lng").cast("double").alias("lng"),
        tolerant_int("alt", "long").alias("altitude_ft"),
        F.col("speed").cast("double").alias("ground_speed_knt"),
        F.col("dir").cast("double").alias("heading_deg"),
        F.col("status").cast("string").alias("status"),
        F.col("airline_iata").cast("string").alias("airline_code"),
        epoch_seconds_to_ts("updated", strict).alias("last_updated_utc"),
        *order)
    df = drop_null_keys(df, ["flight_code", "reg_number"])
    df = _last(df, ["flight_code", "last_updated_utc"], order, ingest)
    df = join_fleets(df, fleets)
    return S.conform(df, S.FLIGHTS, (S.INGEST,))


def project_weather(raw: DataFrame, order=DEFAULT_ORDER, strict: bool = True) -> DataFrame:
    """Flattened weather record -> typed observation columns."""
    order = _order(raw, order)
    return raw.select(
        F.col("name").cast("string").alias("airport_city"),
        epoch_seconds_to_ts("dt", strict).alias("observation_time_utc"),
        F.col("`main.temp`").cast("double").alias("temp_celsius"),
        F.col("`main.feels_like`").cast("double").alias("feels_like_celsius"),
        tolerant_int("`main.pressure`").alias("pressure_hpa"),
        tolerant_int("`main.humidity`").alias("humidity_percent"),
        F.col("`wind.speed`").cast("double").alias("wind_speed_mps"),
        tolerant_int("`clouds.all`").alias("cloudiness_percent"),
        tolerant_int("visibility").alias("visibility_meters"),
        *order)


def clean_weather(raw: DataFrame, order=DEFAULT_ORDER, strict: bool = True,
                  ingest: bool = False) -> DataFrame:
    """Typed observations, W1 keep-last on (city, time)."""
    order = _order(raw, order)
    df = project_weather(raw, order, strict)
    return S.conform(_last(df, ["airport_city", "observation_time_utc"], order, ingest), S.WEATHER, (S.INGEST,))


def transform_arrivals(raw: DataFrame, airports: DataFrame | None,
                       airlines: DataFrame | None = None, order=DEFAULT_ORDER,
                       strict: bool = True) -> DataFrame:
    """C4: raw arrival snapshots -> arrivals table.  Without an ``updated``
    column the result is empty (with the declared schema)."""
    spark = raw.sparkSession
    if "updated" not in raw.columns:
        return spark.createDataFrame([], S.ARRIVALS)
    order = _order(raw, order)
    df = raw.select(
        F.col("flight_iata").cast("string").alias("flight_code"),
        F.col("dep_iata").cast("string").alias("departure_airport"),
        F.col("arr_iata").cast("string").alias("arrival_airport"),
        F.col("status").cast("string").alias("status"),
        F.col("airline_iata").cast("string").alias("airline_code"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lng").cast("double").alias("lng"),
        epoch_seconds_to_ts("updated", strict).alias("last_updated_utc"),
        *order)
    df = drop_null_keys(df, ["flight_code", "last_updated_utc"])
    df = join_airports(df, airports, "departure_airport", "dep")
    if "airline_name" not in df.columns:
        df = df.withColumn("airline_name", F.lit(None).cast("string"))
    df = keep_last(df, ["flight_code", "last_updated_utc"], order).drop(*order)
    if airlines is not None:
        df = join_airlines(df, airlines, dedup_order=[], replace=True)
    return S.conform(df, S.ARRIVALS)


# ---- data quality -------------------------------------------------------

def dq_metrics(df: DataFrame, key: str = "flight_code") -> DataFrame:
    """Q1/Q2 as a one-row table: row count, null keys, pass flag."""
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_if(F.col(key).isNull()).alias("null_keys")) \
             .withColumn("passed", (F.col("row_count") > 0) & (F.col("null_keys") == 0))


def observe_dq(df: DataFrame, name: str, key: str | None = "flight_code", date_col: str | None = None):
    """Attach Q1/Q2 metrics to a plan without an extra pass; read them
    after the write with :func:`assert_dq`."""
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("row_count")]
    if key:
        exprs.append(F.count_if(F.col(key).isNull()).alias("null_keys"))
    if date_col:
        exprs.append(F.count_if(F.col(date_col).isNull()).alias("no_date"))
    return df.observe(obs, *exprs), obs


def assert_dq(obs: Observation, what: str) -> dict:
    m = obs.get
    if not m.get("row_count"):
        raise AssertionError(f"Data quality error: cleaned {what} is empty.")
    if m.get("null_keys"):
        raise AssertionError(f"Data quality error: {what} has null flight_code.")
    return m


def contract_violations(df: DataFrame, required: list[str]) -> DataFrame:
    """Q3: rows breaking the row contract (a required field is null), with
    the list of offending fields."""
    missing = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]),
        lambda x: x.isNotNull())
    return df.withColumn("violations", missing).where(F.size("violations") > 0)


SCHEDULE_REQUIRED = ["flight_code", "status", "departure_airport", "arrival_airport",
                     "scheduled_departure_utc", "scheduled_arrival_utc"]

__all__ = ["clean_schedules", "clean_flights", "clean_weather", "transform_arrivals",
           "dq_metrics", "observe_dq", "assert_dq", "contract_violations", "keep_any"]
