"""Batch jobs: silver layer (C8) and gold layer.

Both are re-runnable: silver overwrites only the day partitions present in
the input (dynamic overwrite), gold overwrites whole tables and leaves an old
table in place when a new result is empty.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from contrail import schemas as S
from contrail.plans import gold as G
from contrail.plans import silver as SV
from contrail.session import remove_path, scratch_path
from contrail.sources import raw as RAW
from contrail.sources import tables as TB
from contrail.sources import versions as VS


# Left rows of an as-of bucket that one task sweeps; a hot flight or hour is cut into parts.
SPLIT_ROWS = 1_000_000


def load_dictionaries(spark: SparkSession, dict_base: str, fetchers: dict | None = None):
    """Airports, airlines and fleets dictionaries."""
    fetchers = fetchers or {}
    return tuple(RAW.load_dictionary(spark, f"{dict_base}/{name}", fetchers.get(name))
                 for name in ("airports", "airlines", "fleets"))


def process_silver_layer(spark: SparkSession, raw_base: str, dict_base: str, silver_base: str,
                         record_schemas: dict[str, T.StructType] | None = None,
                         order: list[str] | None = None, airport: str = "KRK", versions: bool = False) -> dict:
    """Bronze -> silver for schedules, departures (flights) and weather.

    Each cleaned table is computed once, into the shared checkpoint folder, with
    its data-quality metrics observed on the way; a failed check raises before
    silver is touched.  Rows without a date go to quarantine and are counted
    (``no_date``), files that cannot be read are counted on the way (``unreadable_files``).
    Without ``order`` the last row is the last by file path and place in the file.
    With ``versions`` each table is one of :mod:`contrail.sources.versions`, replaced by
    one commit.
    """
    schemas = record_schemas or {}
    order = order or RAW.FILE_ORDER
    airports, airlines, fleets = load_dictionaries(spark, dict_base)
    out = {}
    jobs = [
        ("schedules", f"{raw_base}/schedules/{airport}",
         lambda r: SV.clean_schedules(r, airports, airlines, order, ingest=True), "scheduled_departure_utc", False),
        ("flights", f"{raw_base}/flights/departures/{airport}",
         lambda r: SV.clean_flights(r, fleets, order, ingest=True), "last_updated_utc", False),
        ("weather", f"{raw_base}/weather/{airport}",
         lambda r: SV.clean_weather(r, order, ingest=True), "observation_time_utc", True),
    ]
    for name, prefix, clean, date_col, weather in jobs:
        unreadable = RAW.Unreadable()
        raw = RAW.read_raw(spark, prefix, schemas.get(name), weather=weather, unreadable=unreadable)
        if raw is None:
            out[name] = None
            continue
        cleaned, obs = SV.observe_dq(clean(raw), name, date_col=date_col,
                                     key="flight_code" if name == "schedules" else None)
        stage = scratch_path(spark, f"silver-{name}")
        cleaned.write.parquet(stage)
        try:
            metrics = SV.assert_dq(obs, name)
            (VS.commit_days if versions else TB.write_partitioned)(
                spark.read.parquet(stage), date_col, f"{silver_base}/{name}")
        finally:
            remove_path(spark, stage)
        out[name] = {**metrics, "unreadable_files": unreadable.count()}
    return out


def process_gold_layer(spark: SparkSession, silver_base: str, dict_base: str, gold_base: str,
                       origin: str = G.ORIGIN_AIRPORT,
                       weather_tolerance: timedelta = G.WEATHER_MATCH_TOLERANCE) -> dict[str, bool]:
    """Silver -> the five gold tables.

    The schedule/flight facts and their weather correlation feed two tables each;
    both are checkpointed to the shared folder (lineage cut, survives executor loss).
    """
    schedules = TB.read_silver(spark, f"{silver_base}/schedules", S.SCHEDULES)
    flights = TB.read_silver(spark, f"{silver_base}/flights", S.FLIGHTS)
    weather = TB.read_silver(spark, f"{silver_base}/weather", S.WEATHER)
    airports, airlines, _ = load_dictionaries(spark, dict_base)
    facts = G.schedule_flight_facts(schedules, flights, split_rows=SPLIT_ROWS).checkpoint(eager=True)
    correlation = G.weather_correlation(facts, weather, weather_tolerance, SPLIT_ROWS).checkpoint(eager=True)
    data = G.build_gold_datasets(schedules, flights, weather, airlines, airports, origin=origin,
                                 facts=facts, correlation=correlation)
    return {name: TB.write_table(df, f"{gold_base}/{name}") for name, df in data.items()}


def land_raw(df: DataFrame, raw_base: str, kind: str, fmt: str = "parquet",
             when: datetime | None = None) -> str:
    """Land raw records under ``raw_base/kind`` (Parquet or JSON)."""
    path = f"{raw_base}/{kind}"
    (TB.land_json if fmt == "json" else TB.land_snapshot)(df, path, when)
    return path
