"""Gold kept up to date by day (C9): only what late or rewritten silver days can
change is computed again.

Every schedule day has its own sums, counts and maxima, which merge into the gold
tables: performance, impact, traffic and routes come from a few rows a day, the
correlation is kept by day itself.  A ledger holds what each silver day looked like
at the last refresh.  It is written last: a refresh that dies is done again.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import schemas as S
from contrail.functions.numeric import round2
from contrail.functions.time import hour_utc
from contrail.operators.dedup import keep_last
from contrail.operators.joins import airport_columns, dictionary_order, join_airlines
from contrail.plans import gold as G
from contrail.plans.jobs import SPLIT_ROWS, load_dictionaries
from contrail.session import path_exists, remove_path, scratch_path
from contrail.sources import raw as RAW
from contrail.sources import tables as TB

SILVER = {"schedules": S.SCHEDULES, "flights": S.FLIGHTS, "weather": S.WEATHER}
LEDGER = "silver string, on date, files long, bytes long, newest timestamp, name string"


def _folder(base: str, day: date) -> str:
    return f"{base}/year={day:%Y}/month={day:%m}/day={day:%d}"


def _versions(spark: SparkSession, silver_base: str) -> dict[tuple[str, date], tuple]:
    """What every silver day looks like: files, bytes, newest file.  Files are listed,
    none is opened; the driver gets one row a table and day."""
    out = {}
    for name in SILVER:
        base = f"{silver_base}/{name}"
        if not path_exists(spark, base):
            continue
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(base)
        newest = F.max(F.struct("modificationTime", "path"))
        rows = files.groupBy("year", "month", "day").agg(
            F.count("*").alias("files"), F.sum("length").alias("bytes"), newest.alias("newest")).collect()
        for r in rows:
            out[name, date(int(r.year), int(r.month), int(r.day))] = (
                r.files, r.bytes, r.newest.modificationTime, r.newest.path)
    return out


def _days(spark: SparkSession, silver_base: str, name: str, days: set[date]) -> DataFrame:
    base = f"{silver_base}/{name}"
    there = [p for p in (_folder(base, d) for d in sorted(days)) if path_exists(spark, p)]
    df = RAW.read_raw_parquet(spark, there, placed=False) if there else None
    return spark.createDataFrame([], SILVER[name]) if df is None else S.conform(df.drop(S.INGEST), SILVER[name])


def _around(days: set[date], reach: timedelta) -> set[date]:
    pad = -(-reach // timedelta(days=1))
    return {d + timedelta(days=n) for d in days for n in range(-pad, pad + 1)}


def _replace_days(df: DataFrame, base: str, days: set[date]) -> DataFrame:
    """Put the rows of ``df`` (days in ``on``) in place of all of ``days``; the
    whole table."""
    spark, stage = df.sparkSession, scratch_path(df.sparkSession, "refresh")
    df.write.parquet(stage)
    rows = spark.read.schema(df.schema).parquet(stage)
    TB.with_day_partitions(rows, "on").hint("rebalance", *TB.PARTITION_COLS).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(*TB.PARTITION_COLS).parquet(base)
    held = {r.on for r in rows.select("on").distinct().collect()}
    for day in days - held:
        if path_exists(spark, _folder(base, day)):
            remove_path(spark, _folder(base, day))
    remove_path(spark, stage)
    return spark.read.schema(df.schema).parquet(base).select(*df.columns)


def refresh_gold(spark: SparkSession, silver_base: str, dict_base: str, gold_base: str,
                 origin: str = G.ORIGIN_AIRPORT,
                 flight_tolerance: timedelta = G.FLIGHT_SCHEDULE_MATCH_TOLERANCE,
                 weather_tolerance: timedelta = G.WEATHER_MATCH_TOLERANCE) -> list[date]:
    """Bring the gold tables up to date with silver; the schedule days computed again.

    A schedule day is computed again if it changed, or positions within
    ``flight_tolerance``, or weather within both tolerances of it did.  The dictionaries
    are joined to the merged rows, so changed names need no day.  The correlation is
    ``weather_correlation_by_day``; without any weather it is empty, as in the full
    build, and a published table whose new result is empty stays as it was.
    """
    now = _versions(spark, silver_base)
    ledger = f"{gold_base}/silver_days"
    before = {(r.silver, r.on): (r.files, r.bytes, r.newest, r.name)
              for r in spark.read.schema(LEDGER).parquet(ledger).collect()} if path_exists(spark, ledger) else {}
    changed = {k for k in now.keys() | before.keys() if now.get(k) != before.get(k)}
    known = {d for name, d in now.keys() | before.keys() if name == "schedules"}
    any_weather = any(name == "weather" for name, _ in now)

    def of(name):
        return {d for table, d in changed if table == name}

    days = of("schedules") | known & (_around(of("flights"), flight_tolerance)
                                      | _around(of("weather"), flight_tolerance + weather_tolerance))
    if any_weather != any(name == "weather" for name, _ in before):
        days = known
    schedules = _days(spark, silver_base, "schedules", days)
    flights = _days(spark, silver_base, "flights", _around(days, flight_tolerance))
    weather = _days(spark, silver_base, "weather", _around(days, flight_tolerance + weather_tolerance))
    facts = G.schedule_flight_facts(schedules, flights, flight_tolerance, split_rows=SPLIT_ROWS).checkpoint()
    matched = G.match_weather(facts, weather, weather_tolerance, SPLIT_ROWS).where(F.lit(any_weather))

    on = F.to_date("scheduled_departure_utc").alias("on")
    delay = [F.sum("departure_delay_mins").alias("total"), F.count("departure_delay_mins").alias("known"),
             F.count(F.lit(1)).alias("n")]
    correlation = _replace_days(matched.withColumn("on", on), f"{gold_base}/weather_correlation_by_day", days) \
        .where(F.col("on").isin(sorted(days)) if days else F.lit(False))
    performance = facts.where(F.col("last_updated_utc").isNotNull() & F.col("airline_code").isNotNull()) \
        .groupBy(on, "airline_code").agg(*delay)
    impact = G.impact_members(correlation, "on").groupBy("on", "m").agg(*delay).select(
        "on", "m.*", "total", "known", "n")
    traffic = schedules.groupBy(on, hour_utc("scheduled_departure_utc").alias("departure_hour_utc")) \
        .agg(F.count(F.lit(1)).alias("n"))
    routes = schedules.where(F.col("arrival_airport").isNotNull()) \
        .groupBy(on, "departure_airport", "arrival_airport") \
        .agg(F.count(F.lit(1)).alias("n"), F.max("scheduled_departure_utc").alias("last"))
    states = {name: _replace_days(df, f"{gold_base}/by_day/{name}", days) for name, df in
              {"performance": performance, "impact": impact, "traffic": traffic, "routes": routes}.items()}

    airports, airlines, _ = load_dictionaries(spark, dict_base)
    for name, df in merged(states, airlines, airports, origin).items():
        TB.write_table(df, f"{gold_base}/{name}")
    spark.createDataFrame([(*k, *v) for k, v in sorted(now.items())], LEDGER).write.mode("overwrite").parquet(ledger)
    return sorted(days)


def merged(states: dict[str, DataFrame], airlines: DataFrame | None, airports: DataFrame | None,
           origin: str = G.ORIGIN_AIRPORT) -> dict[str, DataFrame]:
    """The gold tables of the days' states."""
    mean = round2(F.sum("total") / F.sum("known")).alias("avg_departure_delay_mins")
    codes = states["performance"].groupBy("airline_code").agg(
        *[F.sum(c).alias(c) for c in ("total", "known", "n")]).withColumn("airline_name", F.lit(None).cast("string"))
    out = {
        "airline_performance": join_airlines(codes, airlines, dedup_order=[], replace=True)
        .groupBy("airline_code", "airline_name").agg(mean, F.sum("n").alias("total_flights"))
        .orderBy(F.desc_nulls_first("total_flights"), F.asc("airline_code")),
        "weather_impact": states["impact"].groupBy("rank", "metric", "bucket_label", "bucket_start", "bucket_end")
        .agg(mean, F.sum("n").alias("flight_count"))
        .orderBy("rank", F.asc_nulls_first("bucket_start"), "bucket_label").drop("rank"),
        "hourly_traffic": states["traffic"].groupBy("departure_hour_utc").agg(F.sum("n").alias("flight_count"))
        .orderBy("departure_hour_utc"),
    }
    if airports is not None:
        dim = keep_last(airports, ["iata_code"], dictionary_order(airports))
        out["active_routes"] = (
            states["routes"].where(F.col("departure_airport") == F.lit(origin))
            .groupBy("departure_airport", "arrival_airport")
            .agg(F.sum("n").alias("flight_count"), F.max("last").alias("last_scheduled_departure_utc"))
            .join(airport_columns(dim, "departure_airport", "dep", with_name=False), "departure_airport", "left")
            .join(airport_columns(dim, "arrival_airport", "arr"), "arrival_airport", "left")
            .dropna(subset=["dep_lat", "dep_lng", "arr_lat", "arr_lng"])
            .select(*S.ACTIVE_ROUTES.fieldNames())
            .orderBy(F.desc_nulls_first("flight_count"), F.asc("arrival_airport")))
    return out
