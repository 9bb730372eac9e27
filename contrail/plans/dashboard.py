"""Dashboard queries: delays by hour (A4), weekday patterns (A6), KPIs (A8),
flight tables (C10, P7, P8, O3), top-k reports (O4, O5)."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.numeric import round2, value_map
from contrail.functions.time import hour_utc, iso_weekday
from contrail.operators.filters import filter_code_or_name, filter_text

# Visible columns and labels of the two flight tables, the
# weekday labels (Monday = 1) and the direction labels.
DEPARTURE_COLUMNS = [
    "flight_code", "airline_name", "arrival_airport", "arr_airport_name",
    "scheduled_departure_utc", "scheduled_arrival_utc", "departure_delay_mins",
    "arrival_delay_mins", "status",
]
ARRIVAL_COLUMNS = [
    "flight_code", "airline_name", "departure_airport", "dep_airport_name",
    "last_updated_utc", "status", "lat", "lng",
]
DEPARTURE_COLUMN_LABELS = {
    "flight_code": "Numer lotu",
    "airline_name": "Linia lotnicza",
    "arrival_airport": "Kod lotniska",
    "arr_airport_name": "Lotnisko docelowe",
    "scheduled_departure_utc": "Planowany odlot",
    "scheduled_arrival_utc": "Planowany przylot",
    "departure_delay_mins": "Opóźnienie odlotu (min)",
    "arrival_delay_mins": "Opóźnienie przylotu (min)",
    "status": "Status",
}
ARRIVAL_COLUMN_LABELS = {
    "flight_code": "Numer lotu",
    "airline_name": "Linia lotnicza",
    "departure_airport": "Kod lotniska",
    "dep_airport_name": "Lotnisko pochodzenia",
    "last_updated_utc": "Ostatnia aktualizacja",
    "status": "Status",
    "lat": "Szerokość geogr.",
    "lng": "Długość geogr.",
}
WEEKDAY_LABELS = {
    1: "Poniedziałek",
    2: "Wtorek",
    3: "Środa",
    4: "Czwartek",
    5: "Piątek",
    6: "Sobota",
    7: "Niedziela",
}
UNKNOWN_LABEL = "Nieznany"
DEPARTURES_DIRECTION = "Z Krakowa"
ARRIVALS_DIRECTION = "Do Krakowa"


def delays_by_hour(schedules: DataFrame) -> DataFrame:
    """A4: rounded mean departure delay and count per UTC hour."""
    return (schedules.groupBy(hour_utc("scheduled_departure_utc").alias("departure_hour_utc"))
                     .agg(round2(F.avg("departure_delay_mins")).alias("avg_delay_mins"),
                          F.count(F.lit(1)).alias("flight_count"))
                     .orderBy("departure_hour_utc"))


def weekday_patterns(schedules: DataFrame | None, arrivals: DataFrame | None) -> DataFrame | None:
    """Per direction and UTC weekday, total rows and mean rows per
    calendar day that has rows (days without rows are not zeros).

    Both inputs are one stream of (direction, day): rows over distinct days is
    the mean, so counting by day and summing those counts is all there is."""
    sides = [(schedules, "scheduled_departure_utc", DEPARTURES_DIRECTION),
             (arrivals, "last_updated_utc", ARRIVALS_DIRECTION)]
    days = [df.select(F.lit(label).alias("direction"), F.to_date(ts).alias("d"))
            for df, ts, label in sides if df is not None and ts in df.columns]
    if not days:
        return None
    counted = reduce(DataFrame.unionByName, days).groupBy("direction", "d").agg(F.count("*").alias("n"))
    weeks = counted.groupBy("direction", iso_weekday("d").alias("weekday"))
    return weeks.agg(F.sum("n").alias("flight_count"),
                     (F.sum("n") / F.count("*")).alias("avg_flights_per_day")) \
        .withColumn("weekday_label", value_map("weekday", WEEKDAY_LABELS, UNKNOWN_LABEL)) \
        .orderBy("direction", "weekday")


def kpis(schedules: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Departures, arrivals, mean delay (0 when none) and distinct
    destinations (a null destination counts as one value).

    One aggregation over the two inputs tagged by side (no join)."""
    tagged = schedules.select(F.lit(0).alias("side"), "departure_delay_mins",
                              "arrival_airport").unionByName(
        arrivals.select(F.lit(1).alias("side"),
                        F.lit(None).cast("int").alias("departure_delay_mins"),
                        F.lit(None).cast("string").alias("arrival_airport")))
    dep = F.col("side") == 0
    return tagged.agg(
        F.count_if(dep).alias("departures"),
        F.count_if(~dep).alias("arrivals"),
        F.coalesce(F.avg(F.when(dep, F.col("departure_delay_mins"))), F.lit(0.0))
         .alias("avg_delay_mins"),
        (F.count_distinct(F.when(dep, F.col("arrival_airport")))
         + F.coalesce(F.max(F.when(dep, F.col("arrival_airport").isNull().cast("int"))),
                      F.lit(0)).cast("long")).alias("active_routes"))


def flight_table(df: DataFrame, sort_column: str, airline_filter: str | None,
                 airport_filter: str | None, code_column: str, name_column: str,
                 columns: list[str]) -> DataFrame:
    """Newest first (nulls first), two text filters, visible columns."""
    out = df
    if sort_column in out.columns:
        out = out.orderBy(F.desc_nulls_first(sort_column))
    out = filter_text(out, "airline_name", airline_filter)
    out = filter_code_or_name(out, code_column, name_column, airport_filter)
    return visible_columns(out, columns)


def departures_table(schedules: DataFrame, airline_filter=None, airport_filter=None) -> DataFrame:
    return flight_table(schedules, "scheduled_departure_utc", airline_filter, airport_filter,
                        "arrival_airport", "arr_airport_name", DEPARTURE_COLUMNS)


def arrivals_table(arrivals: DataFrame, airline_filter=None, airport_filter=None) -> DataFrame:
    return flight_table(arrivals, "last_updated_utc", airline_filter, airport_filter,
                        "departure_airport", "dep_airport_name", ARRIVAL_COLUMNS)


def visible_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select([c for c in columns if c in df.columns])


def with_labels(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Display labels for export."""
    return df.withColumnsRenamed({k: v for k, v in labels.items() if k in df.columns})


def top_k(df: DataFrame, k: int, by: str, tie: str) -> DataFrame:
    """First ``k`` rows by ``by`` desc then ``tie`` asc
    (TakeOrderedAndProject: a bounded heap per task, no full sort)."""
    return df.orderBy(F.desc_nulls_first(by), F.asc(tie)).limit(k)


def load_dashboard_tables(spark, silver_base: str, raw_arrivals_base: str, dict_base: str,
                          start: date, end: date, persist: bool = False) -> dict:
    """Departures (silver schedules), live positions (silver flights)
    and arrivals (raw arrival snapshots through C4) for local days
    ``start..end``.  Only the padded days are read: Hive partitions of silver (S7)
    and ``YYYY/MM/DD`` snapshot folders, JSON and Parquet, of bronze (S8).  With
    ``persist`` the frames are cached; the caller releases them."""
    from contrail import schemas as S
    from contrail.operators.filters import filter_local_date_range
    from contrail.plans import silver as SV
    from contrail.sources import raw as RAW
    from contrail.sources import tables as TB

    airports = RAW.load_dictionary(spark, f"{dict_base}/airports")
    airlines = RAW.load_dictionary(spark, f"{dict_base}/airlines")
    sched = TB.read_silver_range(spark, f"{silver_base}/schedules", start, end)
    flights = TB.read_silver_range(spark, f"{silver_base}/flights", start, end)
    raw_arr = TB.read_raw_range(spark, raw_arrivals_base, start, end)
    arrivals = SV.transform_arrivals(raw_arr, airports, airlines, RAW.FILE_ORDER) if raw_arr is not None \
        else spark.createDataFrame([], S.ARRIVALS)
    out = {
        "schedules": filter_local_date_range(sched, "scheduled_departure_utc", start, end),
        "flights": filter_local_date_range(flights, "last_updated_utc", start, end),
        "arrivals": filter_local_date_range(arrivals, "last_updated_utc", start, end),
    }
    if persist:
        out = {k: v.persist() for k, v in out.items()}
    return out
