"""Silver cleaning (C1-C4), mirroring the reference's silver fixtures."""

from datetime import datetime

from contrail.plans import silver as SV

SCHED = ("flight_iata string, status string, dep_iata string, arr_iata string, airline_iata string, "
         "dep_time_ts bigint, arr_time_ts bigint, dep_delayed double, arr_delayed double, "
         "ingest_order long")


def airports(spark):
    return spark.createDataFrame(
        [("KRK", "Krakow Airport", 50.07, 19.78, "PL"), ("WAW", "Warsaw Chopin Airport", 52.16, 20.96, "PL"),
         ("GDN", "Gdansk Airport", 54.37, 18.46, "PL")],
        "iata_code string, name string, lat double, lng double, country_code string")


def airlines(spark):
    return spark.createDataFrame([("LO", "LOT"), ("FR", "Ryanair")], "iata_code string, name string")


def test_schedules_dedup_joins_and_defaults(spark):
    raw = spark.createDataFrame([
        ("LO3905", "scheduled", "KRK", "WAW", "LO", 1748780400, 1748784000, None, None, 1),
        ("LO3905", "delayed", "KRK", "WAW", "LO", 1748780400, 1748784000, 15.0, None, 2),
        ("FR123", "scheduled", "KRK", "GDN", "FR", 1748790400, 1748794000, 5.5, 3.0, 3),
    ], SCHED)
    out = SV.clean_schedules(raw, airports(spark), airlines(spark))
    rows = {r.flight_code: r for r in out.collect()}
    assert len(rows) == 2
    lo = rows["LO3905"]
    assert lo.status == "delayed" and lo.departure_delay_mins == 15  # keep last
    assert lo.arrival_delay_mins == 0  # null -> 0
    assert lo.dep_airport_name == "Krakow Airport" and lo.airline_name == "LOT"
    assert lo.scheduled_departure_utc == datetime(2025, 6, 1, 12, 20)
    assert rows["FR123"].departure_delay_mins == 5  # truncated


def test_schedules_duplicate_dictionary_fans_out(spark):
    raw = spark.createDataFrame(
        [("LO1", "s", "KRK", "WAW", "LO", 1748780400, 1748784000, 1.0, 1.0, 1)], SCHED)
    dup = airports(spark).unionByName(airports(spark).where("iata_code = 'WAW'"))
    assert SV.clean_schedules(raw, dup, airlines(spark)).count() == 2


def test_schedules_null_keys_dropped_and_string_numbers(spark):
    raw = spark.createDataFrame([
        ("LO1", "s", "KRK", None, "LO", "1748780400", "1748784000", "15.0", None, 1),
        ("LO2", "s", "KRK", "WAW", "LO", "1748780400.0", "1748784000", "15.9", None, 2)],
        "flight_iata string, status string, dep_iata string, arr_iata string, airline_iata string, "
        "dep_time_ts string, arr_time_ts string, dep_delayed string, arr_delayed string, ingest_order long")
    rows = SV.clean_schedules(raw, None, None).collect()
    assert [r.flight_code for r in rows] == ["LO2"]
    assert rows[0].departure_delay_mins == 15 and rows[0].airline_name is None


def test_flights_fleet_join(spark):
    raw = spark.createDataFrame([
        ("FR123", "SP-RSA", "abc", 50.1, 19.8, 35000, 450.0, 90.0, "en-route", "FR", 1748780400, 1),
        ("LO3905", "SP-LWA", "def", 51.0, 20.0, 30000, 420.0, 45.0, "en-route", "LO", 1748780400, 2)],
        "flight_iata string, reg_number string, hex string, lat double, lng double, alt bigint, "
        "speed double, dir double, status string, airline_iata string, updated bigint, ingest_order long")
    fleets = spark.createDataFrame([("SP-RSA", "Boeing", "Boeing 737 MAX 8", 2019, 6)],
                                   "reg_number string, manufacturer string, model string, built bigint, age bigint")
    rows = {r.flight_code: r for r in SV.clean_flights(raw, fleets).collect()}
    assert rows["FR123"].aircraft_model == "Boeing 737 MAX 8"
    assert rows["LO3905"].aircraft_model is None
    assert rows["FR123"].altitude_ft == 35000


def test_weather_dedup_and_dotted_columns(spark):
    raw = spark.createDataFrame([
        ("Krakow", 1748780400, 16.56, 15.0, 1012, 60, 3.5, 20, 10000, 1),
        ("Krakow", 1748780400, 16.56, 15.0, 1012, 60, 3.5, 20, 10000, 2)],
        "name string, dt bigint, `main.temp` double, `main.feels_like` double, `main.pressure` bigint, "
        "`main.humidity` bigint, `wind.speed` double, `clouds.all` bigint, visibility bigint, ingest_order long")
    rows = SV.clean_weather(raw).collect()
    assert len(rows) == 1 and rows[0].temp_celsius == 16.56 and rows[0].pressure_hpa == 1012


def test_arrivals_transform(spark):
    raw = spark.createDataFrame([
        ("FR1", "WAW", "KRK", "en-route", "FR", 50.0, 19.0, 1748780400, 1),
        ("FR1", "WAW", "KRK", "landed", "FR", 51.5, 19.5, 1748780400, 2)],
        "flight_iata string, dep_iata string, arr_iata string, status string, airline_iata string, "
        "lat double, lng double, updated bigint, ingest_order long")
    rows = SV.transform_arrivals(raw, airports(spark)).collect()
    assert len(rows) == 1 and rows[0].lat == 51.5 and rows[0].status == "landed"
    assert rows[0].dep_airport_name == "Warsaw Chopin Airport" and rows[0].airline_name is None
    with_names = SV.transform_arrivals(raw, airports(spark), airlines(spark)).collect()
    assert with_names[0].airline_name == "Ryanair"


def test_arrivals_without_updated_is_empty(spark):
    raw = spark.createDataFrame([("FR1", "WAW")], "flight_iata string, dep_iata string")
    out = SV.transform_arrivals(raw, airports(spark))
    assert out.count() == 0 and "last_updated_utc" in out.columns


def test_dq_checks(spark):
    df = spark.createDataFrame([("A",), (None,)], "flight_code string")
    m = SV.dq_metrics(df).collect()[0]
    assert m.row_count == 2 and m.null_keys == 1 and m.passed is False
    observed, obs = SV.observe_dq(df.where("flight_code is not null"), "t")
    observed.count()
    assert SV.assert_dq(obs, "schedules")["row_count"] == 1
