"""Gold tables (C5) on a small airport of our own."""

from datetime import datetime, timedelta

import pytest

from contrail.plans import gold as G
from contrail.operators.joins import join_airlines

NOON = datetime(2031, 3, 4, 12)
HOME = "GDN"


def at(hours, days=0):
    return NOON + timedelta(hours=hours, days=days)


@pytest.fixture
def tables(spark):
    schedules = spark.createDataFrame(
        [(code, HOME, to, line, at(h, d), delay) for code, to, line, h, d, delay in [
            ("AA1", "OSL", "AA", 0, 0, 4), ("AA1", "OSL", "AA", 0, 1, 9), ("AA1", "OSL", "AA", 0, 2, 30),
            ("BB7", "VNO", "BB", 1, 0, 12), ("CC3", "NOL", None, 1.5, 0, 7), ("DD2", "OSL", "DD", 9, 0, 1)]],
        "flight_code string, departure_airport string, arrival_airport string, airline_code string, "
        "scheduled_departure_utc timestamp_ntz, departure_delay_mins int")
    flights = spark.createDataFrame(
        [(code, f"REG-{code}", 54.4, 18.5, at(h, d)) for code, h, d in [
            ("AA1", 0.25, 0), ("AA1", -0.5, 1), ("AA1", 13, 2), ("BB7", 1.5, 0), ("CC3", 2, 0), ("DD2", 9.1, 0)]],
        "flight_code string, reg_number string, lat double, lng double, last_updated_utc timestamp_ntz")
    weather = spark.createDataFrame(
        [("Gdansk", at(0.5), -3.5, 1.0, 900), ("Gdansk", at(1.25), 4.9, 7.9, 3000), ("Gdansk", at(0, 1), 5.0, 8.0, 8000)],
        "airport_city string, observation_time_utc timestamp_ntz, temp_celsius double, wind_speed_mps double, "
        "visibility_meters int")
    airlines = spark.createDataFrame([("AA", "Amber Air"), ("BB", "Baltic Blue")], "iata_code string, name string")
    airports = spark.createDataFrame(
        [(HOME, "Home", 54.4, 18.5), ("OSL", "Oslo", 60.2, 11.1), ("VNO", "Vilnius", 54.6, 25.3), ("NOL", "Nowhere", None, 1.0)],
        "iata_code string, name string, lat double, lng double")
    return schedules, flights, weather, airlines, airports


def test_each_departure_meets_the_position_of_its_own_day(tables):
    facts = {(r.flight_code, r.scheduled_departure_utc): r.last_updated_utc
             for r in G.schedule_flight_facts(*tables[:2]).collect()}
    assert len(facts) == 6
    assert [facts["AA1", at(0, d)] for d in range(3)] == [at(0.25), at(-0.5, 1), None]  # 13 h is too far


def test_performance_counts_matched_flights_only(tables):
    schedules, flights, _, airlines, _ = tables
    rows = G.airline_performance(G.schedule_flight_facts(schedules, flights), airlines).collect()
    assert [(r.airline_code, r.airline_name, r.avg_departure_delay_mins, r.total_flights) for r in rows] == [
        ("AA", "Amber Air", 6.5, 2), ("BB", "Baltic Blue", 12.0, 1), ("DD", None, 1.0, 1)]


def test_weather_bands(tables):
    schedules, flights, weather, *_ = tables
    corr = G.weather_correlation(G.schedule_flight_facts(schedules, flights), weather)
    flagged = {(r.flight_code, r.last_updated_utc): r.has_weather_match for r in corr.collect()}
    assert len(flagged) == 5 and not flagged["DD2", at(9.1)]
    got = {(r.metric, r.bucket_label): (r.avg_departure_delay_mins, r.flight_count)
           for r in G.weather_impact(corr).collect()}
    assert got["temperature_celsius", "-5-0 C"] == (4.0, 1)
    assert got["temperature_celsius", "0-5 C"] == (9.5, 2)
    assert got["wind_speed_mps", "8-10 m/s"] == (9.0, 1)
    assert got["visibility_level", "low"] == (4.0, 1)
    assert got["visibility_level", "medium"] == (9.5, 2)
    assert got["visibility_level", "high"] == (9.0, 1)


def test_routes_need_both_places(tables):
    schedules, *_, airports = tables
    rows = G.active_routes(schedules, airports, origin=HOME).collect()
    assert [(r.arrival_airport, r.flight_count) for r in rows] == [("OSL", 4), ("VNO", 1)]
    assert rows[0].last_scheduled_departure_utc == at(0, 2)
    hours = {r.departure_hour_utc: r.flight_count for r in G.hourly_traffic(schedules).collect()}
    assert hours == {12: 3, 13: 2, 21: 1}


def test_five_tables(tables):
    schedules, flights, weather, airlines, airports = tables
    assert sorted(G.build_gold_datasets(schedules, flights, weather, airlines, airports)) == sorted(G.GOLD_DATASETS)


def test_unknown_weather_values_have_no_band(spark):
    corr = spark.createDataFrame([(True, 3, None, None, None)],
                                 "has_weather_match boolean, departure_delay_mins int, temp_celsius double, "
                                 "wind_speed_mps double, visibility_meters int")
    rows = {r.metric: r for r in G.weather_impact(corr).collect()}
    assert rows["temperature_celsius"].bucket_label is None
    assert rows["visibility_level"].bucket_label == "high"


def test_nothing_in_nothing_out(tables):
    schedules, flights, weather, airlines, airports = tables
    facts = G.schedule_flight_facts(schedules, flights)
    corr = G.weather_correlation(facts, weather.limit(0))
    assert corr.count() == 0 and "has_weather_match" in corr.columns
    assert G.weather_impact(corr).count() == 0
    assert G.airline_performance(G.schedule_flight_facts(schedules, flights.limit(0)), airlines).count() == 0
    assert G.active_routes(schedules, airports.limit(0), origin=HOME).count() == 0


def test_last_row_of_a_dictionary_wins_by_place_in_the_files(spark):
    facts = spark.createDataFrame([("AA",), ("ZZ",)], "airline_code string")
    lines = spark.createDataFrame(
        [("AA", "Zulu first", "d/1.parquet", 0), ("AA", "Alpha last", "d/2.parquet", 0), ("AA", "Middle", "d/1.parquet", 7)],
        "iata_code string, name string, file_path string, record_pos long")
    got = {r.airline_code: r.airline_name for r in join_airlines(facts, lines, dedup_order=[]).collect()}
    assert got == {"AA": "Alpha last", "ZZ": None}
