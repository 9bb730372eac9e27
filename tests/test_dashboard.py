"""Date filters, dashboard aggregates and flight tables."""

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from contrail.functions.time import LOCAL_TZ, partition_load_range
from contrail.operators import filters
from contrail.plans import dashboard as D

COL = "scheduled_departure_utc"


@pytest.fixture
def departures(spark):
    """Every seven hours over two weeks of winter."""
    start = datetime(2030, 1, 7, 3)
    return spark.createDataFrame([(f"T{k}", start + timedelta(hours=7 * k), k % 4) for k in range(48)],
                                 f"flight_code string, {COL} timestamp_ntz, departure_delay_mins int")


def local_day(utc):
    return utc.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(LOCAL_TZ)).date()


@pytest.mark.parametrize("first,last", [(7, 7), (8, 12), (19, 31), (12, 9)])
def test_local_date_range(departures, first, last):
    start, end = date(2030, 1, first), date(2030, 1, last)
    want = {r.flight_code for r in departures.collect() if start <= local_day(r[COL]) <= end}
    got = filters.filter_local_date_range(departures, COL, start, end).collect()
    assert {r.flight_code for r in got} == want
    assert bool(want) == (first <= last and first < 21)


@pytest.mark.parametrize("day,length", [(date(2030, 2, 1), 24), (date(2030, 3, 31), 23), (date(2030, 10, 27), 25),
                                        (date(2030, 7, 1), 24)])
def test_local_days_start_and_end_at_local_midnight(spark, day, length):
    midnight = datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(LOCAL_TZ)).astimezone(timezone.utc)
    inside = [midnight, midnight + timedelta(hours=length, seconds=-1)]
    outside = [midnight - timedelta(seconds=1), midnight + timedelta(hours=length)]
    for kind, rows in (("timestamp", inside + outside),
                       ("timestamp_ntz", [t.replace(tzinfo=None) for t in inside + outside])):
        df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], f"k int, {COL} {kind}")
        assert {r.k for r in filters.filter_local_day(df, COL, day).collect()} == {0, 1}


def test_local_filter_pushes_down(spark, tmp_dir, departures):
    departures.write.parquet(tmp_dir + "/s")
    df = filters.filter_local_date_range(spark.read.parquet(tmp_dir + "/s"), COL, date(2030, 1, 9), date(2030, 1, 9))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"PushedFilters: [IsNotNull({COL}), GreaterThanOrEqual" in plan


def test_unknown_column_unchanged(departures):
    assert filters.filter_local_date_range(departures, "nope", date(2030, 1, 9), date(2030, 1, 9)).count() == 48


def test_range_is_padded_by_a_day():
    assert partition_load_range(date(2032, 3, 1), date(2032, 12, 31)) == (date(2032, 2, 29), date(2033, 1, 1))


def test_delays_by_hour(departures):
    rows = D.delays_by_hour(departures).collect()
    hours = [r.departure_hour_utc for r in rows]
    assert hours == sorted(hours) and sum(r.flight_count for r in rows) == 48
    three = [r.departure_delay_mins for r in departures.collect() if r[COL].hour == 3]
    assert (rows[hours.index(3)].avg_delay_mins, rows[hours.index(3)].flight_count) == (
        round(sum(three) / len(three), 2), len(three))


def test_weekday_patterns(spark, departures):
    arrivals = spark.createDataFrame([("X", datetime(2030, 1, 13, 1)), ("Y", datetime(2030, 1, 20, 1)), ("Z", datetime(2030, 1, 20, 2))],
                                     "flight_code string, last_updated_utc timestamp_ntz")
    rows = D.weekday_patterns(departures, arrivals).collect()
    days = {}
    for r in departures.collect():
        days.setdefault(r[COL].isoweekday(), {}).setdefault(r[COL].date(), []).append(r)
    for r in rows:
        if r.direction == D.DEPARTURES_DIRECTION:
            counts = [len(x) for x in days[r.weekday].values()]
            assert (r.flight_count, r.avg_flights_per_day) == (sum(counts), sum(counts) / len(counts))
    inbound = [r for r in rows if r.direction == D.ARRIVALS_DIRECTION]
    assert [(r.weekday, r.flight_count, r.avg_flights_per_day, r.weekday_label) for r in inbound] == [
        (7, 3, 1.5, D.WEEKDAY_LABELS[7])]
    assert D.weekday_patterns(None, arrivals.drop("last_updated_utc")) is None


def test_kpis(spark):
    s = spark.createDataFrame([(6, "OSL"), (9, None), (None, "OSL"), (3, "VNO")],
                              "departure_delay_mins int, arrival_airport string")
    a = spark.createDataFrame([(1,), (2,)], "x int")
    k = D.kpis(s, a).collect()[0]
    assert (k.departures, k.arrivals, k.avg_delay_mins, k.active_routes) == (4, 2, 6.0, 3)
    none = D.kpis(s.limit(0), a.limit(0)).collect()[0]
    assert (none.departures, none.avg_delay_mins, none.active_routes) == (0, 0.0, 0)


def test_text_filters(spark):
    df = spark.createDataFrame([("A1", "Amber Air", "OSL", "Oslo"), ("B2", "Baltic (Blue)", "VNO", None), ("C3", None, "NOL", "Nolan field")],
                               "flight_code string, airline_name string, arrival_airport string, arr_airport_name string")
    codes = lambda x: [r.flight_code for r in x.collect()]
    assert codes(filters.filter_text(df, "airline_name", "AMBER")) == ["A1"]
    assert codes(filters.filter_text(df, "airline_name", "c (b")) == ["B2"]  # literal, no pattern
    assert codes(filters.filter_text(df, "airline_name", "a.b")) == []
    assert len(codes(filters.filter_text(df, "airline_name", ""))) == 3
    assert len(codes(filters.filter_text(df, "no such column", "x"))) == 3
    assert codes(filters.filter_code_or_name(df, "arrival_airport", "arr_airport_name", "no")) == ["B2", "C3"]
    assert codes(D.departures_table(df, airline_filter="b", airport_filter="o")) == ["A1", "B2"]
