"""Gold refreshed by day equals the full build after every batch."""

from datetime import timedelta

from pyspark.sql import functions as F

from contrail.plans import analogues as A
from contrail.plans import jobs, refresh
from contrail.sources import raw as RAW
from contrail.sources import tables as TB

SF = "/root/testdata/sf0.001"
TOLERANCE = timedelta(hours=1)


def rows(df):
    names = sorted(df.columns)
    return sorted(repr(tuple(r[c] for c in names)) for r in df.select(*names).collect())


def test_late_batches(spark, tmp_dir):
    silver, dicts = f"{tmp_dir}/silver", f"{tmp_dir}/dict"
    for name, fn in (("airports", A.airports), ("airlines", A.airlines), ("fleets", A.fleets)):
        RAW.load_dictionary(spark, f"{dicts}/{name}", fetch=lambda fn=fn: fn(spark, SF))
    tables = {"schedules": (A.schedules(spark, SF).checkpoint(), "scheduled_departure_utc"),
              "flights": (A.flights(spark, SF).checkpoint(), "last_updated_utc"),
              "weather": (A.weather(spark, SF).checkpoint(), "observation_time_utc")}
    df, col = tables["schedules"]
    every = [r.d for r in df.select(F.to_date(col).alias("d")).distinct().orderBy("d").limit(6).collect()]
    tables = {name: (df.where(F.to_date(col) <= every[-1]), col) for name, (df, col) in tables.items()}
    late = every[len(every) // 2]

    def write(name, keep):
        df, col = tables[name]
        TB.write_partitioned(df.where(keep(F.to_date(col))), col, f"{silver}/{name}")

    def check(steps):
        days = refresh.refresh_gold(spark, silver, dicts, f"{tmp_dir}/fresh", A.ORIGIN, weather_tolerance=TOLERANCE)
        full = f"{tmp_dir}/full{steps}"
        jobs.process_gold_layer(spark, silver, dicts, full, A.ORIGIN, TOLERANCE)
        for name in ("airline_performance", "weather_impact", "hourly_traffic", "active_routes"):
            assert rows(spark.read.parquet(f"{tmp_dir}/fresh/{name}")) == rows(spark.read.parquet(f"{full}/{name}")), name
        by_day = spark.read.parquet(f"{tmp_dir}/fresh/weather_correlation_by_day").drop("on", *TB.PARTITION_COLS)
        assert rows(by_day) == rows(spark.read.parquet(f"{full}/weather_correlation"))
        return days

    for name in tables:
        write(name, lambda d: d != late)
    assert len(check(0)) == len(every) - 1
    write("schedules", lambda d: d == late)
    write("flights", lambda d: d == late)
    near = [d for d in every if abs((d - late).days) <= 1]
    assert check(1) == near and len(near) < len(every)
    assert refresh.refresh_gold(spark, silver, dicts, f"{tmp_dir}/fresh", A.ORIGIN, weather_tolerance=TOLERANCE) == []
