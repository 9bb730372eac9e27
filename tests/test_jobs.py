"""Silver (C8) and gold (C9) jobs end to end on landed files, plus the
catalog's contract (every query has a SQL oracle and distinct names)."""

from contrail import catalog
from contrail.plans import jobs
from contrail.sources import raw as RAW
from contrail.sources import tables as TB

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark, tmp_dir):
    from contrail.plans import analogues as A
    raw_base, dict_base = f"{tmp_dir}/raw", f"{tmp_dir}/dict"
    jobs.land_raw(A.raw_schedules(spark, SF), raw_base, "schedules/KRK")
    jobs.land_raw(A.raw_flights(spark, SF), raw_base, "flights/departures/KRK")
    jobs.land_raw(A.raw_weather(spark, SF), raw_base, "weather/KRK")
    for name, fn in (("airports", A.airports), ("airlines", A.airlines), ("fleets", A.fleets)):
        RAW.load_dictionary(spark, f"{dict_base}/{name}", fetch=lambda fn=fn: fn(spark, SF))
    metrics = jobs.process_silver_layer(spark, raw_base, dict_base, f"{tmp_dir}/silver",
                                        order=["ingest_order"])
    assert metrics["schedules"]["row_count"] == A.schedules(spark, SF).count()
    # re-running is idempotent
    jobs.process_silver_layer(spark, raw_base, dict_base, f"{tmp_dir}/silver", order=["ingest_order"])
    assert TB.read_silver(spark, f"{tmp_dir}/silver/schedules").count() == metrics["schedules"]["row_count"]
    written = jobs.process_gold_layer(spark, f"{tmp_dir}/silver", dict_base, f"{tmp_dir}/gold",
                                      origin="NATION_0")
    assert set(written) == {"active_routes", "airline_performance", "hourly_traffic",
                            "weather_correlation", "weather_impact"}
    assert TB.load_gold(spark, f"{tmp_dir}/gold", "airline_performance").count() > 0


def test_catalog_contract():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert len(catalog.QUERIES) >= 100
