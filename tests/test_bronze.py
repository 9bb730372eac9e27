"""Nothing is lost or invented between bronze and silver."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from contrail import schemas as S
from contrail.plans import jobs
from contrail.plans import silver as SV
from contrail.sources import raw as RAW
from contrail.sources import tables as TB
from contrail.streaming import incremental as inc

A1, A2 = {"flight_iata": "LO1", "updated": 5}, {"flight_iata": "LO2", "updated": 6.5}


def put(path, payload):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload, indent=2))


@pytest.mark.parametrize("payload,codes", [
    ({"response": [A1, A2]}, ["LO1", "LO2"]), ({"response": A1}, ["LO1"]), ([A1, A2], ["LO1", "LO2"]), (A1, ["LO1"]),
    ({"response": None}, []), ({"response": []}, []), ({}, []), ([], []), ("null", []), ("5", []),
    ({"error": None, **A1}, []), ({"error": {"message": "x"}}, []), ({"error.message": "x", **A1}, []),
    ({"cod": "month_limit_exceeded", **A1}, []), ({"cod": "200", **A1}, ["LO1"]),
    ({**A1, "inner": {"cod": "month_limit_exceeded", "error": 1}}, ["LO1"])])
@pytest.mark.parametrize("name", ["101500.json", "part-00000-x.json"])
def test_payloads_whatever_the_file_is_called(spark, tmp_dir, payload, codes, name):
    put(f"{tmp_dir}/b/{name}", payload)
    out = RAW.read_raw_json(spark, f"{tmp_dir}/b")
    assert sorted(r.flight_iata for r in out.collect()) == codes if codes else out.count() == 0


@pytest.mark.parametrize("cod,kept", [(None, True), (200, True), (200.0, True), ("200", False), (401, False),
                                      ("month_limit_exceeded", False), (True, False), ("absent", True)])
def test_weather_payloads(spark, tmp_dir, cod, kept):
    body = {"cod": cod, "name": "K", "main": {"temp": 1.5, "cod": "404"}, "weather": [{"cod": "x"}]}
    if cod == "absent":
        del body["cod"]
    put(f"{tmp_dir}/w/1.json", body)
    out = RAW.read_raw_json(spark, f"{tmp_dir}/w", weather=True)
    assert [r["main.temp"] for r in out.collect()] == ([1.5] if kept else [])


def test_json_lines_and_documents_side_by_side(spark, tmp_dir):
    put(f"{tmp_dir}/m/lines.json", "\n".join(map(json.dumps, [A1, {"error": "x"}, {"response": [A2, A2]}])))
    put(f"{tmp_dir}/m/doc.json", [A1])
    put(f"{tmp_dir}/m/broken.json", json.dumps(A1) + "\n{cut")
    put(f"{tmp_dir}/m/broken.parquet", "PAR1 no footer PAR1")
    put(f"{tmp_dir}/m/empty.json", "")
    spark.createDataFrame([("LO9", "12")], "flight_iata string, updated string").coalesce(1).write.parquet(f"{tmp_dir}/m/p")
    out = RAW.read_raw(spark, f"{tmp_dir}/m")
    assert sorted(r.flight_iata for r in out.collect()) == ["LO1", "LO1", "LO2", "LO2", "LO9"]
    assert dict(out.dtypes)["updated"] == "string"  # text in one file, numbers in the others
    assert sorted(os.path.basename(r.path) for r in RAW.unreadable_files(spark, f"{tmp_dir}/m").collect()) == [
        "broken.json", "broken.parquet"]


def test_one_folder_with_several_schemas(spark, tmp_dir):
    for name, ddl, row in (("a", "x bigint", (1,)), ("b", "x double", (2.5,)), ("c", "x bigint, y string", (3, "z")),
                           ("d", "error string", ("no",))):
        spark.createDataFrame([row], ddl).coalesce(1).write.parquet(f"{tmp_dir}/t/{name}")
        part = next(f for f in os.listdir(f"{tmp_dir}/t/{name}") if f.endswith(".parquet"))
        os.makedirs(f"{tmp_dir}/one", exist_ok=True)
        with open(f"{tmp_dir}/t/{name}/{part}", "rb") as src, open(f"{tmp_dir}/one/{name}.parquet", "wb") as dst:
            dst.write(src.read())
    out = RAW.read_raw_parquet(spark, f"{tmp_dir}/one")
    assert sorted((r.x, r.y) for r in out.collect()) == [(1.0, None), (2.5, None), (3.0, "z")]


def weather(name, hour, temp, **more):
    return {"cod": 200, "name": name, "dt": None if hour is None else 1_750_000_000 + 3600 * hour,
            "main": {"temp": temp, "feels_like": temp, "pressure": 1000, "humidity": 50}, "wind": {"speed": 2.0},
            "clouds": {"all": 1}, "visibility": 9000, **more}


def bronze(spark, base):
    """JSON and Parquet, a late correction, an error and a record without a date."""
    put(f"{base}/weather/KRK/2025/06/01/120000.json", weather("K", 1, 10.0))
    put(f"{base}/weather/KRK/2025/06/01/110000.json", weather("K", 1, 20.0))  # older, listed later or not
    put(f"{base}/weather/KRK/2025/06/01/130000.json", weather("K", None, 5.0))
    put(f"{base}/weather/KRK/2025/06/02/090000.json", {"cod": 429, "message": "slow down"})
    rows = [("K", 1_750_000_000 + 7200, 30, 30.0, 1000, 50, 2.0, 1, 9000)]
    TB.land_snapshot(spark.createDataFrame(
        rows, "name string, dt bigint, `main.temp` bigint, `main.feels_like` double, `main.pressure` bigint, "
              "`main.humidity` bigint, `wind.speed` double, `clouds.all` bigint, visibility bigint"),
        f"{base}/weather/KRK", datetime(2025, 6, 2, 10))


def test_silver_job_keeps_every_record(spark, tmp_dir):
    bronze(spark, f"{tmp_dir}/raw")
    got = jobs.process_silver_layer(spark, f"{tmp_dir}/raw", f"{tmp_dir}/dict", f"{tmp_dir}/silver")
    assert got["schedules"] is None and got["flights"] is None
    assert got["weather"] == {"row_count": 3, "no_date": 1, "unreadable_files": 0}
    silver = TB.read_silver(spark, f"{tmp_dir}/silver/weather", S.WEATHER)
    assert silver.schema == S.WEATHER
    assert sorted(r.temp_celsius for r in silver.collect()) == [10.0, 30.0]
    lost = spark.read.parquet(TB.quarantine_path(f"{tmp_dir}/silver/weather")).collect()
    assert [r.temp_celsius for r in lost] == [5.0]


def test_checks_come_before_the_write(spark, tmp_dir):
    base = f"{tmp_dir}/raw/schedules/KRK"
    put(f"{base}/2025/06/01/100000.json", {"response": [{
        "flight_iata": "LO1", "status": "s", "dep_iata": "KRK", "arr_iata": "WAW", "airline_iata": "LO",
        "dep_time_ts": 1_750_000_000, "arr_time_ts": 1_750_003_600, "dep_delayed": 1, "arr_delayed": None}]})
    run = lambda: jobs.process_silver_layer(spark, f"{tmp_dir}/raw", f"{tmp_dir}/dict", f"{tmp_dir}/silver")
    assert run()["schedules"]["row_count"] == 1
    before = TB.read_silver(spark, f"{tmp_dir}/silver/schedules").collect()
    put(f"{base}/2025/06/01/100000.json", {"response": [{
        "flight_iata": None, "status": "s", "dep_iata": None, "arr_iata": None, "airline_iata": "LO",
        "dep_time_ts": 1_750_000_000, "arr_time_ts": 1_750_003_600, "dep_delayed": 1, "arr_delayed": None}]})
    with pytest.raises(AssertionError):
        run()
    assert TB.read_silver(spark, f"{tmp_dir}/silver/schedules").collect() == before


def test_stream_equals_batch_when_the_older_snapshot_arrives_last(spark, tmp_dir):
    raw, base, ckpt = f"{tmp_dir}/s/weather/KRK", f"{tmp_dir}/silver", f"{tmp_dir}/ckpt"

    def run():
        inc.incremental_silver(spark, raw, None, lambda b: SV.clean_weather(b, ingest=True), base,
                               ["airport_city", "observation_time_utc"], "observation_time_utc",
                               checkpoint=ckpt, weather=True).awaitTermination()

    put(f"{raw}/2025/06/01/120000.json", weather("K", 1, 10.0))
    run()
    put(f"{raw}/2025/06/01/110000.json", weather("K", 1, 20.0))
    put(f"{raw}/2025/06/01/113000.json", weather("K", None, 7.0))
    put(f"{raw}/2025/06/01/114500.json", {"cod": 500})
    run()
    batch = jobs.process_silver_layer(spark, f"{tmp_dir}/s", f"{tmp_dir}/dict", f"{tmp_dir}/batch")
    assert batch["weather"]["row_count"] == 2
    stream = TB.read_silver(spark, base, S.WEATHER).collect()
    assert stream == TB.read_silver(spark, f"{tmp_dir}/batch/weather", S.WEATHER).collect()
    assert [r.temp_celsius for r in stream] == [10.0]
    assert spark.read.parquet(TB.quarantine_path(base)).count() == 1


def test_silver_types_are_enforced_and_drift_is_aligned(spark, tmp_dir):
    fleets = spark.createDataFrame([("R1", "Maker", "M", 2010.0, 15.0)],
                                   "reg_number string, manufacturer string, model string, built double, age double")
    raw = spark.createDataFrame([("F1", "R1", "h", 1.0, 2.0, 3, 4.0, 5.0, "s", "LO", 1_750_000_000)],
                                "flight_iata string, reg_number string, hex string, lat double, lng double, alt bigint, "
                                "speed double, dir double, status string, airline_iata string, updated bigint")
    flights = SV.clean_flights(raw, fleets)
    assert flights.schema == S.FLIGHTS
    TB.write_partitioned(flights, "last_updated_utc", f"{tmp_dir}/f")
    drifted = flights.withColumn("aircraft_built_year", F.col("aircraft_built_year").cast("double")) \
        .withColumn("last_updated_utc", F.expr("last_updated_utc + interval 1 day"))
    TB.write_partitioned(drifted, "last_updated_utc", f"{tmp_dir}/f")
    back = TB.read_silver(spark, f"{tmp_dir}/f", S.FLIGHTS)
    assert back.schema == S.FLIGHTS and [r.aircraft_built_year for r in back.collect()] == [2010, 2010]


def test_running_values_match_plain_python(spark):
    from contrail.operators.ordering import running, with_row_number
    rows = [(k, "ab"[k % 2], datetime(2030, 1, 1 + k // 10, k % 7), float(k * k % 13)) for k in range(40)]
    rows += [(99, None, None, None)]
    got = running(spark.createDataFrame(rows, "id int, who string, ts timestamp_ntz, v double"), "who", "ts", "id", "v").collect()
    for who in "ab":
        mine = sorted((r for r in rows if r[1] == who), key=lambda r: (r[2], r[0]))
        by_id = {r.id: r for r in got}
        total = 0.0
        for n, r in enumerate(mine):
            total += r[3]
            row = by_id[r[0]]
            assert (row.row_index, row.running) == (n, total)
            assert row["diff"] == (None if n == 0 else r[3] - mine[n - 1][3])
    placed = with_row_number(spark.range(100).repartition(7).orderBy(F.desc("id")), "n").collect()
    assert all(r.n == 100 - r.id for r in placed)


def test_unreadable_files_are_counted_on_the_way(spark, tmp_dir):
    from contrail.sources import versions as VS
    bronze(spark, f"{tmp_dir}/raw")
    for name in ("a.json", "b.json", "c.parquet"):
        with open(f"{tmp_dir}/raw/weather/KRK/{name}", "w") as out:
            out.write("{broken")
    os.makedirs(f"{tmp_dir}/raw/schedules/KRK")
    with open(f"{tmp_dir}/raw/schedules/KRK/d.json", "w") as out:
        out.write("{broken")
    seen = RAW.Unreadable()
    assert RAW.read_raw(spark, f"{tmp_dir}/raw/schedules/KRK", unreadable=seen) is None and seen.count() == 1
    got = jobs.process_silver_layer(spark, f"{tmp_dir}/raw", f"{tmp_dir}/dict", f"{tmp_dir}/silver", versions=True)
    assert got["weather"] == {"row_count": 3, "no_date": 1, "unreadable_files": 3}
    base = f"{tmp_dir}/silver/weather"
    assert sorted(r.temp_celsius for r in VS.read_version(spark, base, S.WEATHER).collect()) == [10.0, 30.0]
    assert [r.temp_celsius for r in VS.read_undated(spark, base).collect()] == [5.0]
