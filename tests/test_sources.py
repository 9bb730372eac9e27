"""Sources and sinks (S1-S17) on temporary files."""

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.sources import raw as RAW
from contrail.sources import tables as TB

REC = T.StructType([T.StructField("flight_iata", T.StringType()), T.StructField("updated", T.LongType())])


def _write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj))


def test_json_payloads(spark, tmp_dir):
    _write(f"{tmp_dir}/a/1.json", {"response": [{"flight_iata": "LO1", "updated": 1}, {"flight_iata": "LO2", "updated": 2}]})
    _write(f"{tmp_dir}/a/2.json", {"flight_iata": "FR1", "updated": 3})
    _write(f"{tmp_dir}/a/3.json", {"error": {"message": "bad key"}})
    _write(f"{tmp_dir}/a/4.json", {"cod": "month_limit_exceeded"})
    _write(f"{tmp_dir}/a/5.json", {"response": []})
    _write(f"{tmp_dir}/a/6.json", [{"flight_iata": "W61", "updated": 4}])
    out = RAW.read_raw_json(spark, f"{tmp_dir}/a", REC)
    assert sorted(r.flight_iata for r in out.collect()) == ["FR1", "LO1", "LO2", "W61"]


def test_weather_payloads(spark, tmp_dir):
    rec = T.StructType([T.StructField("cod", T.LongType()), T.StructField("name", T.StringType()),
                        T.StructField("main", T.StructType([T.StructField("temp", T.DoubleType())]))])
    _write(f"{tmp_dir}/w/1.json", {"cod": 200, "name": "Krakow", "main": {"temp": 16.56}})
    _write(f"{tmp_dir}/w/2.json", {"cod": "200", "name": "Krakow", "main": {"temp": 1.0}})
    _write(f"{tmp_dir}/w/3.json", {"cod": 401, "name": "Krakow", "main": {"temp": 2.0}})
    _write(f"{tmp_dir}/w/4.json", {"name": "Krakow", "main": {"temp": 3.0}})
    _write(f"{tmp_dir}/w/5.json", "{truncated")
    out = RAW.read_raw_json(spark, f"{tmp_dir}/w", rec, weather=True)
    assert "main.temp" in out.columns
    assert sorted(r["main.temp"] for r in out.collect()) == [3.0, 16.56]


def test_parquet_schema_groups_and_errors(spark, tmp_dir):
    spark.createDataFrame([(1, "a")], "x bigint, s string").write.parquet(f"{tmp_dir}/p/1.parquet")
    spark.createDataFrame([(2.5, "b")], "x double, s string").write.parquet(f"{tmp_dir}/p/2.parquet")
    spark.createDataFrame([("boom",)], "error string").write.parquet(f"{tmp_dir}/p/3.parquet")
    spark.createDataFrame([({"message": "m"},)], "error struct<message:string>").write.parquet(f"{tmp_dir}/p/4.parquet")
    out = RAW.read_raw_parquet(spark, [f"{tmp_dir}/p/{i}.parquet" for i in range(1, 5)])
    assert dict(out.dtypes)["x"] == "double"
    assert sorted(r.x for r in out.collect()) == [1.0, 2.5]


def test_prefix_scan_mixed_formats(spark, tmp_dir):
    spark.createDataFrame([("LO1", 1)], "flight_iata string, updated bigint").write.parquet(f"{tmp_dir}/m/x.parquet")
    _write(f"{tmp_dir}/m/y.json", {"response": [{"flight_iata": "FR1", "updated": 2}]})
    _write(f"{tmp_dir}/m/z.txt", "ignored")
    _write(f"{tmp_dir}/m/empty.json", "")
    out = RAW.read_raw(spark, f"{tmp_dir}/m", REC)
    assert sorted(r.flight_iata for r in out.collect()) == ["FR1", "LO1"]


def test_unreadable_files_are_skipped(spark, tmp_dir):
    spark.createDataFrame([("LO1", 1)], "flight_iata string, updated bigint").write.parquet(f"{tmp_dir}/c/ok.parquet")
    _write(f"{tmp_dir}/c/broken.parquet", "this is not parquet at all")
    _write(f"{tmp_dir}/c/bad.json", "{not json")
    out = RAW.read_raw(spark, f"{tmp_dir}/c", REC)
    assert [r.flight_iata for r in out.collect()] == ["LO1"]


def test_partitioned_write_range_scan(spark, tmp_dir):
    base = f"{tmp_dir}/silver"
    rows = [(f"F{d}", datetime(2025, 6, d, 12)) for d in range(1, 31)]
    df = spark.createDataFrame(rows, "flight_code string, ts timestamp_ntz")
    assert TB.write_partitioned(df, "ts", base)
    assert os.path.isdir(f"{base}/year=2025/month=06/day=01")
    part = TB.read_silver_range(spark, base, date(2025, 6, 10), date(2025, 6, 11))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert sorted(r.flight_code for r in part.collect()) == ["F10", "F11", "F12", "F9"]
    # dynamic overwrite: touching one day keeps the others
    TB.write_partitioned(spark.createDataFrame([("NEW", datetime(2025, 6, 5, 1))], df.schema), "ts", base)
    all_rows = {r.flight_code for r in TB.read_silver(spark, base).collect()}
    assert "NEW" in all_rows and "F5" not in all_rows and "F6" in all_rows and len(all_rows) == 30
    assert not TB.write_partitioned(df.limit(0), "ts", base)


def test_null_dates_quarantined(spark, tmp_dir):
    df = spark.createDataFrame([("A", datetime(2025, 6, 1)), ("B", None)], "flight_code string, ts timestamp_ntz")
    TB.write_partitioned(df, "ts", f"{tmp_dir}/s", quarantine=f"{tmp_dir}/q")
    assert [r.flight_code for r in spark.read.parquet(f"{tmp_dir}/q").collect()] == ["B"]


def test_undated_rows_of_earlier_batches_stay(spark, tmp_dir):
    schema = "flight_code string, ts timestamp_ntz, seen map<string,int>"
    first = spark.createDataFrame([("A", datetime(2025, 6, 1), {}), ("B", None, {"x": 1}), ("B", None, {"x": 1})], schema)
    second = spark.createDataFrame([("C", None, None), ("B", None, {"x": 1})], schema)
    wider = spark.createDataFrame([("D", None, "LH")], "flight_code string, ts timestamp_ntz, airline string")
    for batch in (first, second, wider, second, wider, first):
        TB.write_partitioned(batch, "ts", f"{tmp_dir}/s")
    kept = TB.read_silver(spark, TB.quarantine_path(f"{tmp_dir}/s"))
    assert sorted(r.flight_code for r in kept.collect()) == ["B", "B", "C", "D"]
    assert [r.airline for r in kept.where("airline IS NOT NULL").collect()] == ["LH"]
    assert [r.flight_code for r in TB.read_silver(spark, f"{tmp_dir}/s").collect()] == ["A"]


def test_undated_rows_that_differ_by_a_microsecond(spark, tmp_dir):
    at = [datetime(2025, 6, 1, 0, 0, 0, n) for n in (1, 2, 3)]
    df = spark.createDataFrame([(None, t) for t in at], "ts timestamp_ntz, seen timestamp_ntz")
    for batch in (df.where(F.col("seen") == at[0]), df):
        TB.write_partitioned(batch, "ts", f"{tmp_dir}/s")
    assert sorted(r.seen for r in TB.read_silver(spark, TB.quarantine_path(f"{tmp_dir}/s")).collect()) == at


def test_table_csv_gold_and_dictionary(spark, tmp_dir):
    df = spark.createDataFrame([("WAW", 2)], "arrival_airport string, flight_count long")
    assert TB.write_table(df, f"{tmp_dir}/gold/active_routes")
    assert not TB.write_table(df.limit(0), f"{tmp_dir}/gold/active_routes")
    assert TB.load_gold(spark, f"{tmp_dir}/gold", "active_routes").count() == 1
    with pytest.raises(ValueError):
        TB.load_gold(spark, f"{tmp_dir}/gold", "hourly_traffic")
    TB.write_csv(df, f"{tmp_dir}/csv")
    back = spark.read.option("header", True).csv(f"{tmp_dir}/csv").collect()
    assert back[0].arrival_airport == "WAW"
    calls = []

    def fetch():
        calls.append(1)
        return spark.createDataFrame([("LO", "LOT")], "iata_code string, name string")
    d1 = RAW.load_dictionary(spark, f"{tmp_dir}/dict/airlines", fetch)
    d2 = RAW.load_dictionary(spark, f"{tmp_dir}/dict/airlines", fetch)
    assert d1.count() == d2.count() == 1 and len(calls) == 1
    assert TB.day_sequence(spark, date(2025, 6, 1), date(2025, 6, 3), pad=True).count() == 5


def test_combined_fleets(spark, tmp_dir):
    for c in ("LO", "FR"):
        spark.createDataFrame([(f"SP-{c}", "Boeing", "737", 2010, 15)],
                              "reg_number string, manufacturer string, model string, built bigint, age bigint") \
            .write.parquet(f"{tmp_dir}/fleets/{c}")
    out = RAW.combined_fleets(spark, f"{tmp_dir}/fleets")
    assert sorted(r.reg_number for r in out.collect()) == ["SP-FR", "SP-LO"]


def test_write_table_over_itself(spark, tmp_dir):
    path = f"{tmp_dir}/gold/t"
    spark.createDataFrame([(1,), (2,)], "x int").write.parquet(path)
    grown = spark.read.parquet(path).union(spark.createDataFrame([(3,)], "x int"))
    assert TB.write_table(grown, path)
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_load_dashboard_tables(spark, tmp_dir):
    from contrail.plans import analogues as A
    from contrail.plans import dashboard as D
    sf = "/root/testdata/sf0.001"
    TB.write_partitioned(A.schedules(spark, sf), "scheduled_departure_utc", f"{tmp_dir}/silver/schedules")
    TB.write_partitioned(A.flights(spark, sf), "last_updated_utc", f"{tmp_dir}/silver/flights")
    raw = A.raw_arrivals(spark, sf).withColumn("__day", F.to_date(F.col("updated").cast("timestamp")))
    for n in range(8, 15):
        day = raw.where(F.col("__day") == date(2024, 1, n)).drop("__day")
        (TB.land_json if n % 2 else TB.land_snapshot)(day, f"{tmp_dir}/raw_arr", datetime(2024, 1, n, 6))
    for name, fn in (("airports", A.airports), ("airlines", A.airlines)):
        RAW.load_dictionary(spark, f"{tmp_dir}/dict/{name}", fetch=lambda fn=fn: fn(spark, sf))
    t = D.load_dashboard_tables(spark, f"{tmp_dir}/silver", f"{tmp_dir}/raw_arr", f"{tmp_dir}/dict",
                                date(2024, 1, 10), date(2024, 1, 12))
    from contrail.operators.filters import filter_local_date_range
    exp = filter_local_date_range(A.schedules(spark, sf), "scheduled_departure_utc",
                                  date(2024, 1, 10), date(2024, 1, 12)).count()
    assert t["schedules"].count() == exp > 0
    assert t["arrivals"].count() > 0 and t["flights"].count() > 0


def test_footers_are_read_without_the_files(spark, tmp_dir):
    """A file larger than the source of whole files may hold still tells its schema."""
    for name, ddl in (("a", "id bigint"), ("b", "id double, more string")):
        spark.range(20000).selectExpr("cast(id as double) id", "'x' more").selectExpr(
            *("cast(id as bigint) id",) if name == "a" else ("id", "more")).coalesce(1).write.parquet(f"{tmp_dir}/t/{name}")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        kinds = RAW.parquet_kinds(spark, f"{tmp_dir}/t")
        got = RAW.read_raw_parquet(spark, f"{tmp_dir}/t", placed=False)
        assert len(kinds) == 2 and got.count() == 40000 and dict(got.dtypes) == {"id": "double", "more": "string"}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_a_range_of_drifted_days(spark, tmp_dir):
    from datetime import date, datetime
    for day, ddl, row in ((9, "ts timestamp_ntz, v long", (1,)), (10, "ts timestamp_ntz, v long", (2,)),
                          (11, "ts timestamp_ntz, v double, w string", (2.5, "new"))):
        df = spark.createDataFrame([(datetime(2025, 6, day, 12), *row)], ddl)
        TB.write_partitioned(df, "ts", f"{tmp_dir}/s")
    got = TB.read_silver_range(spark, f"{tmp_dir}/s", date(2025, 6, 10), date(2025, 6, 11), pad=False)
    assert sorted((r.v, r.w) for r in got.collect()) == [(2.0, None), (2.5, "new")]
    assert len(got.inputFiles()) == 2
    none = TB.read_silver_range(spark, f"{tmp_dir}/s", date(2024, 1, 1), date(2024, 1, 2))
    assert none.collect() == [] and "v" in none.columns


def test_one_file_of_a_folder_is_read_alone(spark, tmp_dir):
    for n in range(2):
        spark.range(n, n + 1).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/t")
    names = sorted(f for f in os.listdir(f"{tmp_dir}/t") if f.endswith(".parquet"))
    assert RAW.read_raw_parquet(spark, [f"{tmp_dir}/t/{names[0]}"], placed=False).count() == 1
    assert RAW.read_raw_parquet(spark, [f"{tmp_dir}/t/{n}" for n in names], placed=False).count() == 2


CASES = ['[]', ' [ 1 , {"a": "x}]"} ,[2]] ', '{"response": [{"a": 1}, {"a": 2}, {"a": 3}], "k": {"response": [1]}}',
         '{"a": 1}\n{"a": 2}\n', '{}', '{"response": []}', '{"response": {"a": 1}}', '"text"', '[{"a": "\\"}]"}]']


@pytest.mark.parametrize("text", CASES)
@pytest.mark.parametrize("size", [1, 8, 1000])
def test_cut_documents_hold_the_same_records(text, size):
    def records(value):
        held = value.get("response", value) if isinstance(value, dict) else value
        return held if isinstance(held, list) else [held]

    whole = [json.loads(t) for t in (text.strip().split("\n") if "\n" in text else [text])]
    parts = [json.loads(t) for t in RAW._Cutter([text], size).documents()]
    assert parts == [json.loads(t) for t in RAW._Cutter(text, size).documents()]    # a character a piece
    assert [r for v in parts for r in records(v)] == [r for v in whole for r in records(v)]
    assert all({**v, "response": 0} == {**whole[0], "response": 0} for v in parts if isinstance(v, dict) and "response" in v)


@pytest.mark.parametrize("text", ["[1,]", "[1", '{"a" 1}', '{"a":1,}', "{1:2}", "[NaN]", '[{"a":1}] x', '{"response":[1,2}', "[1 2]"])
def test_cut_documents_refuse_what_is_no_json(text):
    with pytest.raises(ValueError):
        list(RAW._Cutter([text], 4).documents())


def test_a_document_that_no_variant_holds_gives_all_its_records(spark, tmp_dir):
    """Over 136 MB: more than the parsed form of one document may have."""
    os.makedirs(f"{tmp_dir}/raw/01")
    with open(f"{tmp_dir}/raw/01/big.json", "w") as out:
        out.write('{"request": {"id": 1}, "response": [')
        out.write(", ".join('{"n": %d, "pad": "%s"}' % (n, "x" * 1000) for n in range(140_000)))
        out.write("]}")
    with open(f"{tmp_dir}/raw/01/small.json", "w") as out:
        json.dump([{"n": -1, "pad": ""}], out)
    assert os.path.getsize(f"{tmp_dir}/raw/01/big.json") > 135 << 20
    got = RAW.read_raw(spark, f"{tmp_dir}/raw").select("n", "record_pos", "file_path")
    big = got.where("n >= 0")
    assert big.agg(F.count("*"), F.count_distinct("n"), F.sum("n")).first()[:] == (140_000, 140_000, 139_999 * 70_000)
    assert got.where("n = -1").count() == 1
    # in the order of the file
    assert big.agg(F.count_distinct("record_pos")).first()[0] == 140_000
    assert [r.n for r in big.orderBy("record_pos").limit(3).collect()] == [0, 1, 2]
    assert [r.n for r in big.orderBy(F.desc("record_pos")).limit(2).collect()] == [139_999, 139_998]
    assert RAW.unreadable_files(spark, f"{tmp_dir}/raw").count() == 0


def test_a_large_file_that_is_no_json_is_named(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(RAW, "LARGE_JSON", 10)
    with open(f"{tmp_dir}/bad.json", "w") as out:
        out.write('[{"a": 1}, {"a": 2')
    with open(f"{tmp_dir}/error.json", "w") as out:
        out.write('{"error": "no", "response": [{"a": 7}, {"a": 8}]}')
    with open(f"{tmp_dir}/good.json", "w") as out:
        out.write('{"a": 3, "b": [1]}\n{"a": 4, "b": [2, 3]}')
    assert sorted(r.a for r in RAW.read_raw(spark, tmp_dir).collect()) == [3, 4]
    assert [os.path.basename(r.path) for r in RAW.unreadable_files(spark, tmp_dir).collect()] == ["bad.json"]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_days_land_in_one_job(spark, tmp_dir, fmt):
    day = F.to_date(F.col("d"))
    rows = [(i, "2025-06-01" if i % 10 else f"2025-06-{2 + i // 100:02d}") for i in range(1000)]
    df = spark.createDataFrame(rows, "n bigint, d string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as they are
    try:
        TB.land_days(df, f"{tmp_dir}/raw", day, ["n"], fmt=fmt)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(os.listdir(f"{tmp_dir}/raw")) == ["2025"]
    hot = f"{tmp_dir}/raw/2025/06/01/235500.{fmt}"
    assert len([f for f in os.listdir(hot) if f.endswith(f".{fmt}")]) > 1  # a hot day is cut
    got = RAW.read_raw(spark, f"{tmp_dir}/raw", T.StructType.fromDDL("n bigint, d string"))
    assert sorted((r.n, r.d) for r in got.collect()) == sorted(rows)
    there = [r.n for r in got.where("d = '2025-06-01'").orderBy(*RAW.FILE_ORDER).collect()]
    assert there == sorted(there)
    for again in (df, df.limit(3).withColumn("d", F.lit(None).cast("string"))):
        with pytest.raises(ValueError):
            TB.land_days(again, f"{tmp_dir}/raw", day, ["n"], fmt=fmt)
    assert sorted(os.listdir(f"{tmp_dir}/raw")) == ["2025"]


def test_large_files_of_lines_are_read_in_splits(spark, tmp_dir, monkeypatch):
    """Before, one task put such a file in order and cut it."""
    rows = [{"n": n, "pad": "é" * (n % 7)} for n in range(900)]
    bodies = {"a": "\n".join(map(json.dumps, rows)) + "\n",
              "b": "\r\n \r\n".join(json.dumps({"response": [{"n": r["n"]}, {"n": -1}], "k": 1}) for r in rows)}
    for name, body in bodies.items():
        _write(f"{tmp_dir}/big {name}.json", body)
    _write(f"{tmp_dir}/c.json", "\n".join(map(json.dumps, rows)) + '\n{"n": 5, "pad": 1} {"n": 7}\nno json')
    _write(f"{tmp_dir}/d.json", json.dumps(rows))                                     # one document
    _write(f"{tmp_dir}/e.json", '{"n": 1}\n' + json.dumps([{"n": 2}] * 900))          # a line that is too long
    record = T.StructType.fromDDL("n bigint")
    monkeypatch.setattr(RAW, "LARGE_JSON", 4000)
    monkeypatch.setattr(RAW, "PART_CHARS", 4000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = RAW.read_raw_json(spark, tmp_dir, record).withColumn("task", F.spark_partition_id()).collect()
        assert [os.path.basename(f) for f in sorted(RAW._line_files(spark, tmp_dir))] == ["big%20a.json", "big%20b.json"]
        assert [os.path.basename(r.path) for r in RAW.unreadable_files(spark, tmp_dir).collect()] == ["c.json"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    numbers = {}
    for r in sorted(got, key=lambda r: (r.file_path, r.record_pos)):
        numbers.setdefault(os.path.basename(r.file_path), []).append(r.n)
    assert len({(r.file_path, r.record_pos) for r in got}) == len(got)
    assert numbers == {"big%20a.json": list(range(900)), "big%20b.json": [n for r in rows for n in (r["n"], -1)],
                       "c.json": [*range(900), 5, 7], "d.json": list(range(900)), "e.json": [1] + [2] * 900}
    for name in ("a", "b"):
        assert len({r.task for r in got if r.file_path.endswith(f"{name}.json")}) > 1
