"""Structured Streaming."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from contrail.plans import silver as SV
from contrail.streaming import incremental as S

RAW = ("name string, dt bigint, `main.temp` double, `main.feels_like` double, `main.pressure` bigint, "
       "`main.humidity` bigint, `wind.speed` double, `clouds.all` bigint, visibility bigint")


def test_incremental_silver_is_idempotent(spark, tmp_dir):
    raw_dir, base = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    rows = [("Krakow", 1748780400 + 3600 * i, 10.0 + i, 9.0, 1000, 50, 2.0, 10, 9000) for i in range(30)]
    spark.createDataFrame(rows, RAW).write.parquet(f"{raw_dir}/2025/06/01/a.parquet")
    schema = spark.read.parquet(f"{raw_dir}/2025/06/01/a.parquet").schema

    def clean(b):
        return SV.clean_weather(b)

    S.incremental_silver(spark, raw_dir, schema, clean, base,
                         ["airport_city", "observation_time_utc"], "observation_time_utc",
                         checkpoint=f"{tmp_dir}/ck1").awaitTermination()
    first = sorted(spark.read.parquet(base).collect())
    assert len(first) == 30
    # a later snapshot revises one observation and repeats another
    upd = [("Krakow", 1748780400, 99.0, 9.0, 1000, 50, 2.0, 10, 9000), rows[5]]
    spark.createDataFrame(upd, RAW).write.parquet(f"{raw_dir}/2025/06/02/b.parquet")
    S.incremental_silver(spark, raw_dir, schema, clean, base,
                         ["airport_city", "observation_time_utc"], "observation_time_utc",
                         checkpoint=f"{tmp_dir}/ck1").awaitTermination()
    second_df = spark.read.parquet(base)
    assert second_df.count() == 30
    assert second_df.where(F.col("observation_time_utc") == datetime(2025, 6, 1, 12, 20)) \
        .collect()[0].temp_celsius == 99.0
    second = second_df.collect()
    assert os.path.isdir(f"{base}/year=2025/month=06/day=01")
    # replaying everything from scratch gives the same table
    S.incremental_silver(spark, raw_dir, schema, clean, base,
                         ["airport_city", "observation_time_utc"], "observation_time_utc",
                         checkpoint=f"{tmp_dir}/ck2").awaitTermination()
    assert sorted(spark.read.parquet(base).collect()) == sorted(second)


def test_live_buckets_close_behind_watermark(spark, tmp_dir):
    rows = [("FR1", 50.0 + i / 100, 19.0, 0.0, datetime(2025, 6, 1, 10) + __import__("datetime").timedelta(minutes=5 * i))
            for i in range(40)]
    src = f"{tmp_dir}/pos"
    spark.createDataFrame(rows, "flight_code string, lat double, lng double, heading_deg double, "
                                "last_updated_utc timestamp_ntz").write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    out = S.run_to_table(S.live_position_buckets(stream), "t").orderBy("time_bucket").collect()
    # last point 13:15; watermark 12:15 -> buckets ending by 12:15 are final
    assert out[0].time_bucket == datetime(2025, 6, 1, 10) and out[0].lat == 50.02
    assert out[-1].time_bucket == datetime(2025, 6, 1, 12)
    assert len(out) == 9


def test_late_points_behind_watermark_are_dropped(spark, tmp_dir):
    from datetime import timedelta
    schema = "flight_code string, lat double, lng double, heading_deg double, last_updated_utc timestamp_ntz"
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    t0 = datetime(2025, 6, 1, 10)

    def run():
        stream = spark.readStream.schema(schema).parquet(src)
        q = (S.live_position_buckets(stream).writeStream.format("parquet").outputMode("append")
             .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()

    spark.createDataFrame([("FR1", 50.0 + i / 100, 19.0, 0.0, t0 + timedelta(minutes=10 * i))
                           for i in range(24)], schema).write.mode("append").parquet(src)
    run()
    first = {r.time_bucket: r.lat for r in spark.read.parquet(out).collect()}
    assert datetime(2025, 6, 1, 10) in first and first[datetime(2025, 6, 1, 10)] == 50.01
    # a late point for the 10:00 bucket (watermark is already ~13:50) plus fresh ones
    late = [("FR1", 10.0, 10.0, 0.0, datetime(2025, 6, 1, 10, 14))]
    fresh = [("FR1", 60.0, 19.0, 0.0, t0 + timedelta(hours=6, minutes=10 * i)) for i in range(3)]
    spark.createDataFrame(late + fresh, schema).write.mode("append").parquet(src)
    run()
    rows = spark.read.parquet(out).collect()
    tens = [r for r in rows if r.time_bucket == datetime(2025, 6, 1, 10)]
    assert len(tens) == 1 and tens[0].lat == 50.01      # the late point changed nothing
    assert len(rows) > len(first)                        # newly closed buckets were appended


def test_keep_last_gives_what_the_batch_keeps_with_late_rows(spark, tmp_dir):
    import random
    from datetime import timedelta

    from contrail.operators.dedup import keep_last
    schema = "k string, v int, note string, ts timestamp_ntz"
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    t0, draw = datetime(2025, 6, 1), random.Random(3)

    def run():
        stream = spark.readStream.schema(schema).parquet(src)
        q = (S.keep_last_within_watermark(stream, ["k"], "ts", ["ts", "v"]).writeStream.format("parquet")
             .outputMode("append").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()

    # every key within 40 minutes, versions out of order and repeated, over three batches
    batches = [[], [], []]
    for k in range(30):
        for v in range(6):
            row = (f"k{k}" if k else None, v, f"{k}-{v}", t0 + timedelta(minutes=10 * k + draw.randrange(40)))
            batches[min(2, k // 10 + (v % 3 == 2 and k % 10 > 7))].append(row)
    everything = []
    for n, rows in enumerate(batches):
        draw.shuffle(rows)
        everything += rows
        spark.createDataFrame(rows + rows[:3], schema).write.mode("append").parquet(src)
        run()
    spark.createDataFrame([("end", 0, "", t0 + timedelta(days=2))], schema).write.mode("append").parquet(src)
    run()
    late = ("k3", 99, "behind the watermark", t0 + timedelta(minutes=35))
    spark.createDataFrame([late], schema).write.mode("append").parquet(src)
    run()
    batch = keep_last(spark.createDataFrame(everything, schema), ["k"], ["ts", "v"])
    got = sorted(map(tuple, spark.read.schema(schema).parquet(out).collect()), key=str)
    assert got == sorted(map(tuple, batch.collect()), key=str) and len(got) == 30
