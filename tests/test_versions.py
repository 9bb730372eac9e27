"""Tables with versions (S14, S15, R1): whole or not at all."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from contrail.plans import silver as SV
from contrail.sources import tables as TB
from contrail.sources import versions as VS
from contrail.streaming import incremental as S

T0 = datetime(2025, 6, 1, 12)


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"k int, ts timestamp_ntz, v bigint{extra}")


def days(spark, n, v):
    return frame(spark, [(k, T0 + timedelta(days=k), v) for k in range(n)])


def held(df):
    return sorted(map(tuple, df.select("k", "v").collect()))


def test_days_are_replaced_and_old_versions_stay(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    assert VS.current(spark, base) == 0 and VS.read_version(spark, base) is None
    assert VS.commit_days(days(spark, 4, 1), "ts", base) == 1
    assert VS.commit_days(days(spark, 2, 2), "ts", base) == 2
    assert held(VS.read_version(spark, base)) == [(0, 2), (1, 2), (2, 1), (3, 1)]
    assert held(VS.read_version(spark, base, version=1)) == [(k, 1) for k in range(4)]
    assert VS.commit_days(days(spark, 0, 2), "ts", base) is None and VS.current(spark, base) == 2
    # the table itself may be read by what replaces it
    assert VS.commit_days(VS.read_version(spark, base).withColumn("v", F.col("v") * 10), "ts", base) == 3
    assert held(VS.read_version(spark, base)) == [(0, 20), (1, 20), (2, 10), (3, 10)]
    VS.commit_days(days(spark, 0, 0), "ts", base, cleared={T0.date()})
    assert held(VS.read_version(spark, base)) == [(1, 20), (2, 10), (3, 10)]


def test_a_job_that_dies_before_the_swap_leaves_the_old_table(spark, tmp_dir, monkeypatch):
    base = f"{tmp_dir}/t"
    VS.commit_days(days(spark, 3, 1), "ts", base, ("s", 0))
    VS.commit_table(days(spark, 3, 1), f"{tmp_dir}/w")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(VS, "_publish", dies)
        for write in (lambda: VS.commit_days(days(spark, 3, 2), "ts", base, ("s", 1)),
                      lambda: VS.commit_table(days(spark, 3, 2), f"{tmp_dir}/w")):
            with pytest.raises(RuntimeError, match="lost"):
                write()
        assert held(VS.read_version(spark, base)) == [(k, 1) for k in range(3)]
        assert held(VS.read_version(spark, f"{tmp_dir}/w")) == [(k, 1) for k in range(3)]
    assert VS.commit_days(days(spark, 3, 2), "ts", base, ("s", 1)) == 2
    assert held(VS.read_version(spark, base)) == [(k, 2) for k in range(3)]
    # what the dead job wrote is deleted, and nothing else
    assert VS.expire(spark, base, keep=2, older_than_hours=-1) == 1
    assert held(VS.read_version(spark, base, version=1)) == [(k, 1) for k in range(3)]
    assert VS.expire(spark, base, keep=1, older_than_hours=-1) == 1
    assert held(VS.read_version(spark, base)) == [(k, 2) for k in range(3)]


def test_batches_come_in_once(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    assert VS.commit_days(days(spark, 2, 1), "ts", base, ("s", 4)) == 1
    assert VS.commit_days(days(spark, 2, 9), "ts", base, ("s", 4)) is None
    assert VS.commit_days(days(spark, 2, 9), "ts", base, ("s", 3)) is None
    assert VS.commit_days(days(spark, 1, 5), "ts", base, ("other", 3)) == 2
    assert held(VS.read_version(spark, base)) == [(0, 5), (1, 1)]


def test_commits_at_the_same_time(spark, tmp_dir, monkeypatch):
    base, publish, once = f"{tmp_dir}/t", VS._publish, []
    VS.commit_days(days(spark, 1, 1), "ts", base)

    def overtaken(spark, at, listed, version):
        if not once:  # someone else takes the number first
            once.append(1)
            VS.commit_days(days(spark, 3, 7).where("k = 2"), "ts", base)
        return publish(spark, at, listed, version)

    monkeypatch.setattr(VS, "_publish", overtaken)
    assert VS.commit_days(days(spark, 2, 2), "ts", base) == 3
    assert held(VS.read_version(spark, base)) == [(0, 2), (1, 2), (2, 7)]
    once.clear()
    with pytest.raises(VS.Conflict):
        VS.commit_days(days(spark, 2, 3), "ts", base, parent=3)
    assert held(VS.read_version(spark, base)) == [(0, 2), (1, 2), (2, 7)]


def test_days_out_of_range_are_not_opened_and_drifted_days_align(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    VS.commit_days(days(spark, 5, 1), "ts", base)
    odd = frame(spark, [(9, T0 + timedelta(days=2, hours=5), 3, "x")], ", note string") \
        .withColumn("v", F.col("v") + F.lit(0.5))
    VS.commit_days(odd, "ts", base)
    some = VS.read_version(spark, base, start=T0 + timedelta(days=1, hours=1), end=T0 + timedelta(days=4))
    assert {f.split("day=")[1][:2] for f in some.inputFiles()} == {"03", "04"}
    assert sorted(map(tuple, some.select("k", "v", "note").collect())) == [(3, 1.0, None), (9, 3.5, "x")]


def test_rows_without_a_date_are_kept_once(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    rows = [(1, None, 1), (1, None, 1), (2, T0, 1)]  # a column of the name "undated" is the table's own
    VS.commit_days(frame(spark, rows).withColumn("undated", F.lit("x")), "ts", base)
    VS.commit_days(frame(spark, rows[:2] + [(3, None, 4)]).withColumn("undated", F.lit("x")), "ts", base)
    assert held(VS.read_undated(spark, base)) == [(1, 1), (1, 1), (3, 4)]
    assert held(VS.read_version(spark, base)) == [(2, 1)]


def test_streamed_batches_are_commits(spark, tmp_dir):
    raw, base = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    schema = ("name string, dt bigint, `main.temp` double, `main.feels_like` double, `main.pressure` bigint, "
              "`main.humidity` bigint, `wind.speed` double, `clouds.all` bigint, visibility bigint")

    def land(rows, hour):
        TB.land_snapshot(spark.createDataFrame(rows, schema), raw, datetime(2025, 6, 3, hour))

    def run(checkpoint):
        S.incremental_silver(spark, raw, None, lambda b: SV.clean_weather(b, ingest=True), base,
                             ["airport_city", "observation_time_utc"], "observation_time_utc", weather=True,
                             checkpoint=f"{tmp_dir}/{checkpoint}", versions=True).awaitTermination()
        return sorted(map(tuple, VS.read_version(spark, base).collect()), key=str)

    rows = [("Krakow", 1748780400 + 7200 * i, 10.0 + i, 9.0, 1000, 50, 2.0, 10, 9000) for i in range(30)]
    land(rows, 10)
    assert len(run("a")) == 30
    land([("Krakow", rows[0][1], 99.0, *rows[0][3:]), rows[5]], 12)
    merged = run("a")
    assert len(merged) == 30 and VS.current(spark, base) == 2
    assert run("a") == merged and VS.current(spark, base) == 2
    assert run("b") == merged  # all again, as one batch of another stream
