"""Ordered passes over ranges of a key: the same rows however a key is cut."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from contrail.operators import ordering, ranges, tracks
from contrail.operators.asof import asof_nearest

DAY = datetime(2024, 3, 1)


def points(n=4000, seed=1, null_key=False):
    """One key and day with half of all rows, ties in time, and small keys."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 2 == 0
        key = "hot" if hot else ("k%d" % (i % 40) if not null_key or i % 3 else None)
        t = DAY + (timedelta(seconds=draw.randrange(86400)) if hot else timedelta(hours=draw.randrange(2000)))
        rows.append((key, t, i, draw.randrange(100), 50 + draw.random(), 19 + draw.random()))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(points(), "k string, ts timestamp_ntz, i int, v int, lat double, lng double")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [150, 400])
@pytest.mark.parametrize("name", ["gap_hours", "with_segments", "latest_segment", "with_bearings", "running"])
def test_cut_keys_give_the_same_rows(spark, table, name, limit):
    def run(limit):
        if name == "gap_hours":
            return tracks.gap_hours(table, ["k"], "ts", ["i"], range_rows=limit)
        if name == "with_segments":  # gaps of an hour: several legs in the hot key too
            return tracks.with_segments(table.where("i % 400 < 7"), ["k"], "ts", 0.5, ["i"],
                                        range_rows=max(3, limit // 40))
        if name == "latest_segment":
            return tracks.latest_segment(table.where("i % 400 < 7"), ["k"], "ts", 0.5, ["i"],
                                         range_rows=max(3, limit // 40))
        if name == "with_bearings":
            return tracks.with_bearings(table, ["k"], ["ts", "i"], range_rows=limit)
        return ordering.running(table, "k", "ts", "i", "v", range_rows=limit)

    assert rows_of(run(limit)) == rows_of(run(1 << 30))


def test_null_keys_are_one_key(spark):
    schema = "k string, ts timestamp_ntz, i int, v int, lat double, lng double"
    df = spark.createDataFrame([(None, *r[1:]) if r[0] == "hot" else r for r in points(1500)], schema)
    assert rows_of(ordering.running(df, "k", "ts", "i", "v", range_rows=100)) == \
        rows_of(ordering.running(df, "k", "ts", "i", "v", range_rows=1 << 30))
    assert rows_of(tracks.with_bearings(df, ["k"], ["ts", "i"], range_rows=100)) == \
        rows_of(tracks.with_bearings(df, ["k"], ["ts", "i"], range_rows=1 << 30))


def test_a_hot_key_of_one_day_lies_in_several_even_ranges(table):
    ranged = ranges.with_ranges(table, ["k"], ["ts"], range_rows=250)
    sizes = {r[0]: r[1] for r in ranged.rows.where("k = 'hot'").groupBy("__range").count().collect()}
    assert len(sizes) >= 4 and max(sizes.values()) < 900 and sum(sizes.values()) == 2000
    assert ranged.rows.where("k <> 'hot'").agg(F.max("__range")).first()[0] == 0
    # in order: what a range holds ends before the next begins
    edges = ranged.rows.where("k = 'hot'").groupBy("__range").agg(F.min("ts"), F.max("ts")).orderBy("__range").collect()
    assert all(a[2] < b[1] for a, b in zip(edges, edges[1:]))


def test_many_cuts_are_searched_in_blocks(table, monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK", 3)
    got = rows_of(ordering.running(table, "k", "ts", "i", "v", range_rows=60))
    assert got == rows_of(ordering.running(table, "k", "ts", "i", "v", range_rows=1 << 30))
    monkeypatch.setattr(ranges, "MAX_CUTS", 5)
    few = ranges.with_ranges(table, ["k"], ["ts"], range_rows=60)
    assert few.rows.agg(F.max("__range")).first()[0] <= 12


def test_one_scan_and_one_shuffle_without_hot_keys(spark, tmp_path):
    spark.createDataFrame(points(300), "k string, ts timestamp_ntz, i int, v int, lat double, lng double") \
        .write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for out in (tracks.gap_hours(df, ["k"], "ts"), tracks.with_segments(df, ["k"], "ts"),
                tracks.latest_segment(df, ["k"], "ts"), tracks.with_bearings(df, ["k"], ["ts"]),
                ordering.running(df, "k", "ts", "i", "v")):
        plan = plan_of(out)
        assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1, plan


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, ts timestamp_ntz, i int, v int, lat double, lng double")
    assert tracks.with_segments(df, ["k"], "ts", range_rows=1).collect() == []
    assert ordering.running(df, "k", "ts", "i", "v", range_rows=1).collect() == []


@pytest.mark.parametrize("by", [["k"], []])
@pytest.mark.parametrize("side", ["left", "right"])
def test_asof_with_a_hot_side_in_several_ranges(spark, by, side):
    """One key and bucket holds nearly all rows of a side; ties in time on both."""
    draw = random.Random(4)

    def rows(n, spread):
        return [("hot" if draw.random() < 0.9 else "cold", DAY + timedelta(seconds=draw.randrange(spread)), i)
                for i in range(n)]

    left, right = (rows(1500, 7000), rows(60, 90000)) if side == "left" else (rows(60, 90000), rows(1500, 7000))
    ldf = spark.createDataFrame(left, "k string, lt timestamp_ntz, lid int")
    rdf = spark.createDataFrame(right, "k string, rt timestamp_ntz, rid int")
    if not by:
        ldf, rdf = ldf.drop("k"), rdf.drop("k")

    def run(limit):
        return asof_nearest(ldf, rdf, "lt", "rt", by=by, tolerance=timedelta(minutes=20), right_order=["rid"],
                            split_rows=limit)

    got = rows_of(run(100))
    assert got == rows_of(run(1 << 30))
    best = {}
    for k, lt, lid in left:
        near = [(abs(lt - rt), -rt.timestamp(), -rid) for rk, rt, rid in right
                if (rk == k or not by) and abs(lt - rt) <= timedelta(minutes=20)]
        best[lid] = -min(near)[2] if near else None
    place = 2 if by else 1
    assert {r[place]: r[-1] for r in got} == best


def kept_by_loop(rows, max_km=400.0):
    """Rows (key, time, i, la, lo) -> those that the rule keeps, track by track."""
    last, out = {}, []
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if r[0] not in last or float(tracks._haversine_np(*last[r[0]], r[3], r[4])) <= max_km:
            last[r[0]] = (r[3], r[4])
            out.append(r)
    return sorted(out, key=str)


JUMPS = "k string, ts timestamp_ntz, i int, la double, lo double"


def jump(spark, rows, limit):
    df = spark.createDataFrame(rows, JUMPS)
    return rows_of(tracks.filter_jumps(df, ["k"], "ts", lat="la", lng="lo", order=["i"], range_rows=limit))


@pytest.mark.parametrize("limit", [20, 90, 1 << 30])
def test_jumps_of_a_null_track_and_one_called_none(spark, limit):
    draw = random.Random(9)
    rows, la, lo = [], 50.0, 19.0
    for i in range(400):
        la, lo = la + draw.uniform(-1, 1), lo + draw.uniform(-1, 1)
        far = 15 if draw.random() < 0.2 else 0      # glitches, some in a row, some at a range's edge
        rows.append((None if i % 2 else "None", DAY + timedelta(minutes=i // 3), i, la + far, lo))
    assert jump(spark, rows, limit) == kept_by_loop(rows)


def test_a_track_whose_every_range_is_far_from_the_one_before(spark):
    rows = [("t", DAY + timedelta(minutes=i), i, -60 + 20.0 * (i // 16 % 7) + (i // 112) % 5, 10.0 * (i // 16 % 30))
            for i in range(64 * 16)]
    assert jump(spark, rows, 16) == kept_by_loop(rows)
    away = [("t", DAY + timedelta(minutes=i), i, 0.0, 0.0 if i < 16 else 90.0 + i % 5) for i in range(64 * 16)]
    assert jump(spark, away, 16) == kept_by_loop(away)


def test_a_point_that_outlasts_64_ranges_takes_log_rounds(spark, monkeypatch):
    rows = [("t", DAY + timedelta(minutes=i), i, 0.0, 0.0 if i < 16 else 20.0 * (1 + i // 16 % 8))
            for i in range(64 * 16)]
    found = []
    plain = tracks.jump_entries
    monkeypatch.setattr(tracks, "jump_entries", lambda *a: found.append(plain(*a)) or found[-1])
    assert jump(spark, rows, 16) == kept_by_loop(rows)
    assert found[0][1] <= 7 and found[0][0].count() >= 50
