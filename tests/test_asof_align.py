"""As-of join against brute force (J2/J3) and schema alignment rules."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators.align import align_union, flatten, widen_type
from contrail.operators.asof import asof_nearest
from contrail.operators.dedup import keep_last


def brute(L, R, tol, keyed=True):
    out = {}
    for lid, k, lt in L:
        best = None
        if lt is not None and (k is not None or not keyed):
            for rid, rk, rt in R:
                if keyed and rk != k:
                    continue
                d = abs((rt - lt).total_seconds())
                if d <= tol.total_seconds():
                    key = (-d, rt, rid)
                    if best is None or key > best[0]:
                        best = (key, rid)
        out[lid] = best[1] if best else None
    return out


@pytest.mark.parametrize("tol_min,width_min", [(45, None), (45, 20), (0, None), (200, 500)])
def test_asof_keyed_brute_force(spark, tol_min, width_min):
    rnd = random.Random(tol_min + (width_min or 0))
    base = datetime(2024, 1, 1)
    L = [(i, rnd.choice(["a", "b", "c", None]),
          base + timedelta(minutes=rnd.randint(0, 3000)) if rnd.random() > 0.05 else None) for i in range(250)]
    # repeated right times (equal timestamps) and equidistant neighbours
    R = [(j, rnd.choice(["a", "b", "c", None]),
          base + timedelta(minutes=rnd.choice([rnd.randint(0, 3000), 600, 1200, 1290]))) for j in range(120)]
    ldf = spark.createDataFrame(L, "lid long, k string, lt timestamp_ntz")
    rdf = spark.createDataFrame(R, "rid long, k string, rt timestamp_ntz")
    out = asof_nearest(ldf, rdf, "lt", "rt", by=["k"], tolerance=timedelta(minutes=tol_min),
                       right_order=["rid"],
                       bucket_width=timedelta(minutes=width_min) if width_min else None)
    got = {r.lid: r.rid for r in out.collect()}
    assert len(got) == len(L)
    assert got == brute(L, R, timedelta(minutes=tol_min))


def test_asof_unkeyed_and_boundaries(spark):
    base = datetime(2024, 1, 1, 12)
    L = [(1, None, base), (2, None, base + timedelta(minutes=30)), (3, None, base + timedelta(hours=5))]
    R = [(10, None, base - timedelta(minutes=10)), (11, None, base + timedelta(minutes=10)),
         (12, None, base + timedelta(minutes=90))]
    ldf = spark.createDataFrame(L, "lid long, k string, lt timestamp_ntz").drop("k")
    rdf = spark.createDataFrame(R, "rid long, k string, rt timestamp_ntz").drop("k")
    got = {r.lid: r.rid for r in asof_nearest(ldf, rdf, "lt", "rt", tolerance=timedelta(hours=1)).collect()}
    # equidistant -> later; 30 min: 20 after 11 vs 60 before 12 -> 11; nothing within 1 h -> None
    assert got == {1: 11, 2: 11, 3: None}
    # tolerance is inclusive
    got = {r.lid: r.rid for r in asof_nearest(ldf, rdf, "lt", "rt", tolerance=timedelta(minutes=60)).collect()}
    assert got[2] == 11


def test_widen_rules():
    assert widen_type(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert widen_type(T.IntegerType(), T.LongType()) == T.DoubleType()
    assert widen_type(T.StringType(), T.LongType()) == T.StringType()
    assert widen_type(T.NullType(), T.LongType()) == T.StringType()
    assert widen_type(T.BooleanType(), T.LongType()) == T.StringType()
    assert widen_type(T.LongType(), T.LongType()) == T.LongType()


def test_align_union(spark):
    a = spark.createDataFrame([(1, "x")], "k bigint, s string")
    b = spark.createDataFrame([(2.5, 7)], "k double, extra int")
    c = spark.createDataFrame([("3",)], "s string")
    out = align_union([a, b, c])
    assert out.columns == ["k", "s", "extra"]
    assert dict(out.dtypes) == {"k": "double", "s": "string", "extra": "int"}
    assert sorted((r.k or 0, r.s or "", r.extra or 0) for r in out.collect()) == [
        (0, "3", 0), (1.0, "x", 0), (2.5, "", 7)]


def test_flatten(spark):
    df = spark.createDataFrame([({"temp": 1.5, "x": {"y": 2}}, [1, 2], "K")],
                               "main struct<temp:double, x:struct<y:int>>, arr array<int>, name string")
    f = flatten(df)
    assert f.columns == ["main.temp", "main.x.y", "arr", "name"]
    r = f.collect()[0]
    assert r["main.temp"] == 1.5 and r["main.x.y"] == 2 and r["arr"] == [1, 2]


def test_keep_last_deterministic(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("a", 2, "r"), ("b", 1, "s")],
                               "k string, o int, v string").repartition(3)
    got = {r.k: r.v for r in keep_last(df, ["k"], ["o"]).collect()}
    assert got == {"a": "r", "b": "s"}


def test_keep_last_with_map_column(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, {"y": 2}), ("b", 1, {"z": 3})],
                               "k string, o int, m map<string,int>")
    got = {r.k: r.m for r in keep_last(df, ["k"], ["o"]).collect()}
    assert got == {"a": {"y": 2}, "b": {"z": 3}}


def test_asof_on_instant_timestamps(spark):
    from datetime import timezone
    base = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
    ldf = spark.createDataFrame([(1, "a", base), (2, "a", base + timedelta(hours=3))],
                                "lid long, k string, lt timestamp")
    rdf = spark.createDataFrame([(10, "a", base + timedelta(minutes=20)),
                                 (11, "a", base + timedelta(hours=3, minutes=5))],
                                "rid long, k string, rt timestamp")
    got = {r.lid: r.rid for r in asof_nearest(ldf, rdf, "lt", "rt", by=["k"],
                                              tolerance=timedelta(minutes=30)).collect()}
    assert got == {1: 10, 2: 11}


@pytest.mark.parametrize("by", [[], ["k"]])
def test_a_hot_bucket_is_swept_in_parts(spark, by):
    """All left rows in one bucket: several tasks have output, and the same answer."""
    start = datetime(2031, 1, 1, 6)
    left = spark.range(4000).select(F.lit("a").alias("k"), F.col("id"), (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(
        secs=(F.col("id") % 600).cast("decimal(18,6)"))).alias("t"))
    right = spark.createDataFrame([("a", start + timedelta(seconds=s), s) for s in (5, 60, 61, 400, 590)],
                                  "rk string, rt timestamp_ntz, v int")
    right = right.withColumnRenamed("rk", "k") if by else right.drop("rk")
    kw = dict(left_on="t", right_on="rt", by=by, tolerance=timedelta(minutes=10))
    whole = asof_nearest(left, right, **kw)
    parts = asof_nearest(left, right, split_rows=100, **kw)
    assert sorted(whole.collect()) == sorted(parts.collect())
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = parts.groupBy(F.spark_partition_id()).agg(F.max("rt")).collect()
        assert len(tasks) > 1 and len(whole.groupBy(F.spark_partition_id()).agg(F.max("rt")).collect()) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
