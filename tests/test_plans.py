"""Physical-plan properties that matter at scale."""

from datetime import timedelta

from contrail import schemas as S
from contrail.operators.asof import asof_nearest
from contrail.operators.dedup import keep_last
from contrail.plans import analogues as A
from contrail.plans import gold as G
from contrail.sources import tables as TB

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_origin_filter_reaches_silver_scan(spark, tmp_dir):
    TB.write_partitioned(A.schedules(spark, SF), "scheduled_departure_utc", f"{tmp_dir}/schedules")
    sched = TB.read_silver(spark, f"{tmp_dir}/schedules", S.SCHEDULES)
    plan = _plan(G.active_routes(sched, A.airports(spark, SF), origin="NATION_0"))
    assert "EqualTo(departure_airport,NATION_0)" in plan
    # column pruning: the scan reads only the three columns the query needs
    assert "ReadSchema: struct<departure_airport:string,arrival_airport:string,scheduled_departure_utc:timestamp_ntz>" in plan


def test_asof_is_a_sweep_not_a_pair_join(spark):
    sched, flights = A.schedules(spark, SF), A.flights(spark, SF)
    plan = _plan(G.schedule_flight_facts(sched, flights))
    for pair_join in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert pair_join not in plan
    assert "Window" in plan
    # one shuffle feeds the sweep: left and right are exchanged together on (key, bucket)
    assert plan.count("hashpartitioning(__k0") == 1


def test_keep_last_pre_aggregates(spark):
    ev = A.table(spark, SF, "events")
    plan = _plan(keep_last(ev, ["user_id", "event_type"], ["ts", "event_id"]))
    assert "partial_max(" in plan  # map-side combine before the shuffle


def test_unkeyed_asof_partitions_by_time_bucket(spark):
    l = spark.range(100).selectExpr("id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id, 0) AS t")
    r = spark.range(50).selectExpr("id AS rid", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id * 2, 0) AS rt")
    plan = _plan(asof_nearest(l, r, "t", "rt", tolerance=timedelta(minutes=1)))
    assert "hashpartitioning(__b" in plan


def test_cluster_conf_sizes():
    from contrail.session import cluster_conf
    c = cluster_conf(100 * 2**40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(1 << 20, 8000)["spark.sql.shuffle.partitions"]) == 24000


def test_hot_day_is_split_into_several_files(spark, tmp_dir):
    import os
    from datetime import datetime, timedelta
    rows = [(f"F{i}", datetime(2025, 6, 1) + timedelta(seconds=i)) for i in range(20000)]
    rows += [("G", datetime(2025, 6, 2))]
    df = spark.createDataFrame(rows, "flight_code string, ts timestamp_ntz").repartition(8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        TB.write_partitioned(df, "ts", f"{tmp_dir}/t")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = [f for f in os.listdir(f"{tmp_dir}/t/year=2025/month=06/day=01") if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 20001


def test_hot_key_spreads_over_tasks(spark):
    """All rows share one key; the as-of sweep still runs in many tasks."""
    from pyspark.sql import functions as F
    l = spark.range(3000).selectExpr("id AS lid", "'hot' AS k",
                                     "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id * 15, 0) AS lt")
    r = spark.range(3000).selectExpr("id AS rid", "'hot' AS k",
                                     "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id * 15 + 7, 0) AS rt")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = asof_nearest(l, r, "lt", "rt", by=["k"], tolerance=timedelta(hours=1))
        parts = out.select(F.spark_partition_id().alias("p")).distinct().count()
        assert out.where("rid IS NOT NULL").count() == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert parts > 1
