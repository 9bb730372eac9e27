"""Silver/gold storage: Hive day partitions, range scans and writers
(S6-S9, S12-S17)."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schemas as S
from contrail.functions.time import partition_load_range
from contrail.operators.align import flatten
from contrail.session import path_exists, remove_path, scratch_path
from contrail.sources import raw as RAW

PARTITION_COLS = ["year", "month", "day"]
# Fixed value: gold tables the dashboard may read.
READABLE_GOLD = ("active_routes", "airline_performance", "weather_impact")


def with_day_partitions(df: DataFrame, date_col: str) -> DataFrame:
    """year=YYYY / month=MM / day=DD (zero padded) from a UTC timestamp."""
    return (df.withColumn("year", F.date_format(date_col, "yyyy"))
              .withColumn("month", F.date_format(date_col, "MM"))
              .withColumn("day", F.date_format(date_col, "dd")))


def quarantine_path(base: str) -> str:
    """Where rows of the table ``base`` go that have no date."""
    return base.rstrip("/") + "__no_date"


def _row_counts(df: DataFrame) -> DataFrame:
    """Equal rows (by JSON: null fields and the order of columns do not count) as
    ``key``, their number ``n`` and one of them as ``row``."""
    second = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    key = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {
        "timestampNTZFormat": second, "timestampFormat": f"{second}XXX"}), 256)
    return df.groupBy(key.alias("key")).agg(
        F.count("*").alias("n"), F.any_value(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row"))


def missing_rows(df: DataFrame, there: DataFrame | None) -> DataFrame:
    """The rows of ``df`` that ``there`` lacks; of equal rows as many as it has fewer,
    so a batch that is written again adds nothing."""
    if there is None:
        return df
    held = _row_counts(there).select("key", F.col("n").alias("held"))
    more = _row_counts(df).join(held, "key", "left").withColumn("more", F.col("n") - F.coalesce("held", F.lit(0)))
    return more.where("more > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("more").cast("int")))) \
        .select("row.*")


def write_partitioned(df: DataFrame, date_col: str, base: str, quarantine: str | None = None) -> bool:
    """Overwrite only the day partitions present in ``df``.

    Rows are clustered by day with a ``rebalance`` hint: AQE splits a hot
    day into several advisory-size files instead of one task per day.

    Rows with a null date cannot be placed in a day; they are added to those in
    ``quarantine`` (:func:`quarantine_path` of ``base`` by default) unless they are
    there already, so none is lost, of this call or an earlier one.  An empty input writes nothing (False).  ``df`` is read several times:
    pass a stored table.
    """
    if df.isEmpty():
        return False
    dated = F.col(date_col).isNotNull()
    bad = df.where(~dated)
    if not bad.isEmpty():
        path = quarantine or quarantine_path(base)
        there = RAW.read_raw_parquet(df.sparkSession, path, placed=False) if path_exists(df.sparkSession, path) else None
        missing_rows(bad, there).write.mode("append").parquet(path)
    (with_day_partitions(df.where(dated), date_col).hint("rebalance", *PARTITION_COLS)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PARTITION_COLS).parquet(base))
    return True


def read_silver(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame:
    """The whole table.  Files whose schemas have drifted are aligned (each
    schema is one scan), then cast to the declared one, if given."""
    df = RAW.read_raw_parquet(spark, base, placed=False) if path_exists(spark, base) else None
    if df is None:
        if schema is None:
            raise ValueError(f"no table at {base}")
        return spark.createDataFrame([], schema)
    df = df.drop(S.INGEST)
    return df if schema is None else S.conform(df, schema)


def read_silver_range(spark: SparkSession, base: str, start: date, end: date,
                      pad: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """Only the day partitions of ``start..end`` (padded by a day each
    side for local-date filters); no other day's file is listed or opened.  Days
    whose schemas have drifted are aligned, then cast to ``schema``, if given; without
    any of these days the result is empty, with the table's columns."""
    lo, hi = partition_load_range(start, end) if pad else (start, end)
    days = (lo + timedelta(days=n) for n in range((hi - lo).days + 1))
    there = [p for p in (f"{base}/year={d:%Y}/month={d:%m}/day={d:%d}" for d in days) if path_exists(spark, p)]
    df = RAW.read_raw_parquet(spark, there, placed=False) if there else None
    if df is None:
        df = spark.read.option("basePath", base).parquet(base).where(F.lit(False)).drop(*PARTITION_COLS)
    df = df.drop(S.INGEST)
    return df if schema is None else S.conform(df, schema)


def raw_day_paths(spark: SparkSession, base: str, start: date, end: date) -> list[str]:
    """Existing ``base/YYYY/MM/DD`` folders of the padded range."""
    lo, hi = partition_load_range(start, end)
    days = [lo + timedelta(days=n) for n in range((hi - lo).days + 1)]
    return [p for p in (f"{base}/{d:%Y/%m/%d}" for d in days) if path_exists(spark, p)]


def day_sequence(spark: SparkSession, start: date, end: date, pad: bool = False) -> DataFrame:
    """One row per day, inclusive (optionally padded by one day)."""
    lo, hi = partition_load_range(start, end) if pad else (start, end)
    return spark.range(1).select(F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("day"))


def snapshot_path(base: str, when: datetime) -> str:
    """Where a snapshot taken at ``when`` is filed: by day, named by time, so
    paths sort by time."""
    return f"{base}/{when:%Y/%m/%d/%H%M%S}"


def land_snapshot(records: DataFrame, path: str, when: datetime | None = None) -> None:
    """Flattened records as a Parquet snapshot, filed by time if given."""
    target = snapshot_path(path, when) + ".parquet" if when else path
    flatten(records).write.mode("append").parquet(target)


def land_json(records: DataFrame, path: str, when: datetime | None = None) -> None:
    """Records as JSON, one a line, filed by time if given."""
    records.write.mode("append").json(snapshot_path(path, when) + ".json" if when else path)


def land_days(records: DataFrame, base: str, day: Column, order: list[str], at: str = "235500",
              fmt: str = "parquet") -> None:
    """One snapshot a day, in its day's folder, all by one distributed job.

    A day's rows lie in files whose names follow ``order``; a day with most of the rows
    is written by several tasks.  A day that has a snapshot of that time already, or a row
    without a day, is an error, before any day is put in place.
    """
    spark, stage = records.sparkSession, f"{base}/_land-{uuid.uuid4().hex}"
    rows = flatten(records) if fmt == "parquet" else records
    keys = [F.col(f"`{c}`") for c in order]
    named = rows.withColumn("land_day", F.date_format(day, "yyyy/MM/dd"))
    named.repartitionByRange("land_day", *keys).sortWithinPartitions("land_day", *keys) \
        .write.partitionBy("land_day").format(fmt).save(stage)
    try:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage)
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
        targets = {n: f"{base}/{unquote(n.split('=')[1])}/{at}.{fmt}" for n in names}
        taken = [t for n, t in targets.items() if "__HIVE" in n or path_exists(spark, t)]
        if taken:
            raise ValueError(f"rows without a day, or landed before: {', '.join(sorted(taken))}")
        for name, target in targets.items():
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
            fs.mkdirs(place.getParent())
            if not fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{stage}/{name}"), place):
                raise OSError(f"could not put {target} in place")
    finally:
        remove_path(spark, stage)


def read_raw_range(spark: SparkSession, base: str, start: date, end: date,
                   record_schema: T.StructType | None = None, weather: bool = False) -> DataFrame | None:
    """Raw snapshots, JSON and Parquet, of the padded day range only."""
    days = raw_day_paths(spark, base, start, end)
    return RAW.read_raw(spark, days, record_schema, weather) if days else None


def write_table(df: DataFrame, path: str) -> bool:
    """Overwrite a table; an empty result leaves the old one in place.

    The result is computed once, into the shared checkpoint folder, where its
    rows are counted on the way, and then put in place: it may read the very
    table that it replaces.
    """
    spark, stage, rows = df.sparkSession, scratch_path(df.sparkSession, "stage"), Observation()
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(stage)
    try:
        if not rows.get["n"]:
            return False
        spark.read.parquet(stage).write.mode("overwrite").parquet(path)
        return True
    finally:
        remove_path(spark, stage)


def write_csv(df: DataFrame, path: str) -> None:
    """UTF-8 CSV with header (timestamps as ``yyyy-MM-dd'T'HH:mm:ss.SSSSSS``)."""
    (df.write.mode("overwrite").option("header", True)
       .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
       .option("encoding", "UTF-8").csv(path))


def load_gold(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Allow-listed gold table."""
    if name not in READABLE_GOLD:
        raise ValueError(f"{name!r} is not a gold table that may be read; known: {', '.join(READABLE_GOLD)}")
    return spark.read.parquet(f"{base}/{name}")
