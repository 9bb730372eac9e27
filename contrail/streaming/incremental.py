"""Structured Streaming forms of the timer jobs.

* R1 ``incremental_silver``: new bronze files -> cleaned batch -> merged
  into the touched day partitions of the silver table by keep-last, written
  with dynamic partition overwrite.  Re-running a batch changes nothing.
* R2 ``live_position_buckets``: last position per (flight, 15 minutes) with
  an event-time watermark; a bucket is emitted once the watermark passes it.
* R3 ``dedup_first_within_watermark``: streaming deduplication keeping the
  first row of a key (Spark's ``dropDuplicatesWithinWatermark``).

State lives in the checkpoint folder under ``spark.checkpoint.dir``; a
batch that is retried after an executor loss recomputes from the same input
files and overwrites the same partitions.
"""

from __future__ import annotations

import os
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schemas as S
from contrail.functions.time import minute_label
from contrail.operators.dedup import keep_last
from contrail.session import path_exists, remove_path, scratch_path
from contrail.sources import raw as RAW
from contrail.sources import versions as VS
from contrail.sources.tables import PARTITION_COLS, quarantine_path, with_day_partitions

# Bucket width and lateness allowed for live positions.
BUCKET_MINUTES = 15
WATERMARK_DELAY = "1 hour"


def merge_into_silver(batch: DataFrame, base: str, keys: list[str], date_col: str,
                      stage_dir: str) -> None:
    """Keep-last merge of a cleaned batch into day-partitioned ``base``.

    The last row is the one with the greatest ingest order, stored in silver
    (``_ingest``), so a snapshot that arrives late does not replace a newer one;
    where the order is equal or unknown the batch's row wins.  The merged days
    are staged to ``stage_dir`` first (the target cannot be read and overwritten
    by one job), then swapped in with a dynamic partition overwrite.
    """
    spark = batch.sparkSession
    new = with_day_partitions(batch.where(F.col(date_col).isNotNull()), date_col)
    cols = batch.columns
    merged = new.withColumn("__rank", F.lit(1))
    if path_exists(spark, base):
        # the days a batch touches: a handful of keys, turned into a static
        # partition filter so only those day folders are read
        days = [f"{r[0]}-{r[1]}-{r[2]}" for r in
                new.select(*PARTITION_COLS).distinct().collect()]
        schema = T.StructType(batch.schema.fields +
                              [T.StructField(c, T.StringType()) for c in PARTITION_COLS])
        old = (spark.read.schema(schema).parquet(base)
               .where(F.concat_ws("-", *PARTITION_COLS).isin(days))
               .select(*cols, *PARTITION_COLS).withColumn("__rank", F.lit(0)))
        merged = old.unionByName(merged)
    order = [c for c in (S.INGEST,) if c in cols] + ["__rank"]
    merged = keep_last(merged, keys, order).drop("__rank")
    merged.drop(*PARTITION_COLS).write.mode("overwrite").parquet(stage_dir)
    (with_day_partitions(spark.read.parquet(stage_dir), date_col).hint("rebalance", *PARTITION_COLS)
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(*PARTITION_COLS).parquet(base))
    remove_path(spark, stage_dir)


def merge_into_version(batch: DataFrame, base: str, keys: list[str], date_col: str, number: tuple[str, int]) -> None:
    """:func:`merge_into_silver` on a table with versions, in one commit with the rows
    without a date: readers see all of the batch or nothing of it, and a batch whose
    number is already in is left out.  A commit of someone else's in between makes the
    merge start again from the version that it left."""
    spark = batch.sparkSession
    dated = batch.where(F.col(date_col).isNotNull())
    days = {r.d for r in dated.select(F.to_date(date_col).alias("d")).distinct().collect()}
    order = [c for c in (S.INGEST,) if c in batch.columns] + ["__rank"]
    while True:
        version = VS.current(spark, base)
        listed = VS.entries(spark, base, version)
        if VS.seen(listed, number):
            return
        old = VS.read_days(spark, base, batch.schema, days, version)
        rows = old.withColumn("__rank", F.lit(0)).unionByName(dated.withColumn("__rank", F.lit(1)))
        merged = keep_last(rows, keys, order).drop("__rank") \
            .unionByName(batch.where(F.col(date_col).isNull()))
        try:
            VS.commit_days(merged, date_col, base, number, version, days)
            return
        except VS.Conflict:
            continue


def incremental_silver(spark: SparkSession, raw_dir: str, record_schema: T.StructType | None,
                       clean: Callable[[DataFrame], DataFrame], base: str, keys: list[str], date_col: str,
                       checkpoint: str | None = None, available_now: bool = True, weather: bool = False,
                       files_per_batch: int = 1000, versions: bool = False):
    """Stream the bronze snapshots under ``raw_dir`` into ``base``.

    The stream is one of files; a batch's new files (``files_per_batch`` at most)
    are read like any bronze scan (S4): JSON and Parquet, drifted schemas aligned,
    error snapshots left out.  ``clean`` gets their records with ``ingest_order``,
    a text that sorts by file path and place; with ``ingest=True`` the silver
    functions keep it.  Rows without a date go to the table's quarantine, one
    folder a batch.  With ``versions`` the table is one of :mod:`contrail.sources.versions`,
    and a batch is one commit.
    """
    ckpt = checkpoint or scratch_path(spark, "silver-ckpt")
    listing = T.StructType([
        T.StructField("path", T.StringType(), False), T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False), T.StructField("content", T.BinaryType())])
    files = (spark.readStream.format("binaryFile").schema(listing).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", str(files_per_batch)).load(raw_dir).select("path"))

    def each(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]
        raw = RAW.read_raw(spark, paths, record_schema, weather) if paths else None
        if raw is None:
            return
        label = F.concat_ws("#", "file_path", F.lpad(F.col("record_pos").cast("string"), 20, "0"))
        cleaned = clean(raw.withColumn("ingest_order", label)).persist()  # read for days, merge, quarantine
        try:
            if versions:
                return merge_into_version(cleaned, base, keys, date_col, (ckpt, batch_id))
            merge_into_silver(cleaned, base, keys, date_col, os.path.join(ckpt, "stage", str(batch_id)))
            undated = cleaned.where(F.col(date_col).isNull())
            if not undated.isEmpty():
                undated.write.mode("overwrite").parquet(f"{quarantine_path(base)}/batch={batch_id}")
        finally:
            cleaned.unpersist()

    w = files.writeStream.foreachBatch(each).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 minutes")
    return w.start()


def live_position_buckets(positions: DataFrame, minutes: int = BUCKET_MINUTES,
                          delay: str = WATERMARK_DELAY, key: str = "flight_code",
                          ts: str = "last_updated_utc") -> DataFrame:
    """R2: streaming A7.  ``withWatermark`` needs an instant type, so the
    naive UTC time is viewed as ``timestamp`` (session zone UTC) for the
    windowing and turned back into ``timestamp_ntz`` on output."""
    carried = [c for c in ("lat", "lng", "heading_deg") if c in positions.columns]
    s = (positions.dropna(subset=["lat", "lng", ts])
                  .withColumn("__et", F.col(ts).cast("timestamp"))
                  .withWatermark("__et", delay)
                  .groupBy(key, F.window("__et", f"{int(minutes)} minutes").alias("__w"))
                  .agg(F.max_by(F.struct(*carried, F.col(ts)),
                                F.struct("__et", *carried)).alias("__r")))
    bucket = F.col("__w.start").cast("timestamp_ntz")
    return s.select(key, bucket.alias("time_bucket"),
                    *[F.col("__r").getField(c).alias(c) for c in carried],
                    F.col("__r").getField(ts).alias(ts),
                    minute_label(bucket).alias("time_label"))


def dedup_first_within_watermark(stream: DataFrame, keys: list[str], ts: str,
                                 delay: str = WATERMARK_DELAY) -> DataFrame:
    """First row per key among rows within the watermark delay, given out at
    once.  :func:`keep_last_within_watermark` waits for the last one."""
    return (stream.withColumn("__et", F.col(ts).cast("timestamp"))
                  .withWatermark("__et", delay)
                  .dropDuplicatesWithinWatermark(keys).drop("__et"))


def keep_last_within_watermark(stream: DataFrame, keys: list[str], ts: str, order: list[str] | None = None,
                               delay: str = WATERMARK_DELAY) -> DataFrame:
    """R3, keep-last: of a key's rows that follow each other within ``delay``, the one
    that W1 keeps (greatest ``order``, by default the time; ties by the row itself).

    A key's rows are a session; it is given out, once, when the watermark passes its
    end, ``delay`` after its last row.  Rows behind the watermark are dropped, rows
    without a time too; a key that returns later starts anew.  The state of a session
    is one row, whatever it has seen.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    rank = F.struct(*[F.col(f"`{o}`") for o in (order or [ts])])
    best = F.max(F.struct(rank.alias("o"), row.alias("r"))).getField("r").alias("__row")
    return (stream.withColumn("__et", F.col(ts).cast("timestamp"))
                  .withWatermark("__et", delay)
                  .groupBy(*[F.col(f"`{k}`").alias(f"__key{i}") for i, k in enumerate(keys)],
                           F.session_window("__et", delay))
                  .agg(best).select("__row.*"))


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a streaming query once over all available input into a Parquet
    folder of the shared checkpoint area and return it as a batch table."""
    spark = df.sparkSession
    root = scratch_path(spark, name)
    q = (df.writeStream.format("parquet").outputMode("append")
           .option("path", os.path.join(root, "out"))
           .option("checkpointLocation", os.path.join(root, "ckpt"))
           .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(os.path.join(root, "out"))
