"""Tables with versions: a commit is seen whole or not at all.

``base/data/<commit>`` holds what one commit wrote, in day folders.  ``base/versions/<n>``
lists what version ``n`` consists of, one row a day: its folder, number of rows, first
and last time.  A commit writes its data, then its list under a name of its own, and
renames that list to the next number.  Only this last step can be seen: a job that dies
before it leaves the old version, and what it wrote is never read.

A list grows with the number of days, not of rows; it is the only thing that goes to the
driver.  The rename must fail where the number exists, as it does on HDFS.
"""

from __future__ import annotations

import time
import uuid
from datetime import date, datetime
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schemas as S
from contrail.sources import raw as RAW
from contrail.sources import tables as TB

UNDATED = "contrail_undated"  # folders of rows with and without a date
LIST = "kind string, day date, folder string, rows long, low timestamp_ntz, high timestamp_ntz"


class Entry(NamedTuple):
    """``day``: a day's rows; ``undated``: a commit's rows without a date; ``whole``: a
    table without days; ``stream``: the last batch (``rows``) of the stream ``folder``."""
    kind: str
    day: date | None
    folder: str
    rows: int
    low: datetime | None = None
    high: datetime | None = None


class Conflict(RuntimeError):
    """Another commit came first, and this one was made from the version before it."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def _listed(spark: SparkSession, path: str) -> list:
    fs, p = _fs(spark, path)
    return list(fs.listStatus(p)) if fs.exists(p) else []


def current(spark: SparkSession, base: str) -> int:
    """The newest version; 0 if there is none yet."""
    names = (s.getPath().getName() for s in _listed(spark, f"{base}/versions"))
    return max((int(n) for n in names if n.isdigit()), default=0)


def entries(spark: SparkSession, base: str, version: int | None = None) -> list[Entry]:
    """What a version (the newest by default) consists of."""
    version = current(spark, base) if version is None else version
    if not version:
        return []
    return [Entry(*r) for r in spark.read.schema(LIST).parquet(f"{base}/versions/{version:08d}").collect()]


def _publish(spark: SparkSession, base: str, listed: list[Entry], version: int) -> bool:
    """Make ``listed`` the given version; false if that number is taken."""
    staged = f"{base}/versions/_{uuid.uuid4().hex}"
    spark.createDataFrame(listed, LIST).coalesce(1).write.parquet(staged)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, source = _fs(spark, staged)
    _, target = _fs(spark, f"{base}/versions/{version:08d}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(source, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        fs.delete(source, True)
        return False


def _commit(spark: SparkSession, base: str, new: list[Entry], replaces, batch: tuple[str, int] | None,
            parent: int | None) -> int | None:
    """Publish ``new`` in place of the entries that ``replaces`` names, upon the newest
    version, or upon ``parent`` and no other; None if the batch is already in."""
    while True:
        at = current(spark, base)
        if parent is not None and at != parent:
            raise Conflict(f"{base} is at version {at}, not {parent}")
        held = entries(spark, base, at)
        if batch and seen(held, batch):
            return None
        kept = [e for e in held if not replaces(e) and not (batch and e.kind == "stream" and e.folder == batch[0])]
        stream = [Entry("stream", None, *batch)] if batch else []
        if _publish(spark, base, kept + new + stream, at + 1):
            return at + 1


def seen(held: list[Entry], batch: tuple[str, int]) -> bool:
    return any(e.kind == "stream" and e.folder == batch[0] and e.rows >= batch[1] for e in held)


def commit_days(df: DataFrame, date_col: str, base: str, batch: tuple[str, int] | None = None,
                parent: int | None = None, cleared: set[date] = frozenset()) -> int | None:
    """S14 in one step: the days present in ``df`` (and those of ``cleared``) are replaced,
    the others stay.  The new version, or None if nothing was committed.

    ``batch`` is a stream and its batch number: a batch that is already in changes
    nothing.  With ``parent`` the commit holds only upon that version, else
    :class:`Conflict` is raised.  Rows without a date are added to those of earlier
    commits, unless they are there already (:func:`read_undated`).  ``df`` is computed
    once; it may read the table itself.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    if batch and seen(entries(spark, base), batch):
        return None
    undated = F.col(date_col).isNull()
    TB.with_day_partitions(df, date_col).withColumn(UNDATED, undated) \
        .hint("rebalance", UNDATED, *TB.PARTITION_COLS) \
        .write.partitionBy(UNDATED, *TB.PARTITION_COLS).parquet(f"{base}/data/{name}")
    written = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(UNDATED, T.BooleanType())])).parquet(f"{base}/data/{name}")
    time_of = F.col(date_col).cast("timestamp_ntz")
    found = written.groupBy(F.to_date(date_col).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min(time_of).alias("low"), F.max(time_of).alias("high")).collect()
    new = [Entry("day", r.day, f"data/{name}/{UNDATED}=false/year={r.day:%Y}/month={r.day:%m}/day={r.day:%d}",
                 r.n, r.low, r.high) for r in found if r.day is not None]
    if any(r.day is None for r in found):
        there = read_undated(spark, base)
        more = TB.missing_rows(written.where(UNDATED).select(*df.columns), there)
        more.write.parquet(f"{base}/data/{name}-undated")
        n = spark.read.schema(df.schema).parquet(f"{base}/data/{name}-undated").count()
        new += [Entry("undated", None, f"data/{name}-undated", n)] if n else []
    days = {e.day for e in new if e.kind == "day"} | set(cleared)
    if not new and not days and not batch:
        return None
    return _commit(spark, base, new, lambda e: e.kind == "day" and e.day in days, batch, parent)


def commit_table(df: DataFrame, base: str) -> int | None:
    """S15 in one step: the whole table is replaced; an empty result leaves the old one."""
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/{folder}")
    rows = spark.read.schema(df.schema).parquet(f"{base}/{folder}").count()
    if not rows:
        return None
    return _commit(spark, base, [Entry("whole", None, folder, rows)], lambda e: e.kind != "stream", None, None)


def _read(spark: SparkSession, base: str, listed: list[Entry], schema: T.StructType | None) -> DataFrame | None:
    df = RAW.read_raw_parquet(spark, [f"{base}/{e.folder}" for e in listed], placed=False) if listed else None
    if df is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return df if schema is None else S.conform(df, schema)


def read_version(spark: SparkSession, base: str, schema: T.StructType | None = None, start: datetime | None = None,
                 end: datetime | None = None, version: int | None = None) -> DataFrame | None:
    """S6, S7 on a version (the newest by default), whatever is committed meanwhile.

    Days that have no row from ``start`` to before ``end`` are left out by the list, no
    file of theirs is opened; of the others all rows are given.  Drifted days are
    aligned, then cast to ``schema``, if given.  None without a schema and without rows.
    """
    kept = [e for e in entries(spark, base, version) if e.kind == "whole" or e.kind == "day"
            and (start is None or e.high >= start) and (end is None or e.low < end)]
    return _read(spark, base, kept, schema)


def read_days(spark: SparkSession, base: str, schema: T.StructType, days: set[date],
              version: int | None = None) -> DataFrame:
    """The rows of some days of a version."""
    return _read(spark, base, [e for e in entries(spark, base, version) if e.day in days], schema)


def read_undated(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """The rows without a date of all commits; None if there are none."""
    return _read(spark, base, [e for e in entries(spark, base, version) if e.kind == "undated"], None)


def expire(spark: SparkSession, base: str, keep: int = 2, older_than_hours: float = 24.0) -> int:
    """Delete all but the newest ``keep`` versions and the data that no kept version
    names; the number of folders of data deleted.  What is younger than
    ``older_than_hours`` stays: a commit under way is in no list yet."""
    fs, _ = _fs(spark, base)
    before = (time.time() - older_than_hours * 3600) * 1000
    lists = {s.getPath().getName(): s for s in _listed(spark, f"{base}/versions")}
    newest = sorted(n for n in lists if n.isdigit())[-max(keep, 1):]
    named = {e.folder.split("/")[1] for n in newest for e in entries(spark, base, int(n)) if e.kind != "stream"}
    young = {n for n, s in lists.items() if s.getModificationTime() > before}
    for name in lists.keys() - young - set(newest):
        fs.delete(lists[name].getPath(), True)
    gone = [s for s in _listed(spark, f"{base}/data")
            if s.getPath().getName() not in named and s.getModificationTime() <= before]
    for status in gone:
        fs.delete(status.getPath(), True)
    return len(gone)
