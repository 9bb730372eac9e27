"""Helpers shared by the training-data operators.

Inputs are DataFrames; every operator names the columns it needs (``id_col``,
``text_col``, ...), works on renamed private copies of them and never touches
other columns, so extra columns may carry any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.session import checkpoint_dir

#: The bytes that separate words in the contracts.
WORD_SPACE = "\\x20\\x09-\\x0D"

#: Tables are broadcast up to this many bytes, measured first.
BROADCAST_BYTES = 8 << 20

#: Rows of a few figures that fill a file of a stored table.
FILE_ROWS = 1 << 15


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def column(name: str) -> Column:
    return F.col(f"`{name}`")


def stored(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the cluster's shared folder
    (``spark.checkpoint.dir``), which survives the loss of executors.

    ``rows``, of a table of a few figures a row: it has no more rows than that, and
    goes to no more files than they fill (:data:`FILE_ROWS`).  A file costs an executor
    several processes where Hadoop's native library is missing, each seen with the
    whole memory of the JVM that starts it.
    """
    checkpoint_dir(df.sparkSession)
    return (df if rows is None else df.coalesce(files_of(rows))).checkpoint()


def files_of(rows: int) -> int:
    return max(1, -(-rows // FILE_ROWS))


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Bound what a Python worker gets at once: ``rows`` texts and ``size`` a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = 256,
              text: int = 1, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds at most ``rows`` rows and about
    ``chars`` bytes of column ``text`` (one row at least)."""
    for batch in batches:
        at, n = 0, batch.num_rows
        while at < n:
            piece = batch.slice(at, rows)
            while piece.num_rows > 1 and piece.column(text).nbytes > chars:
                piece = piece.slice(0, piece.num_rows // 2)
            yield piece
            at += piece.num_rows


def global_offsets(parts: DataFrame, part: str, value: str, out: str) -> DataFrame:
    """Running total of ``value`` over the rows before, in order of ``part``.

    ``parts`` has one row per partition of a table, so the single window
    partition below holds as many rows as the job has tasks, whatever the data.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(out, F.coalesce(F.sum(value).over(before), F.lit(0)).cast("long"))




def rows_of(docs: DataFrame, keepers: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that ``keepers`` (``doc_id``, ``sha``: id and SHA-256 of
    the text) name; of rows equal in both one.

    The join is on id and text, so a text that many rows share meets no hot key.
    """
    names = [column(c) for c in docs.columns]
    sha, known = F.sha2(text_of(text_col), 256), F.col("doc_id").isNull()
    rows = docs.select(F.struct(*names).alias("row"), column(id_col).cast("long").alias("doc_id"),
                       sha.alias("sha"))
    keys = ["id", "none", "sha"]
    mine = [F.coalesce("doc_id", F.lit(0)).alias("id"), known.alias("none"), "sha"]
    order = [F.to_json(F.struct(*[F.col(f"row.`{c}`") for c in docs.columns
                                  if c not in (id_col, text_col)] or [F.lit(0)]))]
    found = rows.select(*mine, "row").join(keepers.select(*mine).distinct(), keys)
    # the window's keys are the join's: no further shuffle
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return found.withColumn("first", first).where("first = 1").select("row.*")
