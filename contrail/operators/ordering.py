"""Row numbers and running values without a task that holds a whole key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.ranges import with_ranges


def with_row_number(ordered: DataFrame, name: str = "row_number") -> DataFrame:
    """``ordered`` (the result of a global sort) with the place of each row from 1.

    The sorted rows are checkpointed, so that a second sort cannot cut them
    otherwise; the places add up one count per partition.
    """
    placed = ordered.withColumn("__p", F.spark_partition_id()) \
        .withColumn("__i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).checkpoint()
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    parts = placed.groupBy("__p").agg(F.count("*").alias("__n")) \
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return placed.join(parts, "__p").withColumn(
        name, (F.col("__before") + F.col("__i") + 1).cast("long")).drop("__p", "__i", "__before")


def running(df: DataFrame, key: str, ts: str, tie: str, value: str,
            range_rows: int | None = None) -> DataFrame:
    """``df`` with ``diff`` (to the value before), ``running`` (sum so far) and
    ``row_index`` (from 0) of each ``key`` in order of ``ts``, then ``tie``.

    A key with a large share of the rows is cut into ranges, and what a range
    inherits comes from one row a (key, range).
    """
    ranged = with_ranges(df, [key], [ts, tie], range_rows)
    before = ranged.before()
    within = ranged.window([F.col(f"`{ts}`"), F.col(f"`{tie}`")])
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = ranged.inherited(
        ranged.rows, [F.sum(value).alias("__s"), F.count(F.lit(1)).alias("__c"),
                      F.max_by(value, F.struct(ts, tie)).alias("__l")],
        {"__sum": F.sum("__s").over(before), "__n": F.sum("__c").over(before),
         "__last": F.lag("__l").over(ranged.by_range())})
    placed = rows.select("*", F.lag(value).over(within).alias("__lag"), F.sum(value).over(upto).alias("__run"),
                         F.row_number().over(within).alias("__row"))
    lag = F.when(F.col("__row") == 1, F.col("__last")).otherwise(F.col("__lag"))
    total = F.coalesce(F.col("__run") + F.col("__sum"), F.col("__run"), F.col("__sum"))
    index = F.coalesce("__n", F.lit(0)) + F.col("__row") - 1
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(value) - lag).alias("diff"),
                         total.alias("running"), index.cast("int").alias("row_index"))
