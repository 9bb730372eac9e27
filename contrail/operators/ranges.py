"""Ranges of a key: how an ordered pass over keys avoids one task per key.

Rows of one key, in order, form a sequence.  An ordered pass (previous row, running
sum, fold) needs the sequence, but a key that holds a large share of a table must
not become one task.  Such a key is cut: places in its order, found from a sample,
split it into ranges of about equal size.  The pass then runs over (key, range) in
one shuffle, and what a range inherits from those before it (the last row, a sum)
comes from one row a (key, range).  Keys within one range inherit nothing, so a
table without large keys takes one scan and one shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import checkpoint_dir

#: A key with more rows than this is cut.
RANGE_ROWS = 1 << 20

#: Tables that are this small together need no count of their keys.
SMALL_BYTES = 64 << 20

#: Cuts that all keys have together at most; beyond that ranges grow.  Bounds the
#: table of cuts, which is broadcast.
MAX_CUTS = 1 << 16

#: Sampled rows a range, and cuts that are searched together.
SAMPLE, BLOCK = 16, 256

RANGE = "__range"


def _q(n: str) -> str:
    return f"`{n}`"


def input_bytes(df: DataFrame) -> int:
    """What the tables that ``df`` reads hold, by the planner's figures; no job runs.
    (Its figure for ``df`` itself multiplies the sides of every join.)"""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def same(left: list, right: list) -> Column:
    """Equality of key columns, null equal to null."""
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & a.eqNullSafe(b)
    return out


@dataclass
class Ranged:
    """Rows with their range (column ``__range``), and whether any key is cut."""

    rows: DataFrame
    keys: list[str]
    cut: bool

    def parts(self) -> list[str]:
        return [_q(k) for k in self.keys] + [RANGE]

    def window(self, order: list):
        return Window.partitionBy(*self.parts()).orderBy(*order)

    def whole(self):
        return Window.partitionBy(*self.parts())

    def stored(self, rows: DataFrame) -> DataFrame:
        """``rows``, computed once where they will be read again."""
        if not self.cut:
            return rows
        checkpoint_dir(rows.sparkSession)
        return rows.checkpoint()

    def inherited(self, rows: DataFrame, sums: list, carry: dict) -> DataFrame:
        """``rows`` with what each (key, range) gets from the other ranges of its key;
        nulls where no key is cut.

        ``sums`` are named aggregates of a (key, range); ``carry`` names columns over
        those, windowed by key in order of the range.  Only cut keys have rows in the
        table that is joined, ``MAX_CUTS`` plus one a key at most.
        """
        if not self.cut:
            return rows.select("*", *[F.lit(None).alias(n) for n in carry])
        names = [f"__range_of{i}" for i in range(len(self.keys))]
        table = rows.where("__cut").groupBy(*self.parts()).agg(*sums).select(
            *[F.col(_q(k)).alias(n) for k, n in zip(self.keys, names)], F.col(RANGE).alias("__range_at"),
            *[c.alias(n) for n, c in carry.items()])
        on = same([F.col(_q(k)) for k in self.keys], map(F.col, names)) & (F.col(RANGE) == F.col("__range_at"))
        return rows.join(F.broadcast(table), on, "left").drop(*names, "__range_at")

    def by_range(self):
        """The ranges of a key in order, for ``carry`` columns."""
        return Window.partitionBy(*[_q(k) for k in self.keys]).orderBy(RANGE)

    def before(self):
        return self.by_range().rowsBetween(Window.unboundedPreceding, -1)

    def after(self):
        """The ranges behind, the nearest one last: a frame that only grows."""
        return Window.partitionBy(*[_q(k) for k in self.keys]).orderBy(F.col(RANGE).desc()) \
            .rowsBetween(Window.unboundedPreceding, -1)

    def plain(self, rows: DataFrame) -> DataFrame:
        return rows.drop(RANGE, "__cut")


def with_ranges(df: DataFrame, keys: list[str], order: list[str], range_rows: int | None = None) -> Ranged:
    """Cut the keys of ``df`` that hold more than ``range_rows`` rows.

    ``order`` are the columns that order a key's rows; rows equal in all of them stay
    in one range.  Without ``range_rows``, keys are not counted if the tables
    read are under ``SMALL_BYTES`` together.  Null keys are one key.
    """
    whole = Ranged(df.withColumn(RANGE, F.lit(0)).withColumn("__cut", F.lit(False)), list(keys), False)
    if range_rows is None and input_bytes(df) <= SMALL_BYTES:
        return whole
    limit = range_rows or RANGE_ROWS
    names = [f"__range_key{i}" for i in range(len(keys))]
    mine = [F.col(_q(k)) for k in keys]
    hot = df.groupBy(*[k.alias(n) for k, n in zip(mine, names)]).agg(F.count(F.lit(1)).alias("__n")) \
        .where(F.col("__n") > limit).persist()
    counted = hot
    try:
        rows = hot.agg(F.sum("__n")).first()[0]
        if not rows:
            return whole
        size = max(limit, -(-rows // MAX_CUTS))
        hot = hot.where(F.col("__n") > size)            # MAX_CUTS keys at most
        here = F.struct(*[F.col(_q(o)) for o in order])
        sampled = (df.join(F.broadcast(hot), same(mine, map(F.col, names)))
                   .where(F.rand(11) < SAMPLE / size)
                   .groupBy(*names).agg(F.array_distinct(F.sort_array(F.collect_list(here))).alias("__all")))
        cuts = F.transform(F.sequence(F.lit(1), F.floor(F.size("__all") / SAMPLE)),
                           lambda i: F.get("__all", (i * SAMPLE - 1).cast("int")))
        sampled = sampled.where(F.size("__all") >= SAMPLE).select(*names, cuts.alias("__cuts"))
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("__cuts") - 1) / BLOCK)),
                             lambda b: F.slice("__cuts", (b * BLOCK + 1).cast("int"), BLOCK))
        checkpoint_dir(df.sparkSession)
        # fixed once: a second sample would cut elsewhere
        table = sampled.select(*names, blocks.alias("__blocks")).select(
            "*", F.transform("__blocks", lambda b: F.get(b, F.lit(0))).alias("__heads")).checkpoint()
    finally:
        counted.unpersist()
    joined = df.join(F.broadcast(table), same(mine, map(F.col, names)), "left")
    block = F.size(F.filter("__heads", lambda c: c <= here))
    inside = F.size(F.filter(F.get("__blocks", block - 1), lambda c: c <= here))
    place = F.when(F.col("__heads").isNull() | (block == 0), F.lit(0)).otherwise((block - 1) * BLOCK + inside)
    rows = joined.withColumn(RANGE, place.cast("int")).withColumn("__cut", F.col("__heads").isNotNull())
    return Ranged(rows.drop("__blocks", "__heads", *names), list(keys), True)
