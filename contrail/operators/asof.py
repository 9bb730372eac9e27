"""Nearest as-of join with tolerance (J2 keyed, J3 unkeyed).

Spark has no native as-of join.  This one is a sort-based sweep, never a
candidate-pair join, so a hot key or a busy hour cannot blow up into
``n x m`` pairs:

1. Time is cut into buckets of ``bucket_width`` (default: 8 x tolerance
   with a key, 2 x tolerance without one).
   Left rows are tagged with ``(by..., bucket)``.  A right row is tagged with
   its own bucket and, when it lies within tolerance of a bucket edge, also
   with the neighbouring bucket (about ``2 * tolerance / width`` = 25 % extra
   rows by default).  Every bucket therefore sees all right rows that can
   match any of its left rows.
2. Left and right rows are unioned and shuffled once on ``(by..., bucket, range)``.
   A bucket with more than ``split_rows`` rows of either side (by default a fixed
   number, see :mod:`contrail.operators.ranges`) is cut into ranges of its time, so
   neither a key nor a busy hour that holds a third of all rows meets in one task.
3. Inside each range two running windows (time ascending and time
   descending, both ``UNBOUNDED PRECEDING .. CURRENT ROW``, i.e. linear)
   carry the previous and the next right row to every left row.  Over the edges of
   a range come the last right row before it and the first one behind it, from one
   row a (bucket, range); no right row is copied to several ranges.
4. The nearer of the two within tolerance wins; on equal distance the later
   right row wins; among equal right times the last in ``right_order`` wins.
   Unmatched left rows are kept with nulls.  Null keys/times never match.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.time import epoch_micros
from contrail.operators.dedup import _orderable
from contrail.operators.ranges import with_ranges

_SPREAD = 4096  # buckets over which never-matching left rows are spread


def _q(n: str) -> str:
    return f"`{n}`"


def _dtype(df: DataFrame, col: str) -> str:
    dt = df.schema[col].dataType
    return "timestamp" if isinstance(dt, T.TimestampType) else "timestamp_ntz"


def _hashable(df: DataFrame) -> list:
    return [F.col(_q(f.name)) for f in df.schema.fields
            if not isinstance(f.dataType, T.MapType)]


def asof_nearest(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                 by: list[str] | tuple = (), tolerance: timedelta = timedelta(hours=1),
                 right_order: list[str] | None = None,
                 bucket_width: timedelta | None = None,
                 split_rows: int | None = None) -> DataFrame:
    """Left rows + the nearest right row (same ``by`` values) within tolerance.

    Output: all left columns, then the right columns except ``by`` (the right
    time column is kept, so a null there means "no match").
    """
    by = list(by)
    tol = int(round(tolerance.total_seconds() * 1_000_000))
    if bucket_width is None:
        # keyed: the key already spreads the work, keep right-row copies
        # rare (~25 %); unkeyed: time alone spreads the work, so use finer
        # buckets (each right row lands in at most two)
        width = (8 if by else 2) * tol or 3_600_000_000
    else:
        width = int(round(bucket_width.total_seconds() * 1_000_000))
    if tol < 0 or width <= 0:
        raise ValueError("tolerance must be >= 0 and bucket width > 0")

    right_payload = [c for c in right.columns if c not in by]
    clash = set(right_payload) & set(left.columns)
    if clash:
        raise ValueError(f"right columns clash with left columns: {sorted(clash)}")

    key_cols = [f"__k{i}" for i in range(len(by))]
    l_struct = T.StructType([f for f in left.schema.fields])
    r_fields = [right.schema[c] for c in right_payload]
    r_struct = T.StructType(r_fields)
    order = list(right_order or [])

    # Left side: never-matching rows (null key/time) get spread-out buckets.
    lt = epoch_micros(left_on, _dtype(left, left_on))
    l_null = F.col(_q(left_on)).isNull()
    for b in by:
        l_null = l_null | F.col(_q(b)).isNull()
    l_bucket = F.when(l_null, -1 - F.pmod(F.xxhash64(*_hashable(left)), F.lit(_SPREAD))) \
                .otherwise(F.floor(lt / F.lit(width)))
    spot = [*key_cols, "__b"]
    keyed = left.select(
        *[F.col(_q(b)).alias(kc) for b, kc in zip(by, key_cols)],
        l_bucket.alias("__b"), lt.alias("__t"), F.lit(1).alias("__side"),
        F.struct(*[F.col(_q(c)) for c in left.columns]).alias("__L"))
    # Right side: only rows that can match.
    rt = epoch_micros(right_on, _dtype(right, right_on))
    r_ok = F.col(_q(right_on)).isNotNull()
    for b in by:
        r_ok = r_ok & F.col(_q(b)).isNotNull()
    lo_b = F.floor((rt - F.lit(tol)) / F.lit(width))
    hi_b = F.floor((rt + F.lit(tol)) / F.lit(width))
    buckets = F.when(lo_b == hi_b, F.array(lo_b)).otherwise(F.sequence(lo_b, hi_b))
    ordered = [F.struct(*[F.col(_q(o)) for o in order]).alias("__o")] if order else []
    if not order and not all(_orderable(f.dataType) for f in r_fields):
        ordered = [F.struct(*[F.col(_q(f.name)) for f in r_fields if _orderable(f.dataType)]).alias("__o")]
    rhs = right.where(r_ok).select(
        *[F.col(_q(b)).alias(kc) for b, kc in zip(by, key_cols)],
        F.explode(buckets).alias("__b"), rt.alias("__t"), F.lit(0).alias("__side"), *ordered,
        F.struct(*[F.col(_q(c)) for c in right_payload]).alias("__R"))
    rhs = rhs.withColumn("__L", F.lit(None).cast(l_struct))
    lhs = keyed.withColumn("__R", F.lit(None).cast(r_struct))
    if ordered:
        lhs = lhs.withColumn("__o", F.lit(None).cast(rhs.schema["__o"].dataType))

    ranged = with_ranges(lhs.unionByName(rhs), spot, ["__t"], split_rows)
    tie = "__o" if ordered else "__R"  # the right row is its own order, carried once
    cand = F.when(F.col("__side") == 0, F.struct("__t", "__R"))

    def at(t):
        return F.when(F.col("__side") == 0, F.struct(t.alias("t"), F.col(tie).alias("o")))

    rows = ranged.inherited(
        ranged.rows, [F.max_by(cand, at(F.col("__t"))).alias("__last"), F.max_by(cand, at(-F.col("__t"))).alias("__first")],
        {"__before": F.last("__last", ignorenulls=True).over(ranged.before()),
         "__after": F.last("__first", ignorenulls=True).over(ranged.after())})

    def sweep(t):
        return ranged.window([t, F.col("__side").asc(), F.col(tie).asc()]) \
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def seen(t, edge):
        return F.coalesce(F.last(cand, ignorenulls=True).over(sweep(t)), edge)

    swept = rows.select("__t", "__side", "__L", seen(F.col("__t").asc(), "__before").alias("__prev"),
                        seen(F.col("__t").desc(), "__after").alias("__next")).where(F.col("__side") == 1)

    dp = F.col("__t") - F.col("__prev.__t")
    dn = F.col("__next.__t") - F.col("__t")
    next_ok = F.col("__next").isNotNull() & (dn <= tol)
    prev_ok = F.col("__prev").isNotNull() & (dp <= tol)
    use_next = next_ok & (~prev_ok | (dn <= dp))
    match = F.when(use_next, F.col("__next.__R")).when(prev_ok, F.col("__prev.__R"))
    return swept.select(F.col("__L.*"), match.alias("__M")).select(
        *[F.col(_q(c)) for c in left.columns], F.col("__M.*"))
