"""Deterministic deduplication (W1 keep-last, W2 keep-any).

Spark has no row order, so "last" is defined by explicit order columns (the
ingest order: snapshot time, position in file ...).  Ties on the order are
broken by the row's own orderable values, so the result never depends on
partitioning or task timing.

Implemented as ``groupBy(keys).agg(max_by(row, order))`` rather than a
``row_number`` window: the aggregate is split into a partial (map-side) and a
final step, so a hot key is collapsed to one row per input partition before
the shuffle instead of sending all its rows to a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if hasattr(T, "VariantType") and isinstance(dt, T.VariantType):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def _q(n: str) -> str:
    return f"`{n}`"


def keep_last(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` values."""
    order = list(order or [])
    fields = df.schema.fields
    row = F.struct(*[F.col(_q(f.name)) for f in fields])
    rank = F.struct(*(F.col(_q(o)) for o in order))
    groups = [F.col(_q(k)) for k in keys]
    if all(_orderable(f.dataType) for f in fields):
        # the row itself breaks ties, so it is carried once: max(struct(rank, row))
        best = F.max(F.struct(rank.alias("o"), row.alias("r"))).getField("r")
    else:
        tiebreak = [F.col(_q(f.name)) for f in fields if _orderable(f.dataType)]
        best = F.max_by(row, F.struct(rank.alias("o"), F.struct(*tiebreak).alias("t")))
    agg = df.groupBy(*groups).agg(best.alias("__row"))
    return agg.select([F.col("__row").getField(f.name).alias(f.name) for f in fields])


def keep_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; deterministic (greatest row wins)."""
    return keep_last(df, keys, [])
