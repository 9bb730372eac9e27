"""Numeric / bucketing / labelling expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_int(c, target: str = "int") -> Column:
    """Through double, then truncate to an integer type."""
    return _col(c).cast("double").cast(target)


def null_default_int(c, default: float = 0.0, target: str = "int") -> Column:
    """P5: null -> default, then truncate to an integer type."""
    return F.coalesce(_col(c).cast("double"), F.lit(default)).cast(target)


def floor_step(c, step: float) -> Column:
    """``floor(c / step) * step`` as double."""
    return F.floor(_col(c) / F.lit(float(step))).cast("double") * F.lit(float(step))


def range_label(start, width: float, suffix: str) -> Column:
    """``"{start}-{start+width}{suffix}"`` with integer bounds.

    ``concat`` keeps nulls null, as the reference's formatter does.
    """
    s = _col(start)
    return F.concat(s.cast("long").cast("string"), F.lit("-"),
                    (s + F.lit(float(width))).cast("long").cast("string"),
                    F.lit(suffix))


# Visibility thresholds (metres) and level names.
VISIBILITY_LOW_BELOW = 3000
VISIBILITY_MEDIUM_BELOW = 8000


def visibility_level(c) -> Column:
    """Low / medium / high; null visibility falls through to high."""
    v = _col(c)
    return (F.when(v < VISIBILITY_LOW_BELOW, F.lit("low"))
            .when(v < VISIBILITY_MEDIUM_BELOW, F.lit("medium"))
            .otherwise(F.lit("high")))


def round2(c) -> Column:
    """Half-to-even rounding to two decimals."""
    return F.bround(_col(c), 2)


def value_map(c, mapping: dict, default) -> Column:
    """Literal lookup with a default for unknown keys."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*pairs)[_col(c)], F.lit(default))
