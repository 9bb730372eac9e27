"""String predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_ci(col: str, value: str) -> Column:
    """Case-insensitive *literal* containment (never a regex)."""
    return F.lower(F.col(col).cast("string")).contains(F.lit(value.lower()))


def code_equals_ci(col: str, code: str) -> Column:
    """``upper(col) == upper(strip(code))``."""
    return F.upper(F.col(col)) == F.lit(code.strip().upper())
