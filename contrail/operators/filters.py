"""Row filters (F1-F8)."""

from __future__ import annotations

from datetime import date, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.text import code_equals_ci, contains_ci
from contrail.functions.time import LOCAL_TZ, ntz_lit, today_local, utc_bounds


def filter_local_date_range(df: DataFrame, col: str, start: date, end: date,
                            tz: str = LOCAL_TZ) -> DataFrame:
    """rows whose timestamp falls on local calendar days start..end.

    The local range is turned into two UTC constants once, so the predicate
    is a plain range on the stored column and is pushed to the scan (and,
    on day-partitioned tables, prunes partitions).  Works for naive-UTC
    (``timestamp_ntz``) and instant (``timestamp``) columns alike.
    Unknown column -> unchanged; inverted range -> no rows.
    """
    if col not in df.columns:
        return df
    if start > end:
        return df.limit(0)
    lo, hi = utc_bounds(start, end, tz)
    if isinstance(df.schema[col].dataType, T.TimestampType):
        # instants: compare with the two UTC instants
        lo_c = F.lit(lo.replace(tzinfo=timezone.utc))
        hi_c = F.lit(hi.replace(tzinfo=timezone.utc))
    else:
        lo_c, hi_c = ntz_lit(lo), ntz_lit(hi)
    return df.where((F.col(col) >= lo_c) & (F.col(col) < hi_c))


def filter_local_day(df: DataFrame, col: str, on_date: date | None = None,
                     tz: str = LOCAL_TZ) -> DataFrame:
    """a single local day (default: today in ``tz``)."""
    day = on_date or today_local(tz)
    return filter_local_date_range(df, col, day, day, tz)


def filter_text(df: DataFrame, col: str, value: str | None) -> DataFrame:
    """case-insensitive literal substring; empty value or unknown column
    leaves the frame unchanged."""
    if not value or col not in df.columns:
        return df
    return df.where(contains_ci(col, value))


def filter_code_or_name(df: DataFrame, code_col: str, name_col: str,
                        value: str | None) -> DataFrame:
    """code contains value OR name contains value (name optional)."""
    if not value:
        return df
    cond = contains_ci(code_col, value)
    if name_col in df.columns:
        cond = cond | contains_ci(name_col, value)
    return df.where(cond)


def valid_coordinates(lat: str = "lat", lng: str = "lng"):
    """not at (0, 0) within 0.01 degrees, and inside the valid ranges."""
    la, lo = F.col(lat), F.col(lng)
    return (((F.abs(la) > 0.01) | (F.abs(lo) > 0.01))
            & la.between(-90, 90) & lo.between(-180, 180))


def filter_valid_coordinates(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    return df.where(valid_coordinates(lat, lng))


def filter_flight_code(df: DataFrame, code: str, col: str = "flight_code") -> DataFrame:
    """case-insensitive exact code match."""
    return df.where(code_equals_ci(col, code))


def drop_null_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """F7."""
    return df.dropna(subset=cols)
