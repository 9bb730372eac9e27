"""Flight tracks for every flight at once.

The reference builds one track per request; here all tracks are built in
one distributed plan and a single flight is a pushed-down filter on top.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators.dedup import keep_last
from contrail.operators.filters import filter_flight_code, valid_coordinates
from contrail.operators.tracks import (bucket_positions, filter_jumps, latest_segment,
                                       track_bounds, with_bearings)

# Track parameters, airport point and side labels.
BUCKET_MINUTES = 15
MAX_GAP_HOURS = 15.0
MAX_LEG_JUMP_KM = 400.0
AIRPORT_LAT = 50.0777
AIRPORT_LNG = 19.7848
DEPARTURE_LABEL = "Odlot z KRK"
ARRIVAL_LABEL = "Przylot do KRK"


def track_points(positions: DataFrame, code: str | None = None,
                 max_gap_hours: float = MAX_GAP_HOURS,
                 max_leg_jump_km: float = MAX_LEG_JUMP_KM,
                 extra_keys: list[str] | None = None, chunks: int | None = None) -> DataFrame:
    """Cleaned points of each flight's latest leg, jumps removed.

    Tracks are keyed by the upper-cased code (plus ``extra_keys``, e.g. the
    side of a combined departures/arrivals input); buckets later use the
    stored code (so ``fr1`` and ``FR1`` are two bucket series of one track).
    """
    extra = list(extra_keys or [])
    df = positions
    if code is not None:
        df = filter_flight_code(df, code)
    cols = ["flight_code", "lat", "lng", "last_updated_utc"] + extra + \
        [c for c in ("heading_deg", "flight_type") if c in df.columns]
    df = (df.select(*cols)
            .dropna(subset=["lat", "lng", "last_updated_utc"])
            .where(valid_coordinates())
            .withColumn("track", F.upper("flight_code")))
    df = keep_last(df, ["flight_code", "last_updated_utc", "lat", "lng", *extra], [])
    df = latest_segment(df, ["track", *extra], "last_updated_utc", max_gap_hours,
                        order=["flight_code", "lat", "lng"])
    return filter_jumps(df, ["track", *extra], "last_updated_utc", max_leg_jump_km,
                        order=["flight_code", "lat", "lng"], chunks=chunks)


def flight_tracks(positions: DataFrame, flight_type: str | None, code: str | None = None,
                  bucket_minutes: int = BUCKET_MINUTES, max_gap_hours: float = MAX_GAP_HOURS,
                  max_leg_jump_km: float = MAX_LEG_JUMP_KM,
                  extra_keys: list[str] | None = None) -> DataFrame:
    """Bucketed latest-leg track of every flight (or of ``code``).
    ``flight_type=None`` keeps a ``flight_type`` column of the input."""
    extra = list(extra_keys or [])
    pts = track_points(positions, code, max_gap_hours, max_leg_jump_km, extra)
    if flight_type is not None:
        pts = pts.withColumn("flight_type", F.lit(flight_type))
    out = bucket_positions(pts.drop("track"), bucket_minutes, order=["lat", "lng"],
                           extra_keys=extra)
    return out.withColumn("track", F.upper("flight_code"))


def _side(positions: DataFrame, side: int, label: str) -> DataFrame:
    heading = F.col("heading_deg") if "heading_deg" in positions.columns \
        else F.lit(None).cast("double")
    return positions.select("flight_code", "lat", "lng", "last_updated_utc",
                            heading.alias("heading_deg"), F.lit(side).alias("__side"),
                            F.lit(label).alias("flight_type"))


def pick_flight_tracks(departures: DataFrame, arrivals: DataFrame, code: str | None = None,
                       bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Per track, the side (departures / arrivals) whose track has the
    newest point; on a tie departures win.  Both sides go through one track
    pipeline, keyed by (track, side)."""
    both_pos = _side(departures, 1, DEPARTURE_LABEL).unionByName(_side(arrivals, 0, ARRIVAL_LABEL))
    both = flight_tracks(both_pos, None, code, bucket_minutes, extra_keys=["__side"])
    newest = both.groupBy("track", "__side").agg(F.max("last_updated_utc").alias("__newest"))
    pick = newest.groupBy("track").agg(
        F.max_by("__side", F.struct("__newest", "__side")).alias("__side"))
    return both.join(pick, ["track", "__side"], "left_semi").drop("__side")


def path_points(tracks: DataFrame) -> DataFrame:
    """Every bucketed point with its bearing."""
    return with_bearings(tracks, ["track"], ["time_bucket", "flight_code"])


def tracks_bounds(tracks: DataFrame) -> DataFrame:
    """Padded map bounds of each track, airport point included."""
    return track_bounds(tracks, ["track"], AIRPORT_LAT, AIRPORT_LNG)
