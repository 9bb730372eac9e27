"""Position-track operators: gaps and legs (W3-W5), jump filter (W6),
bearings (W7), last-per-bucket (A7) and bounding boxes (A9).

Skew: a key that holds a large share of the rows is cut into ranges of its
order (see :mod:`contrail.operators.ranges`); the state that crosses a range's
edge (the previous point's time, the number of leg starts so far, the start of
the latest leg) comes from one row a (key, range).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.geo import EARTH_RADIUS_KM, bearing_deg
from contrail.functions.time import epoch_micros, minute_label, truncate_minutes
from contrail.operators.ranges import RANGE, Ranged, same, with_ranges
from contrail.session import scratch_path

HOUR_US = 3_600_000_000


def _q(n: str) -> str:
    return f"`{n}`"


def _ts_kind(df: DataFrame, ts: str) -> str:
    return "timestamp" if isinstance(df.schema[ts].dataType, T.TimestampType) \
        else "timestamp_ntz"


def _timed(df: DataFrame, keys: list[str], ts: str, order: list[str] | None,
           range_rows: int | None) -> tuple[Ranged, list]:
    """Rows with ``__t`` (epoch micros) and their ranges; rows with a null key or time go."""
    pts = df.dropna(subset=[*keys, ts]).withColumn("__t", epoch_micros(ts, _ts_kind(df, ts)))
    order = ["__t", *(order or [])]
    return with_ranges(pts, keys, order, range_rows), [F.col(_q(o)) for o in order]


def _with_previous(ranged: Ranged, order: list) -> DataFrame:
    """Adds ``__prev``: ``__t`` of the key's row before, null on its first row."""
    rows = ranged.inherited(ranged.rows, [F.max("__t").alias("__last")],
                            {"__edge": F.lag("__last").over(ranged.by_range())})
    return rows.withColumn("__prev", F.coalesce(F.lag("__t").over(ranged.window(order)), "__edge")).drop("__edge")


def with_previous_time(df: DataFrame, keys: list[str], ts: str, order: list[str] | None = None,
                       range_rows: int | None = None) -> DataFrame:
    """Adds ``__t`` (epoch micros) and ``__prev`` (epoch micros of the previous row of
    the same key in time order; null on the key's first row).  Rows with a null key or
    time are dropped."""
    ranged, by = _timed(df, keys, ts, order, range_rows)
    return ranged.plain(_with_previous(ranged, by))


def _gap():
    return F.coalesce(F.floor((F.col("__t") - F.col("__prev")) / F.lit(HOUR_US)), F.lit(0)).cast("double")


def gap_hours(df: DataFrame, keys: list[str], ts: str, order: list[str] | None = None,
              range_rows: int | None = None) -> DataFrame:
    """Whole elapsed hours since the key's previous row (first row: 0).

    Truncating, like ``total_hours()`` of a duration: 15 h 59 m -> 15.
    """
    return with_previous_time(df, keys, ts, order, range_rows).withColumn("gap_hours", _gap())


def with_segments(df: DataFrame, keys: list[str], ts: str, max_gap_hours: float = 15.0,
                  order: list[str] | None = None, range_rows: int | None = None) -> DataFrame:
    """``segment_id`` = number of gaps > ``max_gap_hours`` up to the row
    (running per key, from 0).  Also adds ``gap_hours``."""
    ranged, by = _timed(df, keys, ts, order, range_rows)
    g = _with_previous(ranged, by).withColumn("gap_hours", _gap())
    g = ranged.stored(g.withColumn("__start", (F.col("gap_hours") > F.lit(float(max_gap_hours))).cast("int")))
    g = ranged.inherited(g, [F.sum("__start").alias("__n")],
                         {"__offset": F.sum("__n").over(ranged.before())})
    upto = ranged.window(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.plain(g.withColumn("segment_id", (F.coalesce("__offset", F.lit(0)) + F.sum("__start").over(upto))
                                     .cast("long")).drop("__offset"))


def latest_segment(df: DataFrame, keys: list[str], ts: str, max_gap_hours: float = 15.0,
                   order: list[str] | None = None, range_rows: int | None = None) -> DataFrame:
    """Only the rows of each key's latest leg (after its last long gap)."""
    ranged, by = _timed(df, keys, ts, order, range_rows)
    g = _with_previous(ranged, by)
    is_start = F.col("__prev").isNull() | (_gap() > F.lit(float(max_gap_hours)))
    g = ranged.stored(g.withColumn("__start_t", F.when(is_start, F.col("__t"))))
    whole_key = ranged.by_range().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    g = ranged.inherited(g, [F.max("__start_t").alias("__n")], {"__latest": F.max("__n").over(whole_key)})
    here = F.max("__start_t").over(ranged.whole())
    return (g.withColumn("__here", F.coalesce("__latest", here)).where(F.col("__t") >= F.col("__here"))
            .select(*[_q(c) for c in df.columns]))


def _haversine_np(lat1, lon1, lat2, lon2):
    la1, lo1, la2, lo2 = map(np.radians, (lat1, lon1, lat2, lon2))
    a = np.sin((la2 - la1) / 2) ** 2 + np.cos(la1) * np.cos(la2) * np.sin((lo2 - lo1) / 2) ** 2
    return EARTH_RADIUS_KM * 2 * np.arcsin(np.sqrt(a))


class _JumpFold:
    """State of the jump filter across the Arrow batches of one partition.

    Rows arrive sorted by (track, time).  While every point is kept the
    reference point is simply the previous row, so distances between
    consecutive rows are computed for the whole batch at once and runs of
    kept rows are accepted in bulk; after a rejected jump the distances to the
    last *kept* point are computed for growing blocks of rows.
    """

    def __init__(self, max_km: float):
        self.max_km = max_km
        self.key = None          # track of the previous row
        self.prev = None         # (lat, lng) of the previous row
        self.ref = None          # (lat, lng) of the last kept row
        self.consecutive = False  # ref is the previous row

    def keep_mask(self, keys, la, lo) -> np.ndarray:
        n = len(keys)
        newk = np.empty(n, dtype=bool)
        newk[0] = self.key is None or keys[0] != self.key
        if n > 1:
            newk[1:] = keys[1:] != keys[:-1]
        dcons = np.full(n, np.inf)
        if self.prev is not None:
            dcons[0] = _haversine_np(self.prev[0], self.prev[1], la[0], lo[0])
        if n > 1:
            dcons[1:] = _haversine_np(la[:-1], lo[:-1], la[1:], lo[1:])
        bad = newk | ~(dcons <= self.max_km)
        bad_idx = np.flatnonzero(bad)
        keep = np.zeros(n, dtype=bool)
        i = 0
        while i < n:
            if newk[i]:
                keep[i] = True
                self.ref, self.consecutive = (la[i], lo[i]), True
                i += 1
            elif self.consecutive:
                pos = np.searchsorted(bad_idx, i)
                k = bad_idx[pos] if pos < len(bad_idx) else n
                if k > i:  # rows i..k-1 are all within reach of their predecessor
                    keep[i:k] = True
                    self.ref = (la[k - 1], lo[k - 1])
                    i = k
                elif not newk[i]:  # a jump away from the previous (kept) row
                    self.consecutive = False
                    i += 1
            else:  # look for the next point in reach, in blocks that grow
                block = 64
                while i < n and not newk[i]:
                    ends = np.flatnonzero(newk[i:i + block])
                    stop = i + int(ends[0]) if len(ends) else min(n, i + block)
                    near = np.flatnonzero(_haversine_np(self.ref[0], self.ref[1], la[i:stop], lo[i:stop])
                                          <= self.max_km)
                    if len(near):
                        i += int(near[0])
                        keep[i] = True
                        self.ref, self.consecutive = (la[i], lo[i]), True
                        i += 1
                        break
                    i, block = stop, 2 * block
        self.key, self.prev = keys[-1], (la[-1], lo[-1])
        return keep


class _Sequences:
    """Numbers the runs of equal key columns over the batches of a sorted partition;
    null equals null."""

    def __init__(self, names: list[str]):
        self.names, self.number, self.last = names, 0, None

    def of(self, batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(batch.num_rows, bool)
        for name in self.names:
            codes = batch.column(name).dictionary_encode(null_encoding="encode").indices.to_numpy()
            new[1:] |= codes[1:] != codes[:-1]
        first = [batch.column(n)[0].as_py() for n in self.names]
        new[0] = self.last is not None and first != self.last
        self.last = [batch.column(n)[-1].as_py() for n in self.names]
        out = self.number + np.cumsum(new)
        self.number = int(out[-1])
        return out


def _floats(table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype("float64") if isinstance(table, pa.Table) \
        else table.column(name).to_numpy(zero_copy_only=False).astype("float64")


def _fresh_fold(chunk: list[str], lat: str, lng: str, max_km: float):
    """Sorted rows with ``__keep`` of a fold that keeps each chunk's first point, and
    ``__i``, a number that rises within a chunk."""

    def run(batches):
        state, sequences, at = _JumpFold(max_km), _Sequences(chunk), 0
        for batch in batches:
            if batch.num_rows:
                keep = state.keep_mask(sequences.of(batch), _floats(batch, lat), _floats(batch, lng))
                place = np.arange(at, at + batch.num_rows)
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place), pa.array(keep)],
                                                 names=[*batch.schema.names, "__i", "__keep"])

    return run


def _fold_from(rows: pa.Table, entry: tuple[float, float], lat: str, lng: str, max_km: float) -> np.ndarray:
    """Which rows of a chunk are kept when the last point kept before it is ``entry``."""
    state = _JumpFold(max_km)
    state.key, state.ref = 0, entry
    return state.keep_mask(np.zeros(rows.num_rows, np.int64), _floats(rows, lat), _floats(rows, lng))


def _walk(keys: list[str], max_km: float, window: int):
    """What is known of a track's chunks -> the entry points of the chunks that its
    true fold enters out of reach (``ask`` false), and where the first unknown stands,
    the chunks to fold from that entry next (``ask`` true).

    A chunk whose first point is in reach of the entry keeps that point, as the fresh
    fold does, and from a common point on two folds coincide: its exit is the fresh one.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = table.drop_columns(keys).to_pylist()
        chunks = sorted((r for r in rows if r["x_la"] is None), key=lambda r: r[RANGE])
        known = {(r[RANGE], r["la"], r["lo"]): (r["x_la"], r["x_lo"]) for r in rows if r["x_la"] is not None}
        out, here = [], None
        for i, c in enumerate(chunks):
            fresh = (c["f_la"], c["f_lo"])
            if here is None or _haversine_np(*here, c["la"], c["lo"]) <= max_km:
                here = fresh
                continue
            exit_ = known.get((c[RANGE], *here))
            if exit_ is None:
                out += [(d[RANGE], *here, True) for d in chunks[i:i + window] if (d[RANGE], *here) not in known]
                break
            out.append((c[RANGE], *here, False))
            here = exit_
        columns = [*zip(*out)] or [[]] * 4
        return pa.table([*(pa.concat_arrays([table.column(k).slice(0, 1).combine_chunks()] * len(out))
                           if out else table.column(k).slice(0, 0) for k in keys),
                         pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.float64()),
                         pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.bool_())],
                        names=[*keys, RANGE, "la", "lo", "ask"])

    return run


def _exits(keys: list[str], lat: str, lng: str, max_km: float):
    """A chunk's rows and the entries asked of it -> the exit of each entry; the entry
    itself where the chunk has no point in reach."""

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        rows = rows.sort_by("__i")
        la, lo, ends = _floats(rows, lat), _floats(rows, lng), []
        for entry in zip(_floats(asked, "la").tolist(), _floats(asked, "lo").tolist()):
            kept = np.flatnonzero(_fold_from(rows, entry, lat, lng, max_km))
            ends.append((la[kept[-1]], lo[kept[-1]]) if len(kept) else entry)
        return pa.table([*(asked.column(f"__a{i}") for i in range(len(keys))), asked.column("__ar").cast(pa.int32()),
                         asked.column("la"), asked.column("lo"),
                         pa.array([e[0] for e in ends], pa.float64()), pa.array([e[1] for e in ends], pa.float64())],
                        names=[*keys, RANGE, "la", "lo", "x_la", "x_lo"])

    return run


def _refolded(keys: list[str], names: list[str], lat: str, lng: str, max_km: float):
    """The rows of a chunk that the fold from its entry keeps."""

    def run(rows: pa.Table, entry: pa.Table) -> pa.Table:
        if not rows.num_rows or not entry.num_rows:
            return rows.select(names).slice(0, 0)
        rows = rows.sort_by("__i")
        kept = _fold_from(rows, (entry.column("la")[0].as_py(), entry.column("lo")[0].as_py()), lat, lng, max_km)
        return rows.filter(pa.array(kept)).select(names)

    return run


def jump_entries(folded: DataFrame, keys: list[str], rank: Column, lat: str, lng: str,
                 max_km: float) -> tuple[DataFrame, int]:
    """Entry points (``la``, ``lo``) of the chunks that the true fold enters out of
    reach of their first point, from the stored fresh folds; and the rounds it took.

    A chunk is a map from entry point to exit.  Almost all of it is one value, the
    exit of the fresh fold; the others are found when a track's walk over its chunks
    needs them.  An entry that a chunk lets pass is asked of twice as many chunks ahead
    in the next round, so a point that outlasts ``r`` ranges takes log2(r) rounds.
    Tables of a round hold some numbers a range.
    """
    pt = F.struct(F.col(_q(lat)).cast("double").alias("la"), F.col(_q(lng)).cast("double").alias("lo"))
    chunk = [*map(_q, keys), RANGE]
    key_types = ", ".join(f"`{k}` {folded.schema[k].dataType.simpleString()}" for k in keys)
    none = F.lit(None).cast("double")
    fresh = folded.groupBy(*chunk).agg(
        F.min_by(pt, rank).alias("__f"), F.max_by(F.when(F.col("__keep"), pt), F.when(F.col("__keep"), rank)).alias("__e"))
    state = fresh.select(*chunk, "__f.la", "__f.lo", F.col("__e.la").alias("f_la"), F.col("__e.lo").alias("f_lo"),
                         none.alias("x_la"), none.alias("x_lo")).checkpoint()
    for round_ in range(1, 1 << 30):
        entries = state.groupBy(*map(_q, keys)).applyInArrow(
            _walk(keys, max_km, 4 << round_), f"{key_types}, {RANGE} int, la double, lo double, ask boolean").checkpoint()
        asked = entries.where("ask").select(
            *[F.col(_q(k)).alias(f"__a{i}") for i, k in enumerate(keys)], F.col(RANGE).alias("__ar"), "la", "lo")
        if asked.isEmpty():
            return entries.drop("ask"), round_
        of = [f"__a{i}" for i in range(len(keys))]
        some = F.broadcast(asked.select(*of, "__ar").distinct())
        rows = folded.join(some, same([F.col(_q(k)) for k in keys], map(F.col, of)) & (F.col(RANGE) == F.col("__ar")),
                           "left_semi").select(*chunk, "__i", _q(lat), _q(lng))
        found = rows.groupBy(*chunk).cogroup(asked.groupBy(*of, "__ar")).applyInArrow(
            _exits(keys, lat, lng, max_km),
            f"{key_types}, {RANGE} int, la double, lo double, x_la double, x_lo double")
        state = state.unionByName(found.select(
            *chunk, "la", "lo", none.alias("f_la"), none.alias("f_lo"), "x_la", "x_lo")).checkpoint()


def filter_jumps(df: DataFrame, keys: list[str], ts: str, max_km: float = 400.0,
                 lat: str = "lat", lng: str = "lng", order: list[str] | None = None,
                 chunks: int | None = None, range_rows: int | None = None) -> DataFrame:
    """In time order keep a point when it lies within ``max_km`` of the
    last *kept* point of its track; a track's first point is always kept.  A null key
    is a track of its own.

    The rule is a fold (path dependent), yet one long track must not become one task.
    Rows are dealt by (track, range) and each such chunk is folded as if it started
    fresh, in one Arrow-batched pass with O(1) state.  A track of one range is done.
    For cut tracks the folds are stored, and :func:`jump_entries` finds the chunks that
    the true fold enters out of reach; only those are folded again, from their entry.
    ``chunks`` asks for about as many ranges as the table were dealt to evenly.
    """
    order = list(order or [])
    max_km = float(max_km)
    if chunks:
        range_rows = max(1, df.count() // chunks)
    ranged = with_ranges(df, keys, [ts, *order], range_rows)
    by = [F.col(_q(c)) for c in [ts, *order]]
    chunk = [*keys, RANGE]
    rows = ranged.rows.repartition(*ranged.parts()).sortWithinPartitions(*ranged.parts(), *by)
    schema = T.StructType([*rows.schema.fields, T.StructField("__i", T.LongType()),
                           T.StructField("__keep", T.BooleanType())])
    folded = rows.mapInArrow(_fresh_fold(chunk, lat, lng, max_km), schema)
    names = [_q(c) for c in df.columns]
    if not ranged.cut:
        return folded.where("__keep").select(*names)
    path = scratch_path(df.sparkSession, "jumps")
    folded.write.parquet(path)
    folded = df.sparkSession.read.schema(schema).parquet(path)
    cut = folded.where("__cut")
    entries, _ = jump_entries(cut, keys, F.struct(*by, F.col("__i")), lat, lng, max_km)
    of = [f"__a{i}" for i in range(len(keys))]
    entries = entries.select(*[F.col(_q(k)).alias(a) for k, a in zip(keys, of)], F.col(RANGE).alias("__ar"), "la", "lo")
    here = same([F.col(_q(k)) for k in keys], map(F.col, of)) & (F.col(RANGE) == F.col("__ar"))
    some = F.broadcast(entries)       # one row a range of a cut track at most
    again = cut.join(some, here, "left_semi").groupBy(*map(_q, chunk)).cogroup(entries.groupBy(*of, "__ar")) \
        .applyInArrow(_refolded(keys, df.columns, lat, lng, max_km), df.schema)
    return folded.where("__keep").join(some, here, "left_anti").select(*names).unionByName(again)


def bucket_positions(df: DataFrame, minutes: int = 15, key: str = "flight_code",
                     ts: str = "last_updated_utc", order: list[str] | None = None,
                     extra_keys: list[str] | None = None) -> DataFrame:
    """Per (flight, N-minute bucket) the latest snapshot's lat, lng and
    time (+ flight_type / heading_deg when present), with a text label.

    ``max_by`` over a struct is a partial aggregate: a hot flight is reduced
    map-side before the shuffle.
    """
    base = df.dropna(subset=["lat", "lng", ts])
    carried = ["lat", "lng", ts] + [c for c in ("flight_type", "heading_deg") if c in df.columns]
    rank = F.struct(F.col(ts), *[F.col(_q(o)) for o in (order or [])],
                    F.col("lat"), F.col("lng"))
    extra = list(extra_keys or [])
    out = (base.withColumn("time_bucket", truncate_minutes(ts, minutes))
               .groupBy(key, *extra, "time_bucket")
               .agg(F.max_by(F.struct(*carried), rank).alias("__r")))
    return out.select(key, *extra, "time_bucket",
                      *[F.col("__r").getField(c).alias(c) for c in carried],
                      minute_label("time_bucket").alias("time_label"))


def with_bearings(df: DataFrame, keys: list[str], order: list[str], lat: str = "lat", lng: str = "lng",
                  range_rows: int | None = None) -> DataFrame:
    """Bearing from the previous point; the first point looks ahead to
    the next; a lone point gets 0.0.  ``order`` starts with the time column."""
    ranged = with_ranges(df, keys, order, range_rows)
    rank = F.struct(*[F.col(_q(o)) for o in order])
    pt = F.struct(F.col(_q(lat)).alias("la"), F.col(_q(lng)).alias("lo"))
    rows = ranged.inherited(
        ranged.rows, [F.min_by(pt, rank).alias("__first"), F.max_by(pt, rank).alias("__last")],
        {"__before": F.lag("__last").over(ranged.by_range()), "__after": F.lead("__first").over(ranged.by_range())})
    w = ranged.window([F.col(_q(o)) for o in order])
    j = rows.withColumn("__prev", F.coalesce(F.lag(pt).over(w), "__before")) \
            .withColumn("__next", F.coalesce(F.lead(pt).over(w), "__after"))
    b = (F.when(F.col("__prev").isNotNull(),
                bearing_deg(F.col("__prev.la"), F.col("__prev.lo"), F.col(_q(lat)), F.col(_q(lng))))
          .when(F.col("__next").isNotNull(),
                bearing_deg(F.col(_q(lat)), F.col(_q(lng)), F.col("__next.la"), F.col("__next.lo")))
          .otherwise(F.lit(0.0)))
    return j.withColumn("bearing", b).select(*[_q(c) for c in df.columns], "bearing")


def track_bounds(df: DataFrame, keys: list[str], center_lat: float, center_lng: float,
                 padding_ratio: float = 0.15, min_padding: float = 0.08) -> DataFrame:
    """Padded bounding box of each track with the airport point added."""
    agg = df.groupBy(*keys).agg(
        F.least(F.min("lat"), F.lit(center_lat)).alias("lat_min"),
        F.greatest(F.max("lat"), F.lit(center_lat)).alias("lat_max"),
        F.least(F.min("lng"), F.lit(center_lng)).alias("lng_min"),
        F.greatest(F.max("lng"), F.lit(center_lng)).alias("lng_max"))
    lat_pad = F.greatest((F.col("lat_max") - F.col("lat_min")) * padding_ratio, F.lit(min_padding))
    lng_pad = F.greatest((F.col("lng_max") - F.col("lng_min")) * padding_ratio, F.lit(min_padding))
    return agg.select(*keys,
                      (F.col("lat_min") - lat_pad).alias("south"),
                      (F.col("lng_min") - lng_pad).alias("west"),
                      (F.col("lat_max") + lat_pad).alias("north"),
                      (F.col("lng_max") + lng_pad).alias("east"))
