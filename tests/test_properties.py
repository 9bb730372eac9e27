"""Property-based checks (Hypothesis) of the custom operators against
plain-Python definitions: many ties, tiny tolerances, any bucket width."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from contrail.operators.asof import asof_nearest
from contrail.operators.dedup import keep_last

BASE = datetime(2024, 1, 1)
times = st.integers(min_value=0, max_value=40)           # minutes: lots of equal times
keys = st.sampled_from(["a", "b", None])


def brute(L, R, tol):
    out = {}
    for lid, k, lt in L:
        best = None
        if k is not None and lt is not None:
            for rid, rk, rt in R:
                if rk != k:
                    continue
                dist = abs(rt - lt)
                if dist <= tol:
                    cand = (-dist, rt, rid)
                    if best is None or cand > best[0]:
                        best = (cand, rid)
        out[lid] = best[1] if best else None
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(L=st.lists(st.tuples(keys, st.one_of(st.none(), times)), min_size=1, max_size=25),
       R=st.lists(st.tuples(keys, times), max_size=25),
       tol=st.integers(min_value=0, max_value=12),
       width=st.one_of(st.none(), st.integers(min_value=1, max_value=30)))
def test_asof_property(spark, L, R, tol, width):
    Lr = [(i, k, t) for i, (k, t) in enumerate(L)]
    Rr = [(j, k, t) for j, (k, t) in enumerate(R)]
    ldf = spark.createDataFrame([(i, k, BASE + timedelta(minutes=t) if t is not None else None)
                                 for i, k, t in Lr], "lid long, k string, lt timestamp_ntz")
    rdf = spark.createDataFrame([(j, k, BASE + timedelta(minutes=t)) for j, k, t in Rr],
                                "rid long, k string, rt timestamp_ntz")
    out = asof_nearest(ldf, rdf, "lt", "rt", by=["k"], tolerance=timedelta(minutes=tol),
                       right_order=["rid"],
                       bucket_width=timedelta(minutes=width) if width else None)
    got = {r.lid: r.rid for r in out.collect()}
    assert got == brute(Lr, Rr, tol)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from("xyz"), st.integers(0, 3), st.integers(0, 5)),
                     min_size=1, max_size=40),
       parts=st.integers(1, 5))
def test_keep_last_property(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, o int, v int").repartition(parts)
    got = {(r.k, r.o, r.v) for r in keep_last(df, ["k"], ["o"]).collect()}
    exp = {max((r for r in rows if r[0] == k), key=lambda r: (r[1], r[0], r[1], r[2]))
           for k in {r[0] for r in rows}}
    assert got == exp


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(pts=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 6 * 24 * 60)),
                    min_size=1, max_size=40, unique=True))
def test_segments_property(spark, pts):
    """Gaps (whole hours) and leg ids across day buckets, empty days included."""
    from contrail.operators.tracks import latest_segment, with_segments
    rows = [(k, BASE + timedelta(minutes=m)) for k, m in pts]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz")
    got = {(r.k, r.t): (r.gap_hours, r.segment_id)
           for r in with_segments(df, ["k"], "t", 15.0).collect()}
    exp, latest = {}, set()
    for key in {k for k, _ in rows}:
        ts = sorted(t for k, t in rows if k == key)
        seg, prev, segs = 0, None, []
        for t in ts:
            gap = 0.0 if prev is None else float(int((t - prev).total_seconds() // 3600))
            if prev is not None and gap > 15.0:
                seg += 1
            exp[(key, t)] = (gap, seg)
            segs.append((t, seg))
            prev = t
        latest |= {(key, t) for t, s in segs if s == seg}
    assert got == exp
    assert {(r.k, r.t) for r in latest_segment(df, ["k"], "t", 15.0).collect()} == latest


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(pts=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 5 * 24 * 4),
                              st.floats(45, 55), st.floats(10, 25)),
                    min_size=1, max_size=30, unique_by=lambda p: (p[0], p[1])))
def test_bearings_property(spark, pts):
    import math
    from contrail.operators.tracks import with_bearings
    rows = [(k, BASE + timedelta(minutes=15 * q), la, lo) for k, q, la, lo in pts]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, lat double, lng double")
    got = {(r.k, r.t): r.bearing for r in with_bearings(df, ["k"], ["t"]).collect()}

    def bearing(a, b, c, d):
        x = math.sin(math.radians(d - b)) * math.cos(math.radians(c))
        y = (math.cos(math.radians(a)) * math.sin(math.radians(c))
             - math.sin(math.radians(a)) * math.cos(math.radians(c)) * math.cos(math.radians(d - b)))
        return (math.degrees(math.atan2(x, y)) + 360) % 360

    for key in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        for i, (_, t, la, lo) in enumerate(seq):
            if i > 0:
                exp = bearing(seq[i - 1][2], seq[i - 1][3], la, lo)
            elif len(seq) > 1:
                exp = bearing(la, lo, seq[1][2], seq[1][3])
            else:
                exp = 0.0
            diff = abs(got[(key, t)] - exp) % 360
            assert min(diff, 360 - diff) < 1e-6


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(frames=st.lists(st.dictionaries(st.sampled_from(["a", "b", "c"]),
                                       st.sampled_from(["int", "bigint", "double", "string"]),
                                       min_size=1), min_size=1, max_size=4))
def test_align_union_property(spark, frames):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    from contrail.operators.align import align_union

    samples = {"int": 1, "bigint": 2, "double": 2.5, "string": "s"}
    dfs = [spark.range(1).select(*[F.lit(samples[t]).cast(t).alias(c) for c, t in f.items()])
           for f in frames]
    out = align_union(dfs)

    def widen(x, y):  # the rule, written out independently
        if x == y:
            return x
        if {x, y} == {"bigint", "double"}:
            return "double"
        if "string" in (x, y):
            return "string"
        return "double"  # both numeric

    exp_types, order = {}, []
    for f in frames:
        for c, t in f.items():
            if c not in exp_types:
                order.append(c)
                exp_types[c] = t
            else:
                exp_types[c] = widen(exp_types[c], t)
    assert out.columns == order
    assert dict(out.dtypes) == exp_types
    assert out.count() == len(frames)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(minutes=st.lists(st.integers(0, 365 * 24 * 60), min_size=1, max_size=30),
       start=st.integers(0, 364), span=st.integers(0, 20))
def test_local_date_filter_property(spark, minutes, start, span):
    from datetime import date, timezone
    from zoneinfo import ZoneInfo
    from contrail.operators.filters import filter_local_date_range
    t0 = datetime(2025, 1, 1)
    rows = [(i, t0 + timedelta(minutes=m)) for i, m in enumerate(minutes)]
    lo = date(2025, 1, 1) + timedelta(days=start)
    hi = lo + timedelta(days=span)
    df = spark.createDataFrame(rows, "i long, ts timestamp_ntz")
    got = {r.i for r in filter_local_date_range(df, "ts", lo, hi).collect()}
    zone = ZoneInfo("Europe/Warsaw")
    exp = {i for i, ts in rows
           if lo <= ts.replace(tzinfo=timezone.utc).astimezone(zone).date() <= hi}
    assert got == exp


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.booleans(), st.one_of(st.none(), st.integers(-5, 90)),
                               st.one_of(st.none(), st.floats(-15, 35).map(lambda x: round(x, 1))),
                               st.floats(0, 15).map(lambda x: round(x, 1)),
                               st.one_of(st.none(), st.integers(0, 12000))),
                     min_size=1, max_size=30))
def test_weather_impact_property(spark, rows):
    import math
    from collections import defaultdict
    from contrail.plans.gold import weather_impact
    df = spark.createDataFrame(rows, "has_weather_match boolean, departure_delay_mins int, "
                                     "temp_celsius double, wind_speed_mps double, visibility_meters int")
    got = {(r.metric, r.bucket_label, r.bucket_start, r.bucket_end): (r.avg_departure_delay_mins, r.flight_count)
           for r in weather_impact(df).collect()}
    groups = defaultdict(list)
    for match, delay, temp, wind, vis in rows:
        if not match or delay is None:
            continue
        if temp is None:
            groups[("temperature_celsius", None, None, None)].append(delay)
        else:
            s = math.floor(temp / 5) * 5.0
            groups[("temperature_celsius", f"{int(s)}-{int(s + 5)} C", s, s + 5)].append(delay)
        w = math.floor(wind / 2) * 2.0
        groups[("wind_speed_mps", f"{int(w)}-{int(w + 2)} m/s", w, w + 2)].append(delay)
        level = "high" if vis is None or vis >= 8000 else ("low" if vis < 3000 else "medium")
        groups[("visibility_level", level, None, None)].append(delay)
    exp = {k: (round(sum(v) / len(v), 2), len(v)) for k, v in groups.items()}
    assert got == exp


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(L=st.lists(st.one_of(st.none(), times), min_size=1, max_size=25),
       R=st.lists(times, max_size=25), tol=st.integers(min_value=0, max_value=12))
def test_asof_unkeyed_property(spark, L, R, tol):
    Lr = [(i, "x", t) for i, t in enumerate(L)]
    Rr = [(j, "x", t) for j, t in enumerate(R)]
    ldf = spark.createDataFrame([(i, BASE + timedelta(minutes=t) if t is not None else None)
                                 for i, _, t in Lr], "lid long, lt timestamp_ntz")
    rdf = spark.createDataFrame([(j, BASE + timedelta(minutes=t)) for j, _, t in Rr],
                                "rid long, rt timestamp_ntz")
    out = asof_nearest(ldf, rdf, "lt", "rt", tolerance=timedelta(minutes=tol), right_order=["rid"])
    assert {r.lid: r.rid for r in out.collect()} == brute(Lr, Rr, tol)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(dep=st.lists(st.integers(0, 40 * 24 * 60), max_size=30),
       arr=st.lists(st.integers(0, 40 * 24 * 60), max_size=30))
def test_weekday_patterns_property(spark, dep, arr):
    from collections import Counter, defaultdict
    from contrail.plans import dashboard as D
    s = spark.createDataFrame([(BASE + timedelta(minutes=m),) for m in dep],
                              "scheduled_departure_utc timestamp_ntz")
    a = spark.createDataFrame([(BASE + timedelta(minutes=m),) for m in arr],
                              "last_updated_utc timestamp_ntz")
    got = {(r.direction, r.weekday): (r.flight_count, r.avg_flights_per_day, r.weekday_label)
           for r in D.weekday_patterns(s, a).collect()}
    exp = {}
    for direction, mins in ((D.DEPARTURES_DIRECTION, dep), (D.ARRIVALS_DIRECTION, arr)):
        per_day = Counter((BASE + timedelta(minutes=m)).date() for m in mins)
        by_wd = defaultdict(list)
        for day, n in per_day.items():
            by_wd[day.isoweekday()].append(n)
        for wd, counts in by_wd.items():
            exp[(direction, wd)] = (sum(counts), sum(counts) / len(counts), D.WEEKDAY_LABELS[wd])
    assert got == exp
