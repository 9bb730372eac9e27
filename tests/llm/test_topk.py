"""Top-k by no-random-access aggregation against brute force."""

import math
import random

import numpy as np
import pytest

from contrail.llm import topk

SCHEMA = "vec_id long, embedding array<float>, rank string, id int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)


def brute(rows, k=10, scale=1024, every=100):
    kept = {}
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            w = tuple(math.floor(scale * float(np.float32(x))) for x in v)
            kept[(i, w)] = None
    kept = list(kept)
    out = []
    for q, w in kept:
        if q is None or q % every:
            continue
        scored = [(-sum(a * b for a, b in zip(w, x)), i is None, i or 0, i) for i, x in kept
                  if (i, x) != (q, w) and len(x) == len(w)]
        out += [(q, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def run(spark, rows, **options):
    got = topk.top_k(table(spark, rows), **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    """Several blocks of candidates and of queries."""
    monkeypatch.setattr(topk, "CANDIDATES", (64, 64))
    monkeypatch.setattr(topk, "QUERIES", 8)
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 1) for _ in range(16)]) for i in range(700)]
    assert run(spark, rows, every=20) == brute(rows, every=20)


def test_ties_repeats_and_vectors_left_out(spark):
    same = [0.5, -0.25, 0.0]
    rows = [(i, same) for i in (0, 3, 1, 7, 100)] + [(0, same), (0, [0.5, 0.5, 0.5]), (None, same), (None, None)]
    rows += [(5, None), (6, [0.1, None, 0.2]), (8, [math.nan, 0.0, 1.0]), (9, [math.inf, 0.0, 1.0]),
             (10, [0.5, 0.5]), (200, [1.0, 1.0]), (300, []), (11, []), (400, [0.0, 0.0, 0.0])]
    assert run(spark, rows, k=3) == brute(rows, k=3)


def test_fewer_candidates_than_k_and_an_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0])]) == []
    assert run(spark, [(100, [1.0]), (7, [-2.0])]) == [(100, 1, 7, -2 * 1024 * 1024)]


def test_a_third_of_the_rows_alike(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", (64, 64))
    draw = random.Random(5)
    rows = [(i, [1.0, 0.5, -0.5, 0.25] if i % 3 == 0 else [draw.gauss(0, 1) for _ in range(4)])
            for i in range(600)]
    assert run(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(2.0 ** 19 + i)), 3.0]) for i in range(0, 201, 5)]
    assert run(spark, rows, scale=1024) == brute(rows)


@pytest.mark.parametrize("kind", ["dense", "sparse", "one"])
def test_reading_stops_early_and_loses_nothing(kind):
    draw = np.random.default_rng(1)
    values = draw.integers(-300, 300, (2000, 6))
    if kind == "sparse":
        values[draw.random(values.shape) < 0.8] = 0
    query = draw.integers(-300, 300, 6)
    if kind == "one":
        query[1:] = 0
    lists = topk.Lists(values)
    read = []
    plain = lists.read
    lists.read = lambda *a: (read.append(a[2]), plain(*a))[1]
    rows, scores = topk.search(query, lists, 10)
    every = values @ query
    tenth = np.sort(every)[-10]
    assert set(np.flatnonzero(every > tenth)) <= set(rows)
    assert (every[rows] == scores).all() and (every > tenth).sum() + (scores == tenth).sum() >= 10
    assert set(np.flatnonzero(every == tenth)) <= set(rows)
    assert max(read) < 2000     # not to the ends of the lists
