"""Clustering with Orchard's search against plain loops."""

import hashlib
import math
import random

import numpy as np

from contrail.llm import orchard

SCHEMA = "vec_id long, embedding array<float>, cluster string, v int"


def brute(rows, k, rounds, scale, size, seed=2):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))

    def order(row):
        i, v = row
        return (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "", v)

    centres = [v for _, v in sorted(kept, key=order)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c
                   for j, c in enumerate(centres)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    of = {}
    for _, j, d in found:
        of[j] = of.get(j, 0) + d
    return sorted(((i, j, d, of[j], sum(of.values()), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
                   for i, j, d in found), key=str)


def run(spark, rows, **options):
    got = orchard.cluster(spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA), **options)
    return sorted((tuple(r) for r in got.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", orchard.digest()).collect()), key=str)


def test_against_plain_loops(spark):
    draw = random.Random(2)
    rows = [(i, [draw.gauss(i % 5, 1) for _ in range(6)]) for i in range(300)]
    options = dict(k=9, rounds=4, scale=16, size=6)
    assert run(spark, rows, **options) == brute(rows, **options)


def test_ties_repeats_empty_clusters_and_vectors_left_out(spark):
    rows = [(1, [0.0, 0.0])] * 40 + [(2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, [0.5, 0.0]), (4, [0.25, 0.0]),
            (None, [2.0, 2.0]), (5, None), (6, [1.0]), (7, [1.0, 2.0, 3.0]), (8, [math.nan, 1.0]),
            (9, [1.0, -math.inf]), (10, [None, 1.0]), (11, [-3.0, -0.1])]
    options = dict(k=5, rounds=3, scale=4, size=2)
    assert run(spark, rows, **options) == brute(rows, **options)


def test_fewer_vectors_than_centroids_and_an_empty_table(spark):
    options = dict(k=4, rounds=2, scale=8, size=2)
    rows = [(1, [0.5, 1.5]), (2, [-0.5, 1.0])]
    assert run(spark, rows, **options) == brute(rows, **options)
    assert run(spark, [], **options) == []
    assert run(spark, [(1, None)], **options) == []


def test_the_walk_finds_the_nearest_and_skips_the_far():
    draw = np.random.default_rng(4)
    centres = draw.integers(-50, 50, (12, 2)).repeat(2, axis=0)[:20] * 40    # equal centroids too
    vectors = draw.integers(-2000, 2000, (500, 2))
    trees = orchard.Orchard(centres)
    cluster, distance = trees.nearest(vectors)
    every = ((vectors[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert trees.measured < 0.8 * every.size
