import random
import re

import pytest
from pyspark.sql import functions as F

from contrail.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, slot long"


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + \
        ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    budget, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        level = max(0, budget - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > most * sizes[s]]
        if not over:
            return {**fixed, **{s: weight[s] * level for s in free}}
        fixed.update({s: most * sizes[s] for s in over})


def words(text):
    return len(re.findall("[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    names = ["b", "a", "aé", "Z", None, "hot", "tiny", "void"]
    out = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 60))),
            rng.choice(names[:5] + ["hot"] * 4), "x", 1) for i in range(600)]
    out += [(700, "one\x0btwo\tthree\n four", "tiny", "x", 1), (701, None, "void", "x", 1), (702, "", "b", "x", 1),
            (None, "no id here", "a", None, None), (5, "w " * 5000, "hot", "x", 1)]
    return out + [(800, "same row", "a", "x", 1)] * 3


def test_targets_and_taken(spark, rows):
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    want = targets(sizes)
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, n in taken.items():
        assert abs(n - want[source]) <= 3, source
    again = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_mixture_repeats_whole_documents(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mixture(df)
    assert got.columns == df.columns
    times = {}
    for r in got.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(v for k, v in times.items() if k not in (800, 5)) <= 2
    sizes, taken = {}, {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    for r in got.collect():
        taken[r.source] = taken.get(r.source, 0) + words(r.text)
    for source, want in targets(sizes).items():
        assert abs(taken.get(source, 0) - want) <= (2501 if source == "hot" else 45), source


def test_feasible_only_at_the_maximum(spark):
    df = spark.createDataFrame([(1, "a b", "s"), (2, "c", "t")], "doc_id long, text string, source string")
    got = mixing.mix(df, share=9.0).orderBy("doc_id").collect()
    assert [(r.target, r.taken) for r in got] == [(4.0, 4), (2.0, 2)]


def test_empty_table_and_empty_texts(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).collect() == []
    got = mixing.mix(spark.createDataFrame([(1, "", "s"), (2, None, None)], schema)).collect()
    assert [(r.size, r.taken) for r in got] == [(0, 0), (0, 0)]


def test_word_count(spark):
    texts = ["", " ", "a", "\x1ca b\x85c", "a\x0b\x0cb\r\nc", "é b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(mixing.word_count(F.col("t"))).collect()]
    assert got == [words(t) for t in texts]
