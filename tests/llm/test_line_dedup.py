import random
import re

import pytest

from contrail.llm import line_dedup


def brute(rows, window, unit=line_dedup.UNIT):
    """Lines that go, by the definition: compare every window with all earlier ones."""
    places = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        units = [(n, line, j) for n, line in enumerate(lines)
                 for j in range(-(-len(re.findall(r"[^ \t-\r]+", line)) // unit))]
        places.append((doc, lines, units))
    places = sorted(places, key=lambda p: (p[0] is None, p[0] or 0))
    first, out = {}, {}
    for doc, lines, units in places:
        gone = set()
        for i in range(len(units) - window + 1):
            key = tuple(u[1:] for u in units[i:i + window])
            place = first.setdefault(key, (doc, i))
            if place[0] != doc or i - place[1] >= window:
                gone |= {u[0] for u in units[i:i + window]}
        out[doc] = (sorted(gone), "\n".join(x for n, x in enumerate(lines) if n not in gone))
    return out


@pytest.mark.parametrize("window,kinds", [(3, 4), (2, 6), (3, 30), (5, 3)])
def test_matches_brute_force(spark, window, kinds):
    rng = random.Random(window * kinds)
    lines = [f"line {k}" for k in range(kinds)] + ["", "  ", "long " * 60, "é\x85 x"]
    rows = [(i * 2, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for i in range(120)]
    rows += [(1001, None), (1003, ""), (1005, "same\n" * 4000), (None, "line 0\nline 1\nline 2\nline 3")]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, lines string, i int")
    want = brute(rows, window)
    got = line_dedup.drop_repeated_lines(df.repartition(6), window).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (list(r.deleted), r.text) == want[r.doc_id], r.doc_id
        assert r.n_lines == (dict(rows)[r.doc_id] or "").count("\n") + 1


def test_passage_of_over_fifty_words_goes_once(spark):
    passage = " ".join(f"word{k}" for k in range(55))
    rows = [(1, f"head\n{passage}\ntail"), (2, f"other\n{passage}"), (3, passage), (4, "head\ntail")]
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "other", 3: "", 4: "head\ntail"}


def test_every_line_stays_somewhere(spark):
    rng = random.Random(9)
    lines = [f"l{k} " * 30 for k in range(12)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(10))) for i in range(40)]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x for r in got for x in r.text.split("\n")} >= {x for _, t in rows for x in t.split("\n")}
    assert sum(len(r.deleted) for r in got) > 200


def test_empty_table(spark):
    assert line_dedup.drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_single_repeated_lines_go(spark):
    rng = random.Random(4)
    lines = [f"line {k}" for k in range(40)] + ["", " \t", "long " * 60, "é\x85 x", "\x85"]
    rows = [(i * 2, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9)))) for i in range(80)]
    rows += [(1001, None), (1003, ""), (1005, "same\n" * 400), (None, "line 0\nnew at the end\nline 0")]
    want = brute(rows, 1)
    got = line_dedup.drop_every_repeat(spark.createDataFrame(
        [(*r, "x", 3) for r in rows], "doc_id long, text string, lines string, n int").repartition(6)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (list(r.deleted), r.text) == want[r.doc_id], r.doc_id
        assert r.n_lines == (dict(rows)[r.doc_id] or "").count("\n") + 1


def test_repeated_rows_and_short_lines(spark):
    rows = [(1, "all rights reserved\na"), (2, "b\nall rights reserved"), (2, "b\nall rights reserved"), (2, "a\nc")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in line_dedup.drop_every_repeat(df).collect())
    assert got == [(1, "all rights reserved\na"), (2, "b"), (2, "b"), (2, "c")]
    assert line_dedup.drop_every_repeat(df.limit(0)).collect() == []
