import hashlib
import random

import pytest

from contrail.llm import exact_dedup

SCHEMA = "doc_id long, text string, sha string, at int"


def brute(rows, largest):
    groups = {}
    for i, (doc, text, *_) in enumerate(rows):
        groups.setdefault(text or "", []).append(doc)
    pick = max if largest else min
    out = []
    for doc, text, *_ in rows:
        ids = groups[text or ""]
        known = [x for x in ids if x is not None]
        out.append((doc, pick(known) if known else None, len(ids),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("largest,width,bits", [(True, 8, 2), (False, 16, 4), (True, 2, 1)])
def test_matches_brute_force(spark, largest, width, bits):
    rng = random.Random(width)
    texts = ["", None, "a", "A", "é" * 40, "x" * 200_000] + [f"t{k}" for k in range(40)]
    rows = [(i if rng.random() > .05 else None, rng.choice(texts), "s", 1) for i in range(300)]
    rows += [(900 + i, "hot", None, None) for i in range(200)]
    got = exact_dedup.exact_duplicates(make(spark, rows).repartition(7), largest=largest,
                                       width=width, bits=bits).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == brute(rows, largest)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({t or "" for _, t, *_ in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_rows_that_repeat_id_and_text_keep_one(spark):
    rows = [(1, "a", None, 1), (1, "a", None, 2), (None, "b", None, 1), (None, "b", None, 1)]
    got = exact_dedup.exact_duplicates(make(spark, rows)).collect()
    assert sorted((r.text_sha256, r.kept) for r in got).count((got[0].text_sha256, True)) == 1
    assert sum(r.kept for r in got) == 2
    left = exact_dedup.drop_duplicates(make(spark, rows)).collect()
    assert sorted(str(r.text) for r in left) == ["a", "b"]


def test_drop_keeps_whole_rows(spark):
    rows = [(1, "a", "x", 1), (2, "a", "y", 2), (3, None, "z", 3), (4, "", "w", 4), (5, "c", None, None)]
    left = exact_dedup.drop_duplicates(make(spark, rows), largest=True)
    assert left.columns == ["doc_id", "text", "sha", "at"]
    assert sorted(map(tuple, left.collect())) == [(2, "a", "y", 2), (4, "", "w", 4), (5, "c", None, None)]


def test_empty_table(spark):
    assert exact_dedup.exact_duplicates(make(spark, [])).collect() == []
    assert exact_dedup.drop_duplicates(make(spark, [])).collect() == []
