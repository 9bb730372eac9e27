"""Stored tables of a few rows: few files, the same rows however many there are."""

import os

import pytest

from contrail.llm import common, components, exact_dedup, mixing, simhash

ALIKE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, f"{ALIKE} {k % 9}" if k % 3 else f"text number {k}", "abc"[k % 3]) for k in range(120)]
    return common.stored(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5))


@pytest.fixture
def wide(spark):
    """Small shuffles stay in 64 partitions."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def files(tmp_path, monkeypatch):
    """Stored files, in a folder that no other session uses."""
    monkeypatch.setattr(common, "checkpoint_dir", lambda s: s.sparkContext.setCheckpointDir(str(tmp_path)))
    return lambda: sum(x.startswith("part-") for _, _, names in os.walk(tmp_path) for x in names)


@pytest.mark.parametrize("name,run,most", [
    # fingerprints in five files, each table after them in one
    ("simhash", simhash.near_duplicates, 20),
    # digests and their runs in five, then a file a round
    ("exact", lambda d: exact_dedup.exact_duplicates(d, largest=True), 20),
    # the ranks of the sources are in a file for each of their ranges
    ("mixing", mixing.mix, 20)])
def test_small_tables_take_few_files(docs, wide, files, monkeypatch, name, run, most):
    got = sorted(run(docs).collect())
    assert len(got) == 120
    assert 0 < files() <= most
    monkeypatch.setattr(common, "FILE_ROWS", 3)
    assert sorted(run(docs).collect()) == got


def test_files_follow_the_rows():
    assert [common.files_of(n) for n in (0, 1, 1 << 15, (1 << 15) + 1, 10 ** 9)] == [1, 1, 1, 2, 30518]


@pytest.mark.parametrize("size", [0, 8 << 20])
def test_components_with_and_without_broadcasts(spark, monkeypatch, size):
    monkeypatch.setattr(components, "BROADCAST_BYTES", size)
    pairs = [(9, k) for k in range(10, 60)] + [(k, k + 1) for k in range(100, 140)] + [(59, 100), (3, 3), (None, 5)]
    got = components.components(spark.createDataFrame(pairs, "u long, v long"), "u", "v")
    assert sorted(map(tuple, got.collect())) == [(k, 9) for k in (*range(9, 60), *range(100, 141))]
