"""Every stage of the pipeline against a plain version of it, on its own input."""

import base64
import hashlib
import os
import re
import sys
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

from contrail.llm import quality, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Input and output of every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    extra = [(5000, None, "en", "src1", None), (5001, "", None, None, 0), (None, "An id is missing here.", "en", "src2", 1),
             (5002, "A document that is written twice, word for word.", "en", "src3", 1),
             (5003, "A document that is written twice, word for word.", "de", "src4", 1)] * 2
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    out, folder = [docs.collect()], tmp_path_factory.mktemp("stages")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    return out


def rows(table):
    return Counter(tuple(r[c] for c in COLUMNS) for r in table)


def test_quality_stage(spark, tables):
    model = quality.fit(spark.createDataFrame(tables[0]), spark.read.parquet(f"{SF}/labels.parquet"))
    want = [r for r in tables[0] if model.scores([quality.passages(r.text or "")])[0] >= 0.7]
    assert rows(tables[1]) == rows(want)
    assert 100 < len(want) < len(tables[0])


def test_exact_stage(tables):
    best = {}
    for r in tables[1]:
        best.setdefault(r.text or "", []).append(r)
    got = {r.text or "": r for r in tables[2]}
    assert len(got) == len(tables[2]) == len(best)
    for text, group in best.items():
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert got[text].doc_id == (max(ids) if ids else None)
        assert got[text] in group


def test_near_stage(tables):
    before = sorted(tables[2], key=lambda r: (r.doc_id is None, r.doc_id or 0))
    prints = [simhash.fingerprint(r.text or "") for r in before]
    group = list(range(len(before)))
    for a in range(len(before)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3 and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    assert rows(tables[3]) == rows([before[g] for g in sorted(set(group))])


def test_mixing_stage(tables):
    before, after = rows(tables[3]), rows(tables[4])
    assert set(after) <= set(before) and max(after.values()) <= 2
    size = lambda r: len(re.findall("[^\x20\x09-\x0D]+", r.text or ""))
    sizes, taken = Counter(), Counter()
    for r in tables[3]:
        sizes[r.source] += size(r)
    for r in tables[4]:
        taken[r.source] += size(r)
    longest = max(size(r) for r in tables[3])
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) < longest * len(sizes) / 2
    for source, n in sizes.items():
        assert taken[source] <= 2 * n


def test_token_stage(tables):
    ranks = {base64.b64decode(a): int(b) for a, b in
             map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in tables[4]}
    assert Counter(r.doc_id for r in tables[5]) == Counter(r.doc_id for r in tables[4])
    for r in tables[5]:
        ids = np.asarray(library.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_empty_table_runs_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if "text" in docs.columns:
            docs = spark.createDataFrame([], docs.schema)
        assert docs.collect() == []


def test_clashing_columns_and_a_very_long_text(spark, tmp_path):
    """Columns called like those that the stages add come through all stages."""
    names = ["__score", "score", "ids", "IDS_", "n_tokens", "ids_sha256", "Decoded_SHA256", "decoded", "sha",
             "size", "row", "taken", "chunks", "fingerprint", "component_id", "first", "id", "none"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    long = " ".join(r.text for r in docs.where("lang = 'en'").orderBy("doc_id").limit(60).collect()) * 4
    docs = docs.unionByName(spark.createDataFrame([(9000, long, "en", "src1", 1)], docs.schema))
    docs = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs.columns, spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before
    held = {"n_tokens": "n_tokens_", "ids": "ids__", "ids_sha256": "ids_sha256_", "Decoded_SHA256": "Decoded_SHA256_",
            "decoded": "decoded_"}
    assert "text" not in docs.columns and len({c.lower() for c in docs.columns}) == len(docs.columns)
    for r in docs.collect():
        assert all(r[held.get(n, n)] == f"{n}{r.doc_id}" for n in names)
        assert len(r.ids) == 4 * r.n_tokens


def test_whole_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100

