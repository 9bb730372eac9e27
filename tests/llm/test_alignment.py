"""Alignment of two tokenizers against a plain loop over the libraries' tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from contrail.llm import alignment
from contrail.llm.catalog import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens(text, a, b):
    """(id, bytes) of either side, None where the joined bytes differ."""
    if not text:
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in shown} | {
        chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}
    one = a.encode(" " + text, add_special_tokens=False)
    one = [(i, bytes(letters[c] for c in t)) for i, t in zip(one.ids, one.tokens)]
    two = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
           for i, p in zip(b.encode(text), b.encode(text, out_type=str))]
    whole = (" " + text).encode()
    if any(b"".join(x for _, x in side) != whole for side in (one, two)):
        return None
    return one, two


def brute(texts):
    a, b = libraries()
    docs, counts = [], Counter()
    for doc_id, text in texts:
        found = tokens(text, a, b)
        if found is None:
            docs.append((doc_id, 0, 0, [], ""))
            continue
        ends = []
        for side in found:
            at, here = 0, {}
            for k, (_, piece) in enumerate(side):
                at += len(piece)
                here[at] = k
            ends.append(here)
        links, groups, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0][end], ends[1][end]
            links.append((found[0][k][0], found[1][m][0]))
            groups.append(",".join(str(x) for x, _ in found[0][i:k + 1]) + "|"
                          + ",".join(str(x) for x, _ in found[1][j:m + 1]))
            i, j = k + 1, m + 1
        counts.update(links)
        docs.append((doc_id, len(found[0]), len(found[1]), links,
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, second), n in counts.items():
        best[second] = max(best[second], n)
    return sorted(((d, n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), sha) for d, n_a, n_b, links, sha in docs), key=str)


def run(spark, texts, **options):
    docs = spark.createDataFrame([(d, t, "x", b"y") for d, t in texts],
                                 "doc_id long, text string, groups string, pairs binary")
    got = alignment.score_links(docs, A, B, **options)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


TEXTS = [
    (1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "plain words, as they come"), (5, "plain words, as they come"),
    (None, "a null id"), (6, "Ünïcödé and 漢字かな, \U0001f600 zażółć"), (7, "a▁b differs"), (8, "\n\t tabs\r\n\r\nand lines\x00"),
    (9, "<|endoftext|> and </s><s><unk> are text"), (10, "ﬁ ligature Å"), (11, "x" * 5000), (12, "’s don't we'll"),
    (13, "1234567890 " * 300), (14, "﻿​\xa0odd　space s")]


def test_against_the_libraries(spark):
    assert run(spark, TEXTS) == brute(TEXTS)


def test_rare_pairs_and_a_text_that_a_third_of_the_rows_hold(spark):
    draw = random.Random(7)
    words = ["".join(draw.choices("abcdeilnorstuwyz", k=draw.randint(1, 9))) for _ in range(300)]
    texts = [(i, "the text that many rows hold, again and again" if i % 3 == 0 else " ".join(draw.choices(words, k=40)))
             for i in range(90)]
    texts.append((1000, " ".join(draw.choices(words, k=30_000))))
    expected = brute(texts)
    assert run(spark, texts) == expected                  # all pairs in the broadcast table
    assert run(spark, texts, share=0.01) == expected      # most of them joined
    assert run(spark, texts, share=2.0) == expected       # all of them


def test_an_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("seed", range(5))
def test_common_ends_and_overlaps(seed, monkeypatch):
    draw = random.Random(seed)
    size = 500
    one, two = (sorted({size, *draw.sample(range(1, size), n)}) for n in draw.sample([3, 40, 200, 450], 2))
    mine, theirs = alignment.common_ends(one, two)
    assert [one[i] for i in mine] == [two[j] for j in theirs] == sorted(set(one) & set(two))
    for this, that in ((one, two), (two, one)):
        assert alignment.overlaps(this, that) == [
            (min(js), max(js) + 1) for a, b in zip([0, *this], this)
            for js in [[j for j, (c, d) in enumerate(zip([0, *that], that)) if c < b and d > a]]]
    monkeypatch.setattr(alignment, "SPAN", 16)
    spans = alignment.aligned_ends(np.array(one), np.array(two))
    assert [x.tolist() for x in spans] == [mine, theirs]


def test_a_model_whose_tokens_join_words_is_encoded_whole(monkeypatch):
    side = alignment.PieceSide(B)
    assert not side.whole and side.pieces(" a  b\nc \n\n d ") == [" a", "  b", "\nc", " \n", "\n", " d "]
    assert side.pieces(" a  ") == [" a", "  "] and side.pieces("  ") == ["  "]
    monkeypatch.setattr(alignment, "_piece_table", lambda path: [b" of the"])
    assert alignment.PieceSide(B).pieces(" a b") == [" a b"]


def test_sums_let_go_of_pairs_and_stay_right(spark, monkeypatch):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    whole = alignment.link_counts(alignment.align(docs, A, B)).select("a_id", "b_id", "links", "best")
    rows = {tuple(r) for r in whole.collect()}
    held = alignment.HELD
    try:
        alignment.HELD = 7
        import pyarrow as pa
        table = alignment.align(docs, A, B).select("pairs", "times").toArrow()
        batches = table.cast(pa.schema([("pairs", pa.binary()), ("times", pa.binary())])).to_batches()
        parts = list(alignment._summed(iter(batches)))
    finally:
        alignment.HELD = held
    sums = Counter()
    for p in parts:
        for pair, n in zip(p.column(0).to_pylist(), p.column(1).to_pylist()):
            sums[pair] += n
    assert len(parts) > 1 and sums == {(a << 32) | b: n for a, b, n, _ in rows}
