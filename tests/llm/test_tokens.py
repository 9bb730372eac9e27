import base64
import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contrail.llm import byte_bpe, token_counts, token_files
from contrail.llm.pretokens import LATIN, ByteLevel, Cache, RecurringCache
from contrail.llm.wavelet import WaveletMatrix

RANKS = P.path("byte_bpe_50k.tiktoken")
ODD = list(" \t\n\r\x0b\x1c\x85 'srtveml dab12!?éß中́​　٣²\U0001F600\U00011de0İΣ") + \
    ["<|endoftext|>", "<|startoftext|>", "word ", chr(0x558), chr(0x1c89)]


def texts(n=150, seed=3):
    rng = random.Random(seed)
    out = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    out += [None, "", " ", "x" * 5000, "The don't  they'll go\n\n 12 34's" * 200, "same text"]
    return out + ["same text"]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts())],
                                 "doc_id long, text string, ids int, row string")


@pytest.mark.parametrize("chunk,overlap", [(1 << 16, 1 << 10), (40, 12), (300, 64)])
def test_byte_bpe_round_trip(spark, frame, reference, chunk, overlap):
    coded = byte_bpe.encode(frame, RANKS, chunk=chunk, overlap=overlap)
    assert coded.columns == ["doc_id", "text", "row", "ids"]
    got = byte_bpe.decode(coded, RANKS).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts())))
    for r in got:
        text = texts()[r.doc_id] or ""
        assert bytes(r.ids) == np.asarray(reference.encode_ordinary(text), "<u4").tobytes(), repr(text[:80])
        assert bytes(r.decoded) == text.encode()


@pytest.mark.parametrize("chunk,overlap", [(12, 9), (40, 12), (40, 40), (300, 64), (2048, 256)])
def test_stitched_chunks_are_the_split_of_the_whole(chunk, overlap):
    split, counts = ByteLevel(), []
    for text in texts(300, 5) + ["word " * 3000, " " * 5000 + "x", "a1" * 4000]:
        pieces, count = byte_bpe.split_chunks(text or "", split, chunk, overlap)
        assert pieces == split.split(text or "")
        assert count in (1, -(-len(text or "x") // chunk))
        counts.append(count)
    assert max(counts) > 1


def test_texts_of_ordinary_length_are_stitched(spark, reference):
    """No size but a chunk's own decides: several chunks within a batch, and over tasks."""
    prose = "The don't  they'll go\n\n 12 34's, and so on. "
    rows = [(1, prose * 30), (2, prose * 100), (3, prose * 3000), (4, "x" * 9000), (5, None), (6, "x" * 200_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_chunks int")
    got = {r.doc_id: r for r in byte_bpe.encode(df, RANKS, chunks_col="n_chunks").collect()}
    for key, text in rows:
        assert bytes(got[key].ids) == np.asarray(reference.encode_ordinary(text or ""), "<u4").tobytes()
    assert [got[k].n_chunks for k in range(1, 7)] == [1, 3, 3, 1, 1, 1]


def test_byte_level_split_is_the_pattern(reference):
    split = ByteLevel()
    for text in texts(400, 9):
        pieces = split.split(text or "")
        assert [i for p in pieces for i in reference.encode_ordinary(p)] == reference.encode_ordinary(text or "")


def test_token_counts(spark, frame):
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = token_counts.token_counts(frame, path).collect()
    assert len(got) == len(texts())
    for r in got:
        text = texts()[r.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512)


def test_frequent_table_holds_the_frequent(spark):
    df = spark.createDataFrame([(1, "the the the cat"), (2, " the end")] * 50, "doc_id long, text string")
    table = token_counts.frequent_lengths(df, P.path("byte_bpe_50k.json"), share=0.2)
    assert set(table) == {" the"} and table[" the"] == 1


def test_cache_stays_bounded():
    cache = Cache(len, limit=10)
    cache.plant({"abc": 3})
    for k in range(100):
        assert cache[str(k)] == len(str(k))
    assert cache["abc"] == 3 and len(cache) <= 11
    made = []
    cache = RecurringCache(lambda p: made.append(p) or len(p), limit=10)
    for k in range(100):
        assert cache["often"] == 5 and cache[str(k)] == len(str(k))
    assert made.count("often") == 1 and len(cache) + len(cache.before) <= 20


def latin_texts(n=400, seed=11):
    rng = random.Random(seed)
    letters = [*map(chr, range(256)), *("'" * 40), *" srtveml", "'s", "'re", "'LL", "'Ve", " 'd", "word ", " the", "don't"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_words_of_a_block_are_the_pattern():
    pattern = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN['L']}]+|[{LATIN['N']}]|"
                         f"[^{LATIN['S']}{LATIN['L']}{LATIN['N']}]+")
    for text in [*latin_texts(), "", "'", "'r", "a'", "'s", "'ll", "x'stop''s!'s"]:
        places, words = token_files.split_words(text.encode("latin-1"))
        found = list(pattern.finditer(text.lower()))
        assert places.tolist() == [m.start() for m in found], repr(text)
        assert [w.decode("latin-1") for w in words.to_pylist()] == [m[0] for m in found], repr(text)


@pytest.mark.parametrize("block", [1, 50, 4 << 20])
def test_texts_are_encoded_in_blocks_as_the_library_does(monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK", block)
    monkeypatch.setattr(token_files, "PIECE", 7)
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    some = [t or "" for t in texts()] + latin_texts() + ["", "x" * 3000, "", "\x1c a\x1db"]
    got = token_files.encode_texts(some, path)
    for text, ids in zip(some, got, strict=True):
        assert ids == np.asarray(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)
    assert token_files.encode_texts([], path) == []


def test_a_block_looks_its_distinct_words_up_once(monkeypatch):
    """The work in Python grows with the distinct words of a block, not with its words."""
    path, asked, made = P.path("word_bpe_49k.json"), [], []
    table = token_files.WordTable(lambda word: made.append(word) or [len(word), 7])
    look_up = table.look_up
    monkeypatch.setattr(table, "look_up", lambda words: asked.append(len(words)) or look_up(words))
    monkeypatch.setattr(token_files, "_words", lambda _: table)
    for _ in range(3):
        got = token_files.encode_texts(["one and Two\n" * 5000, "", "two and 3"] * 4, path)
    assert asked == [4] * 3 and sorted(made) == [b"3", b"and", b"one", b"two"]
    assert got[2] == np.asarray([3, 7, 3, 7, 1, 7], "<u4").tobytes() and len(got[0]) == 5000 * 24


def test_word_table_stays_bounded():
    rng, made = np.random.default_rng(4), []
    table = token_files.WordTable(lambda word: made.append(word) or list(word), limit=100)
    for k in range(200):
        block = sorted({b"often", *(b"w%d" % i for i in rng.integers(0, 5000, 30)), b"x" * (k % 3 * 4000)})
        first, n = table.look_up(pa.array(block, pa.binary()))
        assert [table.pool[a:a + m].tolist() for a, m in zip(first, n)] == [list(w) for w in block]
        assert len(table.words) <= 100 and len(table.pool) == len(b"".join(table.words.to_pylist())) <= 6400 + 8400
    assert made.count(b"often") == 1 and len(made) > 1000


def test_token_files(spark, tmp_dir):
    path, vocabulary = f"{tmp_dir}/shards", P.path("word_bpe_49k.json")
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "first"), (4, "twin"), (4, "twin")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    token_files.write_shards(df, path, vocabulary, shard_tokens=200)
    got = token_files.read_documents(spark, path).orderBy("start").collect()
    library = Tokenizer.from_file(vocabulary)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    start = 0
    for r, (doc, text) in zip(got, ordered, strict=True):
        ids = np.asarray([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens) == (doc, start, len(ids) // 4)
        assert zlib.crc32(bytes(r.tokens)) == zlib.crc32(ids)
        start += len(ids) // 4
    assert spark.read.parquet(path).count() > 10


def test_look_ups_in_token_files(spark, tmp_dir):
    path, vocabulary = f"{tmp_dir}/shards", P.path("word_bpe_49k.json")
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "first", "x"), (4, "twin", "x"), (4, "twin", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, matrix string").repartition(5)
    token_files.write_shards(df, path, vocabulary, shard_tokens=200)
    library = Tokenizer.from_file(vocabulary)
    every = [(doc, [*library.encode(text or "", add_special_tokens=False).ids, 2]) for doc, text, _ in rows]
    common = collections.Counter(t for _, ids in every for t in ids).most_common()
    asked = [2, common[1][0], common[-1][0], 49_000_000, 2]
    got = {r.token: r.n for r in token_files.count_tokens(spark, path, asked).collect()}
    assert got == {t: sum(ids.count(t) for _, ids in every) for t in asked}
    found = sorted(map(tuple, token_files.locate_tokens(spark, path, asked, at_once=7).collect()), key=str)
    assert found == sorted(((t, doc, k) for t in set(asked) for doc, ids in every
                            for k, i in enumerate(ids) if i == t), key=str)
    places = [(doc, k) for doc, ids in every[:40] for k in range(0, len(ids) + 2, 3)]
    places += [(None, 0), (None, None), (4, 0), (10**9, 0), (0, -1), (1, 0), (1, 0)]
    wanted = spark.createDataFrame(places, "doc_id long, offset long").withColumn("token", F.lit("clash"))
    got = sorted(map(tuple, token_files.tokens_at(spark, path, wanted, at_once=5).collect()), key=str)
    assert got == sorted(((d, k, ids[k]) for d, k in places for doc, ids in every
                          if doc == d and k is not None and 0 <= k < len(ids)), key=str)


def test_wavelet_matrix():
    rng = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 1), (700, 3), (3000, 49407), (5000, 70000)):
        tokens = rng.integers(0, top, n) if n else np.empty(0, np.int64)
        matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(tokens, 16).to_bytes())
        assert (matrix.to_array() == tokens).all()
        for i in rng.integers(0, max(n, 1), 20 if n else 0):
            token = int(tokens[i])
            assert matrix.access(int(i)) == token
            spots = np.flatnonzero(tokens == token)
            assert matrix.count(token) == len(spots)
            assert matrix.count(token, 10, int(i)) == ((spots >= 10) & (spots < i)).sum()
            k = int(rng.integers(0, len(spots)))
            assert matrix.locate(token, k) == spots[k]
        assert matrix.count(top + 5) == 0
        with pytest.raises(IndexError):
            matrix.access(n)


def test_empty_tables(spark, tmp_dir):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(df, RANKS), RANKS).collect() == []
    assert token_counts.token_counts(df, P.path("byte_bpe_50k.json")).collect() == []
    token_files.write_shards(df, f"{tmp_dir}/none", P.path("word_bpe_49k.json"))
    assert token_files.read_documents(spark, f"{tmp_dir}/none").collect() == []
    assert list(map(tuple, token_files.count_tokens(spark, f"{tmp_dir}/none", [7]).collect())) == [(7, 0)]
    assert token_files.locate_tokens(spark, f"{tmp_dir}/none", [7]).collect() == []
    assert token_files.tokens_at(spark, f"{tmp_dir}/none", df.selectExpr("doc_id", "1L AS offset")).collect() == []
