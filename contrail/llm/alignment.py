"""Alignment of two tokenizers' tokens by galloping intersection.

Both tokenizers cut the same bytes.  A token is known by the byte offset where it
ends, so a text gives two rising lists of ends.  The shorter list drives: for each
of its ends an exponential search from the last position brackets the place in the
longer list and a binary search finds it.  The ends that both lists hold cut the
text into groups, the smallest runs of tokens of either side that cover the same
bytes.  The place found for an end is also its rank in the other list, and the ranks
of a token's two ends bound the tokens of the other side that it overlaps.

Corpus-wide counts of linked pairs of ids start as sums within a task, so a pair
that every text holds is one row a task.  To put the counts back on the documents,
the pairs with a notable share of all links are broadcast (a share of 2^-k leaves
2^k pairs at most); the others are joined, and as none of those has that share, the
join meets no hot key.
"""

from __future__ import annotations

import functools
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import column, pieces_of, small_batches, text_of
from contrail.llm.pretokens import ByteLevel, RecurringCache, byte_letters, spelled
from contrail.session import scratch_path

#: Of all links, the share from which a pair of ids counts as frequent.
SHARE = 2.0 ** -17

#: Distinct pairs that a task sums up before it lets go of them.
HELD = 1 << 20


def common_ends(one: list[int], two: list[int]) -> tuple[list[int], list[int]]:
    """Positions in ``one`` and in ``two`` of the ends that both hold."""
    if len(one) > len(two):
        return common_ends(two, one)[::-1]
    n, low = len(two), 0
    two = [*two, float("inf")]
    mine, theirs = [], []
    for i, end in enumerate(one):
        if two[low] < end:
            low = _gallop(two, end, low, n)
        if two[low] == end:
            mine.append(i)
            theirs.append(low)
            low += 1
    return mine, theirs


def _gallop(ends: list[int], end: int, low: int, n: int) -> int:
    """First place after ``low`` whose end is not smaller: the bracket doubles, then halves."""
    step, high = 1, low + 1
    while high < n and ends[high] < end:
        low, high, step = high, high + 2 * step, step * 2
    return bisect_left(ends, end, low + 1, min(high, n))


#: Bytes of a text whose ends are compared at once.
SPAN = 1 << 18


def aligned_ends(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the common ends, span by span of the bytes."""
    mine, theirs = [], []
    cuts = np.arange(SPAN, (int(one[-1]) if len(one) else 0) + SPAN, SPAN)
    i = j = 0
    for up_to_i, up_to_j in zip(np.searchsorted(one, cuts).tolist(), np.searchsorted(two, cuts).tolist()):
        a, b = common_ends(one[i:up_to_i].tolist(), two[j:up_to_j].tolist())
        mine.append(np.array(a, np.int64) + i)
        theirs.append(np.array(b, np.int64) + j)
        i, j = up_to_i, up_to_j
    if not mine:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(mine), np.concatenate(theirs)


def overlaps(ends: list[int], other: list[int]) -> list[tuple[int, int]]:
    """For each token that ends at ``ends`` the range (end exclusive) of the tokens
    of the other side that share a byte with it, from the ranks of its two ends.
    Both lists cover the same bytes."""
    begin, rank, out = 0, 0, []
    for end in ends:
        if other[rank] < end:
            rank = _gallop(other, end, rank, len(other))
        out.append((begin, rank + 1))
        # a token that goes on beyond this end also overlaps the next one
        rank = begin = rank + (other[rank] == end)
    return out


class ByteLevelSide:
    """Tokens of the byte-level vocabulary at ``path``, special strings as text."""

    def __init__(self, path: str):
        self.path, self.split = path, ByteLevel()

    def pieces(self, text: str) -> list[str]:
        return self.split.split(text)

    @property
    def table(self) -> list[bytes]:
        return _byte_table(self.path)

    def encode(self, piece: str) -> list[int]:
        return [t.id for t in _model(self.path).tokenize(spelled(piece, _letters()))]


@functools.lru_cache(maxsize=1)
def _letters() -> dict[int, str]:
    return byte_letters()


@functools.lru_cache(maxsize=2)
def _model(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).model


@functools.lru_cache(maxsize=2)
def _byte_table(path: str) -> list[bytes]:
    back = {letter: byte for byte, letter in byte_letters().items()}
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    table = [b""] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        if all(c in back for c in token):
            table[i] = bytes(back[c] for c in token)
    return table


class PieceSide:
    """Tokens of the sentencepiece model at ``path``, which itself puts a space
    before a text; ``text`` here already has that space.

    Where no token of the model holds a space after another character, and none a
    line end beside another character, merges never cross such places, and a text is
    encoded in pieces that begin with spaces or a line end.
    """

    def __init__(self, path: str):
        self.path = path
        self.whole = any(b" " in t.lstrip(b" ") or len(t) > 1 and b"\n" in t for t in _piece_table(path))

    def pieces(self, text: str) -> list[str]:
        # one space before a line end or the end of the text is no piece by itself, as
        # the library gives "" no tokens
        return [text] if self.whole else _SPACED.findall(text)

    @property
    def table(self) -> list[bytes]:
        return _piece_table(self.path)

    def encode(self, piece: str) -> list[int]:
        if piece[0] == "\n":      # the library's own space is the first token
            return _processor(self.path).encode(piece)[1:]
        return _processor(self.path).encode(piece[1:])


_SPACED = re.compile(r" +\n?[^ \n]*(?: \Z)?|\n[^ \n]*(?: \Z)?")


@functools.lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.lru_cache(maxsize=2)
def _piece_table(path: str) -> list[bytes]:
    model = _processor(path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(names)]


class Encoder:
    """Texts -> ids, piece by piece through a bounded cache; None where the bytes of
    a text's tokens are not the text."""

    def __init__(self, side):
        self.side, self.table = side, side.table
        self.lengths = np.array([len(t) for t in self.table], np.int64)
        self.cache = RecurringCache(self._make, 400_000)

    def _make(self, piece: str) -> bytes:
        ids = self.side.encode(piece)
        if b"".join(map(self.table.__getitem__, ids)) != piece.encode():
            return b"-"     # no multiple of four bytes: the mark of a piece that differs
        return np.asarray(ids, "<u4").tobytes()

    def ids(self, text: str) -> np.ndarray | None:
        found = list(map(self.cache.__getitem__, self.side.pieces(text)))
        if b"-" in found:
            return None
        return np.frombuffer(b"".join(found), "<u4")

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.lengths[ids])


@functools.lru_cache(maxsize=4)
def _encoder(kind: type, path: str) -> Encoder:
    """One for each worker, tokenizer and file."""
    return Encoder(kind(path))


class Grouping:
    """Writes the groups of a text: ids joined by commas, ``|`` between the two
    sides, ``;`` between groups."""

    def __init__(self, sizes: tuple[int, int]):
        most = max(sizes)
        self.words = [f"{i}{mark}" for mark in ",|;" for i in range(most)]
        self.most = most

    def write(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[last_a], mark_b[last_b] = 1, 2
        # the place of each token: the tokens of its own side before it and those of
        # the other side in the groups before (for b: its own group too)
        group_a = np.cumsum(mark_a == 1) - (mark_a == 1)
        group_b = np.cumsum(mark_b == 2) - (mark_b == 2)
        b_before = np.concatenate(([0], last_b + 1))
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + b_before[group_a]] = a + mark_a * self.most
        out[np.arange(len(b)) + last_a[group_b] + 1] = b + mark_b * self.most
        return "".join(map(self.words.__getitem__, out.tolist()))[:-1]


@functools.lru_cache(maxsize=2)
def _grouping(sizes: tuple[int, int]) -> Grouping:
    return Grouping(sizes)


def _aligned(a_kind: type, a_path: str, b_kind: type, b_path: str):
    """Batches (id, text) -> one row a text, see :func:`align`."""

    def one(text: str, a: Encoder, b: Encoder, words: Grouping):
        ids_a, ids_b = (a.ids(" " + text), b.ids(" " + text)) if text else (None, None)
        if ids_a is None or ids_b is None:
            return 0, 0, 0, "", b"", b""
        at_a, at_b = aligned_ends(a.ends(ids_a), b.ends(ids_b))
        pairs, times = np.unique(ids_a[at_a].astype("<u8") << np.uint64(32) | ids_b[at_b],
                                 return_counts=True)
        return (len(ids_a), len(ids_b), len(at_a), words.write(ids_a.astype(np.int64), ids_b, at_a, at_b),
                pairs.tobytes(), times.astype("<u4").tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _encoder(a_kind, a_path), _encoder(b_kind, b_path)
        words = _grouping((len(a.table), len(b.table)))
        for batch in pieces_of(batches, rows=64):
            got = [one(t, a, b, words) for t in batch.column(1).to_pylist()]
            columns = [*zip(*got)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]),
                 pa.array(columns[3], pa.large_string()).cast(pa.string()),
                 *(pa.array(c, pa.binary()) for c in columns[4:])],
                names=["doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"])

    return run


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          a_kind: type = ByteLevelSide, b_kind: type = PieceSide) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_a``, ``n_b`` (tokens of either side of a
    space and the text), ``n_groups`` (ends that both have), ``groups`` (their ids,
    ``a1,a2|b1;a3|b2,b3``), and the linked pairs of ids, whose tokens end together:
    ``pairs`` (distinct, the first id in the upper half of a little-endian 64-bit
    number, rising) and ``times`` (32-bit counts).

    A text that is null or empty, or whose tokens' joined bytes on either side are
    not a space and the text, has no tokens: zeros and empty values.  Repeated rows
    each get their row; an empty table gives an empty result; other columns are
    ignored.
    """
    small_batches(docs.sparkSession)
    return docs.select(column(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        _aligned(a_kind, a_path, b_kind, b_path),
        "doc_id long, n_a long, n_b long, n_groups long, groups string, pairs binary, times binary")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pairs, times) -> (pair, links) summed over a task, let go at ``HELD`` pairs."""
    def rows(pairs, counts):
        return pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(counts)],
                                          names=["pair", "links"])

    def merged(parts):
        pairs, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        return pairs, np.bincount(place, np.concatenate([c for _, c in parts]), len(pairs)).astype(np.int64)

    held, fresh, size = [], [], 0
    for batch in batches:
        for p, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            fresh.append((np.frombuffer(p, "<u8"), np.frombuffer(t, "<u4")))
            size += len(fresh[-1][0])
            if size >= HELD:
                held, fresh, size = [merged(held + fresh)], [], 0
                if len(held[0][0]) >= HELD:
                    yield rows(*held[0])
                    held = []
    if held or fresh:
        yield rows(*merged(held + fresh))


def link_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``a_id``, ``b_id``, ``links`` (how many links of the corpus join the two ids) and
    ``best`` (no other first id has more links with this second id)."""
    counts = (aligned.where("n_groups > 0").select("pairs", "times")
              .mapInArrow(_summed, "pair long, links long")
              .groupBy("pair").agg(F.sum("links").alias("links")))
    # a second id has at most one row for each token of the first vocabulary
    of_second = Window.partitionBy("b_id")
    return counts.select(
        "pair", F.shiftright("pair", 32).alias("a_id"),
        F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b_id"), "links").withColumn(
        "best", F.col("links") == F.max("links").over(of_second))


def _looked_up(table):
    """(row, pairs, times) -> (row, found: links times their counts, best links) and,
    for pairs that the table of frequent ones lacks, one row each (row, pair, times)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, links, best = table.value
        for batch in pieces_of(batches, rows=64):
            row = batch.column(0).to_numpy()
            pairs = [np.frombuffer(p, "<u8") for p in batch.column(1).to_pylist()]
            places = np.repeat(np.arange(len(row)), [len(p) for p in pairs])
            pairs = np.concatenate(pairs).view(np.int64)
            times = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u4").astype(np.int64)
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            sums = np.zeros((2, len(row)), np.int64)
            np.add.at(sums[0], places[hit], times[hit] * links[at[hit]])
            np.add.at(sums[1], places[hit], times[hit] * best[at[hit]])
            lost = ~hit
            none = pa.nulls(len(row), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((row, row[places[lost]]))),
                 pa.concat_arrays([none, pa.array(pairs[lost])]),
                 pa.concat_arrays([pa.array(sums[0]), pa.array(times[lost])]),
                 pa.concat_arrays([pa.array(sums[1]), pa.nulls(int(lost.sum()), pa.int64())])],
                names=["row", "pair", "value", "best"])

    return run


def score_links(docs: DataFrame, a_path: str, b_path: str, share: float = SHARE, **options) -> DataFrame:
    """:func:`align` with ``groups_sha256`` ('' without tokens) in place of the groups,
    and ``n_links``, ``n_best`` (links whose pair is the best of its second id) and
    ``count_sum`` (the corpus-wide counts of a document's links, added up).

    Cases as in :func:`align`; a document without links has zeros.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "alignment")
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    (align(docs, a_path, b_path, **options)
     .select(F.monotonically_increasing_id().alias("row"), "*", digest.alias("groups_sha256")).drop("groups")
     .write.option("compression", "zstd").parquet(path))
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("row", T.LongType()), ("doc_id", T.LongType()), ("n_a", T.LongType()), ("n_b", T.LongType()),
        ("n_groups", T.LongType()), ("pairs", T.BinaryType()), ("times", T.BinaryType()),
        ("groups_sha256", T.StringType()))])
    aligned = spark.read.schema(schema).parquet(path)
    counted = scratch_path(spark, "alignment-counts")
    link_counts(aligned).write.parquet(counted)
    counts = spark.read.schema("pair long, a_id long, b_id long, links long, best boolean").parquet(counted)
    total = counts.agg(F.sum("links")).first()[0] or 0
    frequent = F.col("links") >= F.lit(total * share)
    top = counts.where(frequent).select("pair", "links", "best").collect()
    top.sort(key=lambda r: r["pair"])
    table = spark.sparkContext.broadcast(tuple(
        np.array([r[c] for r in top], np.int64) for c in ("pair", "links", "best")))
    looked = scratch_path(spark, "alignment-links")
    small_batches(spark)
    aligned.where("n_groups > 0").select("row", "pairs", "times").mapInArrow(
        _looked_up(table), "row long, pair long, value long, best long").write.parquet(looked)
    looked = spark.read.schema("row long, pair long, value long, best long").parquet(looked)
    rare = looked.where("pair is not null").join(counts.where(~frequent).select(
        "pair", "links", F.col("best").alias("is_best")), "pair").select(
        "row", (F.col("value") * F.col("links")).alias("value"),
        F.when(F.col("is_best"), F.col("value")).otherwise(0).alias("best"))
    sums = looked.where("pair is null").select("row", "value", "best").unionByName(rare).groupBy("row").agg(
        F.sum("value").alias("count_sum"), F.sum("best").alias("n_best"))
    return aligned.select("row", "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
                          "groups_sha256").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")], "groups_sha256")
