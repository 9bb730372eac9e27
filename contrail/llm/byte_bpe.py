"""Byte-level BPE encoding and decoding by overlapping chunks.

The split pattern has no look-behind: what it matches from a position on depends
on the text from there on alone.  So two runs of it over the same text that share
one boundary share all later ones.  A long text is cut into chunks that overlap;
all are split and encoded in parallel.  Within an overlap the chunk also runs the
pattern afresh from where its successor starts: the first boundary that both runs
have is where the successor takes over, and the successor drops the ids before it.
A text whose overlap holds no common boundary (a pre-token longer than the
overlap) is encoded in one piece.  Texts of one chunk need no shuffle.
"""

from __future__ import annotations

import base64
import bisect
import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import column, pieces_of, small_batches, text_of
from contrail.llm.pretokens import ByteLevel, Cache

#: A boundary this close to a cut may be the cut's doing: longer than any
#: look-ahead of the pattern.
MARGIN = 8

#: Characters of a chunk within a batch, and of its overlap with the next.
CHUNK, OVERLAP = 2048, 256

#: Rows that a worker gets at once, and pieces that it keeps the ids of.  Encoding and
#: decoding are two workers a core when one follows the other, and both stay.
ROWS, PIECES = 256, 100_000


@functools.lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@functools.lru_cache(maxsize=2)
def _ids(path: str) -> Cache:
    """Piece of text -> its ids as little-endian 32-bit integers."""
    import tiktoken

    core = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=_ranks(path),
                             special_tokens={})._core_bpe

    def make(piece: str) -> bytes:
        return np.asarray(core.encode_single_piece(piece.encode()), dtype="<u4").tobytes()

    return Cache(make, PIECES)


@functools.lru_cache(maxsize=2)
def _bytes(path: str) -> list[bytes]:
    ranks = _ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        table[rank] = piece
    return table


def split_chunks(text: str, split: ByteLevel, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> tuple[list[str], int]:
    """Pre-tokens of ``text``, and from how many overlapping chunks they were
    stitched (1: split in one piece)."""
    size = len(text)
    if size <= chunk:
        return split.split(text), 1
    out, count, begin = [], 1, 0
    pieces = split.split(text[:chunk + overlap])
    for start in range(chunk, size, chunk):
        after = split.split(text[start:start + chunk + overlap])
        ends = list(itertools.accumulate(map(len, pieces), initial=begin))
        heads = list(itertools.accumulate(map(len, after), initial=start))
        sure = size if start + overlap >= size else start + overlap - MARGIN
        i, j = bisect.bisect_left(ends, start), 0
        while i < len(ends) and j < len(heads) and ends[i] != heads[j]:
            if ends[i] < heads[j]:
                i += 1
            else:
                j += 1
        if i == len(ends) or j == len(heads) or ends[i] > sure:
            return split.split(text), 1
        out += pieces[:i]
        pieces, begin, count = after[j:], heads[j], count + 1
    return out + pieces, count


def encode_text(text: str, path: str, split: ByteLevel, chunk: int = CHUNK,
                overlap: int = OVERLAP) -> tuple[bytes, int]:
    """Ids of a text, and the number of chunks it was stitched from."""
    pieces, count = split_chunks(text, split, chunk, overlap)
    return b"".join(map(_ids(path).__getitem__, pieces)), count


def decode_ids(ids: bytes, path: str) -> bytes:
    return b"".join(map(_bytes(path).__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _whole(path: str, split: ByteLevel, inner: tuple[int, int]):
    """Batches (text, row, ids or null, chunks) -> (row, ids, chunks); ids that
    are there already stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, text=0):
            got = [(ids, n) if ids is not None else encode_text(t, path, split, *inner) for t, ids, n in
                   zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([g[0] for g in got], pa.binary()),
                 pa.array([g[1] for g in got], pa.int32())], names=["row", "ids", "chunks"])

    return run


def _ends(text: str, split: ByteLevel, start: int = 0) -> list[int]:
    """Boundaries of the split from ``start`` on, the start included."""
    return [start, *(m.end() for m in split.pattern(text).finditer(text, start))]


def _chunks(path: str, split: ByteLevel, chunk: int, overlap: int):
    """Encode chunk rows (part, sha, n, last): ids up to where the next chunk
    takes over, and the boundaries at which this one may take over itself."""

    def one(part: str, last: bool):
        ends = _ends(part, split)
        sync = len(part)
        if not last:
            sure = len(part) - MARGIN
            fresh = set(_ends(part, split, chunk))
            sync = next((e for e in ends if chunk <= e <= sure and e in fresh), None)
            if sync is None:
                return None, None, [], []
        cache, ids, at = _ids(path), [], 0
        heads, head_at = [0], [0]
        for begin, end in zip(ends, ends[1:]):
            if end > sync:
                break
            ids.append(cache[part[begin:end]])
            at += len(ids[-1])
            if end <= overlap:
                heads.append(end)
                head_at.append(at)
        return b"".join(ids), sync - chunk, heads, head_at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, rows=16, text=0):
            got = [one(*x) for x in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), batch.column(3),
                 pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.int32()),
                 pa.array([g[2] for g in got], pa.list_(pa.int32())),
                 pa.array([g[3] for g in got], pa.list_(pa.int32()))],
                names=["sha", "n", "last", "ids", "sync", "heads", "head_at"])

    return run


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sha, chunks in order) -> (sha, ids, number of chunks); null ids where
    two chunks share no boundary."""
    for batch in batches:
        out, counts = [], []
        for chunks in batch.column(1).to_pylist():
            counts.append(len(chunks))
            parts, took = [], 0
            for c in chunks:
                if c["ids"] is None or took not in c["heads"]:
                    parts = None
                    break
                parts.append(c["ids"][c["head_at"][c["heads"].index(took)]:])
                took = c["sync"]
            out.append(None if parts is None else b"".join(parts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out, pa.binary()), pa.array(counts, pa.int32())],
            names=["sha", "ids", "chunks"])


def encode(docs: DataFrame, path: str, text_col: str = "text", chunk: int = 1 << 16,
           overlap: int = 1 << 10, inner: tuple[int, int] = (CHUNK, OVERLAP),
           chunks_col: str | None = None) -> DataFrame:
    """``docs`` (every row and column) with ``ids``: the text's token ids as
    little-endian 32-bit integers, by the ranks in the file at ``path``; each
    match of the split pattern is encoded by itself, special strings are text.
    With ``chunks_col``, also the number of overlapping chunks that the text was
    stitched from (1: it was split in one piece).

    A null or empty text has empty ids.  A text is split in overlapping chunks of
    ``inner`` (characters, overlap) within its batch; texts longer than ``chunk``
    characters go to several tasks in chunks of that size, each distinct text once
    however many rows have it.  An empty table gives an empty result.  Columns of
    ``docs`` named ``ids`` or ``chunks_col`` are replaced.
    """
    small_batches(docs.sparkSession, ROWS)
    split, text = ByteLevel(), text_of(text_col)
    names = [c for c in docs.columns if c not in ("ids", chunks_col)]
    kept = F.struct(*[column(c) for c in names]).alias("row")
    long = F.char_length(text) > chunk

    def encoded(rows: DataFrame) -> DataFrame:
        schema = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType()),
                               T.StructField("chunks", T.IntegerType())])
        return rows.mapInArrow(_whole(path, split, inner), schema)

    short = encoded(docs.where(~long).select(
        text.alias("__text"), kept, F.lit(None).cast("binary").alias("ids"), F.lit(1).alias("chunks")))
    long_docs = docs.where(long).select(F.sha2(text, 256).alias("sha"), text.alias("__text"), kept)
    count = F.ceil(F.char_length("__text") / F.lit(chunk)).cast("int")
    parts = (long_docs.select("sha", "__text", count.alias("count"),
                              F.explode(F.sequence(F.lit(0), count - 1)).alias("n"))
             .select(F.expr(f"substring(__text, n * {chunk} + 1, {chunk + overlap})").alias("part"),
                     "sha", "n", (F.col("n") == F.col("count") - 1).alias("last"))
             .dropDuplicates(["sha", "n"]))
    done = parts.mapInArrow(
        _chunks(path, split, chunk, overlap),
        "sha string, n int, last boolean, ids binary, sync int, heads array<int>, head_at array<int>")
    gathered = done.groupBy("sha").agg(
        F.sort_array(F.collect_list(F.struct("n", "ids", "sync", "heads", "head_at"))).alias("chunks"))
    stitched = gathered.mapInArrow(_stitched, "sha string, ids binary, chunks int")
    # texts whose chunks share no boundary have null ids yet
    rest = encoded(long_docs.join(stitched, "sha").select("__text", "row", "ids", "chunks"))
    extra = [F.col("chunks").alias(chunks_col)] if chunks_col else []
    return short.unionByName(rest).select("row.*", "ids", *extra)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with ``out``: the raw bytes of the tokens, joined.  Null ids
    decode to nothing.  A column named ``out`` is replaced."""
    small_batches(rows.sparkSession, ROWS)
    names = [c for c in rows.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, text=0):
            texts = [decode_ids(x or b"", path) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(texts, pa.binary())],
                                             names=["row", "decoded"])

    packed = rows.select(column(ids_col).alias("__ids"), F.struct(*[column(c) for c in names]).alias("row"))
    schema = T.StructType([packed.schema["row"], T.StructField("decoded", T.BinaryType())])
    return packed.mapInArrow(run, schema).select("row.*", F.col("decoded").alias(out))
