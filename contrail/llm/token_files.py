"""Token ids in shards, each one wavelet matrix in a compressed file.

Documents are range-partitioned by id and sorted, so each task writes the shards
of one range, in order; encoding happens after that one shuffle, where the shard
is made, so ids never shuffle.  A shard is a row of a Parquet table: the wavelet
matrix (token access, counting, occurrence look-up), the documents' ids and the
numbers of their tokens.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import (
    BROADCAST_BYTES, column, global_offsets, pieces_of, shuffle_width, small_batches, text_of,
)
from contrail.llm.pretokens import LATIN, byte_letters, is_latin, spelled
from contrail.llm.token_counts import added_tokens, tokenizer
from contrail.llm.wavelet import PIECE, WaveletMatrix

#: The bytes of Latin-1 (texts below U+0100) as the word vocabulary's split
#: has them (0 white space, 1 letter, 2 number, 3 other), and in lower case.
KINDS = bytes(next((k for k, c in enumerate("SLN") if re.match(f"[{LATIN[c]}]", chr(b))), 3) for b in range(256))
LOWER = bytes(range(256)).decode("latin-1").lower().encode("latin-1")
SPACE = bytes(b for b in range(256) if not KINDS[b])
GAP = re.compile(b"[" + re.escape(SPACE) + b"]")
BLOCK = 4 << 20

_SHARD = ("part int, shard int, tokens long, ids array<long>, lengths array<int>, matrix binary")


def _runs(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first``, ``first + 1``, ... (``n`` places) of each row, one after another."""
    stop = np.cumsum(n)
    out = np.repeat(first - (stop - n), n)
    out += np.arange(len(out))
    return out


class WordTable:
    """Words with their ids, as Arrow and numpy arrays: a block's distinct words are
    looked up together, and only unknown ones go through ``make``.

    When it would hold more than ``limit`` words, or 64 bytes for each of as many,
    it starts afresh with those of the block at hand.
    """

    def __init__(self, make, limit: int = 600_000):
        self.make, self.limit = make, limit
        self.words = pa.array([], pa.binary())
        self.first, self.n = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, "<u4")

    def look_up(self, asked: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each of ``asked`` (distinct) begin in ``pool``, and how many they are."""
        at = pc.index_in(asked, value_set=self.words)
        at, new = at.fill_null(-1).to_numpy(), asked.filter(at.is_null())
        made = [self.make(word) for word in new.to_pylist()]
        n = np.fromiter(map(len, made), np.int64, len(made))
        first = len(self.pool) + np.cumsum(n) - n
        at = at.astype(np.int64)
        at[at < 0] = len(self.words) + np.arange(len(new))
        words = pa.concat_arrays([self.words, new])
        self.first, self.n = np.concatenate((self.first, first)), np.concatenate((self.n, n))
        self.pool = np.concatenate((self.pool, np.fromiter(itertools.chain.from_iterable(made), "<u4", int(n.sum()))))
        if len(words) > self.limit or words.nbytes > 64 * self.limit:
            words, first, self.n = asked, self.first[at], self.n[at]
            self.pool = self.pool[_runs(first, self.n)]
            self.first, at = np.cumsum(self.n) - self.n, np.arange(len(asked))
        self.words = words
        return self.first[at], self.n[at]


@functools.lru_cache(maxsize=2)
def _words(path: str) -> WordTable:
    model, letters = tokenizer(path).model, byte_letters()

    def ids(word: bytes) -> list[int]:
        text = word.decode("latin-1")
        if not (text.isascii() and text.isprintable()):  # these letters stand for themselves
            text = spelled(text, letters)
        return [t.id for t in model.tokenize(text)]

    return WordTable(ids)


def split_words(text: bytes) -> tuple[np.ndarray, pa.Array]:
    """The words of a Latin-1 ``text`` in lower case: where they begin, and the words.

    ``'s|'t|'re|'ve|'m|'ll|'d|[letters]+|[number]|[others]+``, white space left out: a word
    begins where the kind changes and at every number.  A quote that begins a word and
    is followed by one of those endings is one word with it.
    """
    lower = text.translate(LOWER)
    byte, kind = np.frombuffer(lower, np.uint8), np.frombuffer(lower.translate(KINDS), np.uint8)
    begins = kind == 2
    begins[1:] |= kind[1:] != kind[:-1]
    begins[:1] = True
    begins &= kind != 0
    quotes = np.flatnonzero(begins & (byte == ord("'")))
    if len(quotes):
        then = np.concatenate((byte, np.zeros(2, np.uint8)))
        then, after = then[quotes + 1], then[quotes + 2]
        one = np.isin(then, np.frombuffer(b"stmd", np.uint8))
        two = np.isin(then, np.frombuffer(b"rv", np.uint8)) & (after == ord("e")) | (then == ord("l")) & (after == ord("l"))
        begins[quotes[one | two] + 1] = False
        stops = np.concatenate((quotes[one] + 2, quotes[two] + 3))
        stops = stops[stops < len(byte)]
        begins[stops] = kind[stops] != 0
    tight = lower.translate(None, SPACE)
    marks = (begins.view(np.uint8) + (kind != 0)).tobytes().translate(None, b"\0")
    offsets = np.append(np.flatnonzero(np.frombuffer(marks, np.uint8) == 2), len(tight)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(tight)])
    return np.flatnonzero(begins), words


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as the library gives them, little-endian 32-bit integers.

    Texts below U+0100 go together, in blocks of about ``BLOCK`` bytes cut at white space;
    the library's own normalisation is needed for the others.
    """
    special, table = added_tokens(path), _words(path)
    out, plain = [b""] * len(texts), []
    for k, text in enumerate(texts):
        if not is_latin(text) or special and special.search(text):
            out[k] = np.asarray(tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        else:
            plain.append((k, text.encode("latin-1")))
    joined = b"".join([raw + b"\n" for _, raw in plain])
    ends = np.cumsum([len(raw) + 1 for _, raw in plain], dtype=np.int64)
    ids, cuts, done, at = [], [np.zeros(1, np.int64)], 0, 0
    while at < len(joined):
        gap = GAP.search(joined, at + BLOCK)
        stop = gap.end() if gap else len(joined)
        places, words = split_words(joined[at:stop])
        coded = words.dictionary_encode()
        first, n = table.look_up(coded.dictionary)
        rows = coded.indices.to_numpy()
        n = n.take(rows)
        for k in range(0, len(rows), PIECE):
            ids.append(table.pool.take(_runs(first.take(rows[k:k + PIECE]), n[k:k + PIECE])))
        before = np.concatenate((np.zeros(1, np.int64), np.cumsum(n)))
        here = ends[(ends > at) & (ends <= stop)] - at
        cuts.append(done + before[np.searchsorted(places, here)])
        done, at = done + int(before[-1]), stop
    data, cuts = b"".join([i.tobytes() for i in ids]), 4 * np.concatenate(cuts)
    for (k, _), a, b in zip(plain, cuts.tolist(), cuts[1:].tolist()):
        out[k] = data[a:b]
    return out


def write_shards(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 2, shard_tokens: int = 1 << 20) -> None:
    """Write ``docs`` to ``path`` in ascending order of id: each document's token
    ids, then ``end_id``.

    A shard closes at ``shard_tokens`` tokens; a document is never split.  A null
    or empty text is its end id alone.  Null ids come first; rows with the same
    id are ordered by text.  Other columns are not written.  An empty table writes an
    empty file set.
    """
    spark = docs.sparkSession
    small_batches(spark)
    levels = max(1, (max(tokenizer(vocabulary).get_vocab_size(with_added_tokens=True) - 1, end_id)).bit_length())

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        end = np.asarray([end_id], "<u4").tobytes()
        ids, lengths, held, size = [], [], [], 0

        def closed() -> pa.RecordBatch:
            tokens = np.frombuffer(b"".join(held), "<u4")
            matrix = WaveletMatrix.build(tokens, levels).to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                 pa.array([len(tokens)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int32())), pa.array([matrix], pa.binary())],
                names=["part", "shard", "tokens", "ids", "lengths", "matrix"])

        for batch in pieces_of(batches, rows=1000, text=1):
            for doc, data in zip(batch.column(0).to_pylist(), encode_texts(batch.column(1).to_pylist(), vocabulary)):
                data += end
                ids.append(doc)
                lengths.append(len(data) // 4)
                held.append(data)
                size += lengths[-1]
                if size >= shard_tokens:
                    yield closed()
                    number += 1
                    ids, lengths, held, size = [], [], [], 0
        if ids:
            yield closed()

    rows = docs.select(column(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    dealt = rows.repartitionByRange(shuffle_width(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(shards, _SHARD).write.option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a written file set: ``doc_id``, ``start`` (tokens of all
    documents before), ``n_tokens`` and ``tokens`` (little-endian 32-bit ids)."""
    shards = spark.read.schema(_SHARD).parquet(path)
    sizes = shards.select("part", "shard", "tokens")
    parts = global_offsets(sizes.groupBy("part").agg(F.sum("tokens").alias("n")), "part", "n", "before")
    within = F.coalesce(F.sum("tokens").over(
        Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.withColumn("within", within).join(parts, "part").select(
        "part", "shard", (F.col("before") + F.col("within")).alias("base"))
    # one row of 24 bytes a shard: broadcast while that is small, else joined by shuffle
    if sizes.count() * 24 <= BROADCAST_BYTES:
        bases = F.broadcast(bases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, shard, ids, lengths = (batch.column(k)[row].as_py() for k in range(4))
                matrix = WaveletMatrix.from_bytes(batch.column(4)[row].as_buffer())
                tokens = matrix.to_array().astype("<u4").tobytes()
                ends = np.cumsum(np.asarray(lengths, np.int64))
                starts = ends - lengths
                for k in range(0, len(ids), 2000):
                    some = slice(k, k + 2000)
                    n = len(ids[some])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * n, pa.int32()), pa.array([shard] * n, pa.int32()),
                         pa.array(ids[some], pa.int64()), pa.array(starts[some]),
                         pa.array(lengths[some], pa.int64()),
                         pa.array([tokens[4 * a:4 * b] for a, b in zip(starts[some], ends[some])],
                                  pa.binary())],
                        names=["part", "shard", "doc_id", "offset", "n_tokens", "tokens"])

    docs = shards.select("part", "shard", "ids", "lengths", "matrix").mapInArrow(
        run, "part int, shard int, doc_id long, offset long, n_tokens long, tokens binary")
    return docs.join(bases, ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "tokens")


# ---- look-ups in the files, by rank and select ----

def _spots(shards: DataFrame) -> DataFrame:
    """Where each document lies in its shard (``first``, ``n_tokens``); no matrix is read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, ids, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                ends = np.cumsum(np.asarray(lengths, np.int64))
                for k in range(0, len(ids), 10_000):
                    some = slice(k, k + 10_000)
                    n = len(ids[some])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * n, pa.int32()), pa.array([shard] * n, pa.int32()),
                         pa.array(ids[some], pa.int64()), pa.array(ends[some] - lengths[some]),
                         pa.array(lengths[some], pa.int64())],
                        names=["part", "shard", "doc_id", "first", "n_tokens"])

    return shards.select("part", "shard", "ids", "lengths").mapInArrow(
        run, "part int, shard int, doc_id long, first long, n_tokens long")


def tokens_at(spark: SparkSession, path: str, wanted: DataFrame, at_once: int = 4096) -> DataFrame:
    """The tokens at single places: rows of ``wanted`` (``doc_id``, ``offset`` from 0 in the
    document) with their ``token``.

    Only shards that hold wanted documents are searched, a place costs one rank a plane,
    and at most ``at_once`` places of a shard are searched together.  A place beyond its
    document, null, or of an unknown id gives no row; of documents with the same id each
    gives one; repeated rows of ``wanted`` stay.  Its other columns are not returned.
    """
    shards = spark.read.schema(_SHARD).parquet(path)
    asked = wanted.select(column("doc_id").cast("long").alias("asked"), column("offset").cast("long").alias("offset"))
    places = _spots(shards).join(asked, F.col("doc_id").eqNullSafe(F.col("asked"))) \
        .where("offset >= 0 AND offset < n_tokens").select(
            "part", "shard", "doc_id", "offset", (F.col("first") + F.col("offset")).alias("place"))
    number = F.row_number().over(Window.partitionBy("part", "shard").orderBy("place"))
    lots = places.withColumn("lot", F.floor((number - 1) / at_once)).groupBy("part", "shard", "lot").agg(
        F.collect_list(F.struct("doc_id", "offset", "place")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column(1)[row].as_buffer())
                found = batch.column(0)[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p["doc_id"] for p in found], pa.int64()),
                     pa.array([p["offset"] for p in found], pa.int64()),
                     pa.array([matrix.access(p["place"]) for p in found], pa.int64())],
                    names=["doc_id", "offset", "token"])

    return lots.join(shards.select("part", "shard", "matrix"), ["part", "shard"]).select("places", "matrix") \
        .mapInArrow(run, "doc_id long, offset long, token long")


def count_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """How often each of ``tokens`` occurs in the file set (``token``, ``n``), by two ranks
    a plane and shard.  A token asked for twice is counted once; one that does not occur
    has 0, in an empty file set too."""
    asked = sorted(set(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column(0)[row].as_buffer())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked, pa.int64()), pa.array([matrix.count(t) for t in asked], pa.int64())],
                    names=["token", "n"])

    shards = spark.read.schema(_SHARD).parquet(path)
    counts = shards.select("matrix").mapInArrow(run, "token long, n long")
    none = spark.createDataFrame([(t, 0) for t in asked], "token long, n long")
    return counts.unionByName(none).groupBy("token").agg(F.sum("n").alias("n"))


def locate_tokens(spark: SparkSession, path: str, tokens: list[int], at_once: int = 10_000) -> DataFrame:
    """Every occurrence of ``tokens``: ``token``, ``doc_id``, ``offset`` in the document, by
    one select a plane; other tokens are not decoded.  A token asked for twice is
    searched once.  At most ``at_once`` occurrences leave a task at a time."""
    asked = sorted(set(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, lengths = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                matrix = WaveletMatrix.from_bytes(batch.column(2)[row].as_buffer())
                ends = np.cumsum(np.asarray(lengths, np.int64))
                for token in asked:
                    n = matrix.count(token)
                    for k in range(0, n, at_once):
                        places = np.asarray([matrix.locate(token, j) for j in range(k, min(k + at_once, n))], np.int64)
                        holders = np.searchsorted(ends, places, side="right")
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([token] * len(places), pa.int64()),
                             pa.array([ids[h] for h in holders], pa.int64()),
                             pa.array(places - ends[holders] + np.asarray(lengths, np.int64)[holders])],
                            names=["token", "doc_id", "offset"])

    shards = spark.read.schema(_SHARD).parquet(path)
    return shards.select("ids", "lengths", "matrix").mapInArrow(run, "token long, doc_id long, offset long")
