"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints within ``distance`` bits share at least two of ``distance + 2`` bands
of the 64 bits, so each distinct fingerprint is keyed by every pair of bands, and
only fingerprints with a common key are compared.  A task holds the fingerprints
of its keys as vertical bit planes: one machine word carries one bit of 64
fingerprints.  It compares a block with shifted copies of itself; the distances
of all lanes grow together in carry-save counters made of words, and a block is
abandoned as soon as every lane has passed the distance.  A key with more
fingerprints than a block is cut into parts, and each pair of parts is a task
of its own.  A task reports links that span what it found, not all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import (
    column, pieces_of, rows_of, shuffle_width, small_batches, stored, text_of,
)
from contrail.llm.components import components

#: Hashes counted at once, so a long text needs no more memory than this many.
HASHES = 1 << 16


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """SimHash of a text: bit set where over half the shingles' hashes have it."""
    from xxhash import xxh64_intdigest

    parts = text.encode().lower().split()  # bytes: lower-cases A-Z, splits at blank and \t..\r
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    ends = ends[words - 1:] if len(parts) >= words else ends[-1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, n, HASHES):
        some = [xxh64_intdigest(joined[a:b], seed)
                for a, b in zip(starts[at:min(n, at + HASHES)].tolist(), ends[at:at + HASHES].tolist())]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(sum(1 << k for k in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, text=1):
            found = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]],
                names=["doc_id", "fp", *carry])

    rows = docs.select(column(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"),
                       *[column(c) for c in carry])
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()),
                         *[rows.schema[c] for c in carry]])
    return rows.mapInArrow(run, kind)


# ---- bit-sliced comparison ----

def planes_of(fps: np.ndarray) -> np.ndarray:
    """64 planes of words: bit ``k`` of word ``w`` belongs to fingerprint ``k * W + w``."""
    width = -(-len(fps) // 64)
    lanes = np.zeros(64 * width, np.uint64)
    lanes[:len(fps)] = fps
    bits = np.unpackbits(lanes.view(np.uint8), bitorder="little").reshape(64, width, 64)
    # [lane bit, word, plane] -> [plane, word, lane bit]
    packed = np.packbits(np.ascontiguousarray(bits.transpose(2, 1, 0)), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64).reshape(64, width)


def within(fps: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs ``i < j`` of fingerprints in the same group that differ in at
    most ``distance`` bits; each group's rows are adjacent."""
    n = len(fps)
    _, sizes = np.unique(group, return_counts=True)
    reach = int(sizes.max(initial=0)) - 1
    if reach < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    planes = planes_of(fps)
    width = planes.shape[1]
    kept = max(1, distance.bit_length())
    start = (1 << kept) - 1 - distance  # so that the carry out of the top bit means "too far"
    lane = np.arange(64 * width).reshape(64, width)
    firsts, seconds = [], []
    # word w + q * W of this is word w with its lanes moved by q: fingerprint i + shift
    # lies in the word that is shift further on
    ahead = np.concatenate([planes >> np.uint64(q) for q in range(reach // width + 2)], axis=1)
    for low in range(1, reach + 1, max(1, (1 << 16) // width)):
        shifts = np.arange(low, min(reach + 1, low + max(1, (1 << 16) // width)))
        alike = np.zeros((len(shifts), width), np.uint64)
        for row, shift in enumerate(shifts):
            ok = np.zeros(64 * width, bool)
            ok[:n - shift] = group[shift:] == group[:n - shift]
            alike[row] = np.packbits(np.ascontiguousarray(ok.reshape(64, width).T), axis=1,
                                     bitorder="little").view(np.uint64).reshape(width)
        # a block is a word, 64 pairs; only live blocks are counted on
        rows, words = np.nonzero(alike)
        far, spots = ~alike[rows, words], shifts[rows] + words
        counters = [np.full_like(far, ~np.uint64(0)) if start >> k & 1 else np.zeros_like(far)
                    for k in range(kept)]
        for plane in range(64):
            carry = ahead[plane][spots] ^ planes[plane][words]
            for k in range(kept):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            far |= carry
            if plane % 8 == 7:  # blocks with no pair left within reach are abandoned
                live = np.flatnonzero(~far)
                rows, words, spots, far = rows[live], words[live], spots[live], far[live]
                counters = [c[live] for c in counters]
                if not len(live):
                    break
        bits = np.unpackbits((~far).view(np.uint8), bitorder="little").reshape(-1, 64)
        which, bit = np.nonzero(bits)
        i = lane[bit, words[which]]
        firsts.append(i)
        seconds.append(i + shifts[rows[which]])
    if not firsts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(firsts), np.concatenate(seconds)


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` items the smallest index it is linked to, through others too."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _links(distance: int, block: int):
    """Rows (fp, mask, key) sorted by mask and key -> spanning links (u, v)."""

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for name in ("mask", "key"):
            col = table[name].to_numpy()
            new[1:] |= col[1:] != col[:-1]
        return new

    def compare(table: pa.Table) -> pa.RecordBatch:
        fps = table["fp"].to_numpy().view(np.uint64)
        group = np.cumsum(starts(table))
        i, j = within(fps, group, distance)
        label = spanning(len(fps), i, j)
        linked = np.flatnonzero(label != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays(
            [pa.array(fps[linked].view(np.int64)), pa.array(fps[label[linked]].view(np.int64))],
            names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < block:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            cuts = np.flatnonzero(starts(table))
            if len(cuts):  # the last group may go on
                cut = int(cuts[-1])
                yield compare(table.slice(0, cut))
                held, rows = table.slice(cut).to_batches(), rows - cut
        if rows:
            yield compare(pa.Table.from_batches(held).combine_chunks())

    return run


def band_masks(distance: int, given: int = 0) -> list[int]:
    """The bits outside ``given`` in ``distance + 2`` bands; ``given`` with each two of
    them.  Fingerprints within ``distance`` that agree in ``given`` agree in one of these."""
    free = [b for b in range(64) if not given >> b & 1]
    count = distance + 2
    bands = [sum(1 << b for b in free[len(free) * k // count:len(free) * (k + 1) // count]) for k in range(count)]
    masks = sorted({given & ((1 << 64) - 1) | x | y for x, y in itertools.combinations(bands, 2)})
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def keyed(distinct: DataFrame, distance: int = 3, part: int = 2048,
          most: int | None = None) -> DataFrame:
    """Groups (``mask``, ``key``) of fingerprints ``fp``: two within ``distance`` meet in
    one at least.

    A group of more than ``part`` is parted again by the bits outside its key: the same
    bands, two at a time, of what is left.  Its rows are copied to some ten smaller
    groups, not to a part for each other part.  Every round fixes two fifths of the
    bits left (for a distance of 3), so four rounds leave groups of ``part`` at most: a
    key that leaves r bits open holds 2^r different fingerprints.

    There are no more than ``most`` fingerprints, where that is known.
    """
    spark, masks, out = distinct.sparkSession, band_masks(distance), None
    rows = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
    while True:
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        counts = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        most = most and most * len(masks)  # a row goes to a group for each mask
        sized = stored(rows.join(counts, ["mask", "key"]).select("fp", "mask", "key", "n"), most)
        hot = (F.col("n") > part) & (64 - F.bit_count("mask") > distance + 2)
        done = sized.where(~hot).select("fp", "mask", "key")
        out = done if out is None else out.unionByName(done)
        found = sorted(r.mask for r in sized.where(hot).select("mask").distinct().collect())  # at most 10, 100, 1000
        if not found:
            return out
        finer = spark.createDataFrame([(m, x) for m in found for x in band_masks(distance, m)], "mask long, finer long")
        rows = sized.where(hot).join(F.broadcast(finer), "mask").select("fp", F.col("finer").alias("mask")).distinct()


def links(distinct: DataFrame, distance: int = 3, part: int = 2048,
          most: int | None = None) -> DataFrame:
    """Links (``u``, ``v``) that connect all fingerprints ``fp`` of ``distinct``
    within ``distance`` bits of one another; of at most ``most`` fingerprints."""
    keys = ["mask", "key"]
    dealt = keyed(distinct, distance, part, most).repartition(shuffle_width(distinct.sparkSession), *keys) \
        .sortWithinPartitions(*keys, "fp")
    return dealt.mapInArrow(_links(distance, 4 * part), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 3, distance: int = 3) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (16 lowercase hex
    digits), ``component_id`` (the smallest id reachable over fingerprints within
    ``distance`` bits, its own included).

    Texts are lower-cased in A-Z and cut into words at blank and \\t..\\r; fewer
    than ``words`` words make one shingle, none (or null) fingerprint zero, which
    links like any other.  Null ids keep their row and never name a component
    unless all of its ids are null.  An empty table gives an empty result.
    """
    rows = stored(fingerprints(docs, id_col, text_col, words))
    return linked(rows, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def linked(rows: DataFrame, distance: int = 3) -> DataFrame:
    """``rows`` (with ``doc_id`` and ``fp``) with ``component_id``."""
    least = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), rows.count())
    count = least.count()
    roots = components(links(least.select("fp"), distance, most=count), "u", "v",
                       count * len(band_masks(distance)))
    named = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(names, "root").select("fp", "root", "component_id"), "fp")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each component of :func:`near_duplicates`
    the one with the smallest id (null last; of equal ids the smallest text digest)."""
    text = text_of(text_col)
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.sha2(text, 256).alias("sha"))
    found = linked(stored(fingerprints(rows, words=words, carry=("sha",))), distance)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha"))
    return rows_of(docs, found.groupBy("root").agg(least.alias("least")).select(
        "least.doc_id", "least.sha"), id_col, text_col)
