"""Exact deduplication by a tree-merge of sorted digest runs.

Every partition sorts the digests of its texts into a run with one row per
digest.  Partitions then exchange runs in binomial rounds: in round ``k`` a row
moves along one axis of a hypercube whose sides hold ``2**bits`` partitions -
``bits`` bits of its partition number are replaced by bits of its digest - and
the receiving partition merges the sorted runs it got into one, keeping the id
that stays, verified and counted.  After the last round a digest lies in one
partition, having met at most ``2**bits`` runs in any round, so a text that
makes up a third of all rows costs no task more than ``2**bits`` rows a round.
The decision travels back over the same edges, round by round, so no join has
a hot key either.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import column, rows_of, shuffle_width, stored, text_of

_KEY = ["sha", "check", "length"]
_RUN = "at int, sha string, check long, length long, keep long, tie long, rows long"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge a partition's sorted rows: of each verified digest the first row,
    which is the one that stays, with the number of rows it stands for."""
    held = None  # the last digest of a batch may go on in the next one
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        n = table.num_rows
        if not n:
            continue
        new = np.zeros(n, dtype=bool)
        new[0] = True
        for name in ("at", *_KEY):
            col = table[name].combine_chunks()
            if n > 1:
                new[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(new)
        rows = np.add.reduceat(table["rows"].to_numpy(), first)
        out = table.take(pa.array(first)).set_column(
            table.schema.get_field_index("rows"), "rows", pa.array(rows))
        out = pa.RecordBatch.from_arrays([c.combine_chunks() for c in out.columns],
                                         schema=batch.schema)
        held = out.slice(out.num_rows - 1)
        yield out.slice(0, out.num_rows - 1)
    if held is not None:
        yield held


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     largest: bool = False, width: int | None = None, bits: int = 4) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id`` (the smallest id of the
    rows with this text, or the largest), ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their SHA-256, their length and a second, independent
    64-bit hash agree at every merge; texts themselves never move.  A null text
    counts as empty.  Null ids lose against any other; a group with null ids
    only has a null ``keep_id`` and keeps one of its (equal) rows.  Of rows that
    repeat both id and text one is kept.  An empty table gives an empty result.
    Other columns are ignored.

    ``width`` partitions (the shuffle width, rounded up to a power of two) and
    ``bits`` per round set the number of rounds, ``log2(width) / bits``.
    """
    return decide(digests(docs, id_col, text_col), largest, width, bits)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored digest rows of ``docs``; ``at`` and ``tie`` (partition and row
    number) are fixed by storing them, however a scan is cut later."""
    text = text_of(text_col)
    return stored(docs.select(
        column(id_col).cast("long").alias("doc_id"), F.sha2(text, 256).alias("sha"),
        F.xxhash64(text).alias("check"), F.octet_length(text).cast("long").alias("length"),
        F.spark_partition_id().alias("at"), F.monotonically_increasing_id().alias("tie")))


def decide(rows: DataFrame, largest: bool = False, width: int | None = None,
           bits: int = 4) -> DataFrame:
    """The rounds up and down over the rows of :func:`digests`."""
    power = math.ceil(math.log2(max(2, width or shuffle_width(rows.sparkSession))))
    width, key = 1 << power, ["at", *_KEY]
    sides = [min(bits, power - k) for k in range(0, power, bits)]
    keep = F.col("keep").desc_nulls_last() if largest else F.col("keep").asc_nulls_last()
    names = [c.split()[0] for c in _RUN.split(", ")]

    count = rows.count()

    def merged(runs: DataFrame) -> DataFrame:
        runs = runs.sortWithinPartitions(*key, keep, "tie")
        return stored(runs.select(*names).mapInArrow(_merge, _RUN), count)

    def towards(side: int, low: int):
        """The partition that a row goes to when ``side`` bits from ``low`` on are its digest's."""
        mask = ((1 << side) - 1) << low
        digest = F.conv(F.substring("sha", 1, 8), 16, 10).cast("long").bitwiseAND(F.lit(mask))
        rest = F.pmod("at", F.lit(width)).bitwiseAND(F.lit(width - 1 - mask))
        return (rest + digest.cast("int")).cast("int")

    levels = [merged(rows.withColumnRenamed("doc_id", "keep")
                     .withColumn("rows", F.lit(1).cast("long")))]
    low = 0
    for side in sides:
        moved = levels[-1].withColumn("at", towards(side, low))
        levels.append(merged(moved.repartitionById(width, F.col("at"))))
        low += side

    # back along the same edges: each row of the level before is one
    told = levels.pop()
    for side in reversed(sides):
        low -= side
        sent = levels.pop().select(*key, towards(side, low).alias("to"))
        told = (sent.join(told.withColumnRenamed("at", "to"), ["to", *_KEY])
                .select(*key, "keep", "tie", "rows"))
    told = told.withColumnRenamed("tie", "keep_tie")
    return rows.join(told, key).select(
        "doc_id", F.col("keep").alias("keep_id"), F.col("rows").alias("group_size"),
        (F.col("tie") == F.col("keep_tie")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    largest: bool = False) -> DataFrame:
    """The rows of ``docs`` that stay: one of each text (:func:`exact_duplicates`)."""
    decided = exact_duplicates(docs, id_col, text_col, largest)
    return rows_of(docs, decided.where("kept").select("doc_id", F.col("text_sha256").alias("sha")),
                   id_col, text_col)
