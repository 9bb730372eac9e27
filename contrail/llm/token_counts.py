"""Token counts by a map-side two-tier lookup.

Tier one: the token counts of the corpus's frequent pre-tokens.  Every task
counts its pre-tokens in a bounded summary and reports those with a notable
share; the sums over all tasks decide.  At most ``1 / share`` pre-tokens can have
that share of all occurrences, which bounds the table that is broadcast.
Tier two: a pre-token not in the table goes through a bounded cache in the Python
worker to the tokenizer's model.  Documents and their pre-tokens never shuffle;
only the tasks' bounded summaries do.
"""

from __future__ import annotations

import functools
import json
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import column, pieces_of, small_batches, text_of
from contrail.llm.pretokens import ByteLevel, Cache, byte_letters, spelled


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def added_tokens(path: str) -> re.Pattern | None:
    """What the library cuts out of a text before the split pattern sees it."""
    with open(path, encoding="utf-8") as file:
        names = [t["content"] for t in json.load(file)["added_tokens"]]
    names.sort(key=len, reverse=True)
    return re.compile("|".join(map(re.escape, names))) if names else None


def count_of(path: str):
    model, letters = tokenizer(path).model, byte_letters()
    return lambda piece: len(model.tokenize(spelled(piece, letters)))


@functools.lru_cache(maxsize=1)
def _lookup(path: str, run: str) -> Cache:
    """A worker's second tier, one for each run."""
    return Cache(count_of(path))


def _segments(text: str, special: re.Pattern | None) -> tuple[list[str], int]:
    if special is None or not special.search(text):
        return [text], 0
    parts = special.split(text)
    return parts, len(parts) - 1


def _summary(path: str, split: ByteLevel, share: float):
    """A task's frequent pre-tokens, and under null the number of all of them.

    The summary holds at most ``8 / share`` pre-tokens; when full, the rare half
    goes.  One with ``share`` of a task's pre-tokens is far from that half.
    """
    room = int(8 / share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special, counts, total = added_tokens(path), Counter(), 0
        for batch in pieces_of(batches, text=0):
            for text in batch.column(0).to_pylist():
                for part in _segments(text, special)[0]:
                    found = split.split(part)
                    counts.update(found)
                    total += len(found)
            if len(counts) > room:
                counts = Counter(dict(counts.most_common(room // 2)))
        rows = [(p, n) for p, n in counts.items() if n >= share / 4 * total and len(p) <= 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in rows] + [None], pa.string()),
             pa.array([n for _, n in rows] + [total], pa.int64())], names=["piece", "n"])

    return run


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text",
                     share: float = 2.0 ** -16) -> dict[str, int]:
    """Token counts of the pre-tokens with at least ``share`` of all occurrences
    (65,536 of them at most)."""
    small_batches(docs.sparkSession)
    found = (docs.select(text_of(text_col).alias("text"))
             .mapInArrow(_summary(path, ByteLevel(), share), "piece string, n long")
             .groupBy("piece").agg(F.sum("n").alias("n")).persist())
    try:
        total = found.where("piece is null").first()
        least = (total["n"] if total else 0) * share
        pieces = [r["piece"] for r in found.where(
            F.col("piece").isNotNull() & (F.col("n") >= F.lit(float(least)))).select("piece").collect()]
    finally:
        found.unpersist()
    count = count_of(path)
    return {p: count(p) for p in sorted(pieces)}


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, share: float = 2.0 ** -16) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` as the
    tokenizers library counts them with the byte-level vocabulary at ``path``
    (special strings inside texts are its special tokens; none is added), and
    ``over_limit`` (more than ``limit`` tokens).

    A null text counts as empty: no bytes, no tokens.  Repeated rows each get
    their row.  An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    split, name = ByteLevel(), uuid.uuid4().hex
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, text_col, share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special, lookup = added_tokens(path), _lookup(path, name)
        lookup.plant(table.value)
        for batch in pieces_of(batches, text=1):
            counts = []
            for text in batch.column(1).to_pylist():
                parts, n = _segments(text, special)
                for part in parts:
                    n += sum(map(lookup.__getitem__, split.split(part)))
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    text = text_of(text_col)
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
