"""Line deduplication by winnowing over line hashes.

A text is a sequence of units: a line that is not blank counts as one unit for each
``UNIT`` words begun, every unit carrying the hash of the whole line.  Of every
window of ``window`` units the smallest hash (the rightmost of equal ones) is its
fingerprint, so any run of that many equal units has a fingerprint in common with
its copy.  Fingerprints whose hash is selected at one place only are dropped; the
positions of the others are joined, and matches are extended on both sides of the
fingerprint: each window that selected it is identified by the hash of all its units,
and the earliest place of those units is found by an aggregate that combines
map-side.  Windows with an earlier place make up the repeated runs; their lines go.
No pairs of places are ever formed, so a line that a third of all texts have costs
no more than any other.

Repeats shorter than a window stay.  Where every repeated line is to go, however
short, :func:`drop_every_repeat` needs no windows: each line's earliest place is found
by the same kind of aggregate, and a text keeps the lines it is the earliest place of.

All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import BROADCAST_BYTES, column, stored, text_of

#: Words of a unit: with windows of three, a line of over 50 words is a run by itself.
UNIT = 25
WINDOW = 3

_PLACE = ["none", "id", "th"]


def _rows(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """The place of every row and its lines."""
    rows = docs.select(
        column(id_col).isNull().alias("none"),
        F.coalesce(column(id_col).cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(text_of(text_col)).alias("th"), text_of(text_col).alias("t"), *more)
    return rows.withColumn("lines", F.split("t", "\n", -1)).drop("t")


def _without(gone: DataFrame) -> DataFrame:
    """The result for ``doc_id``, ``lines`` and the ``deleted`` ones."""
    left = "array_except(sequence(0, size(lines) - 1), deleted)"
    return gone.select("doc_id", F.size("lines").cast("long").alias("n_lines"), "deleted",
                       F.expr(f"array_join(transform({left}, n -> lines[n]), '\n')").alias("text"))


def _lines(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """As :func:`_rows`, with the units (n: line from 0, u: hash)."""
    rows = _rows(docs, id_col, text_col, *more)
    units = rf"""flatten(transform(filter(transform(lines, (x, n) -> named_struct('n', n, 'x', x)),
            y -> y.x rlike '[^ \\t-\\r]'),
        y -> transform(sequence(1, cast(ceil(regexp_count(y.x, '[^ \\t-\\r]+') / {UNIT}) AS int)),
            j -> named_struct('n', y.n, 'u', xxhash64(y.x, j)))))"""
    return rows.withColumn("units", F.expr(units))


def _windows(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Every window: its place, start ``i``, fingerprint (hash ``h`` at unit ``p``) and
    the hash ``g`` of its units."""
    rows = _lines(docs, id_col, text_col).where(F.size("units") >= window)
    each = rows.select(*_PLACE, "units", F.posexplode(F.expr(
        f"""transform(sequence(1, size(units) - {window} + 1), i -> named_struct(
            'g', xxhash64(transform(slice(units, i, {window}), z -> z.u)),
            'a', array_min(transform(slice(units, i, {window}), (z, j) -> named_struct('u', z.u, 'p', -i - j)))))"""))
        .alias("i", "w"))
    return each.select(*_PLACE, (F.col("i") + 1).alias("i"), (-F.col("w.a.p")).alias("p"),
                       F.col("w.a.u").alias("h"), F.col("w.g").alias("g"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per place the starts of the windows whose units stand at an earlier place, as
    sorted array ``starts``.  A window that overlaps its earliest copy is none."""
    windows = _windows(docs, window, id_col, text_col)
    spot = F.struct(*_PLACE, "p")
    shared = windows.groupBy("h").agg(F.min(spot).alias("low"), F.max(spot).alias("high")) \
        .where("low != high").select("h")
    candidates = stored(windows.join(shared, "h", "left_semi"))
    here = F.struct(*_PLACE, "i")
    first = candidates.groupBy("g").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1")
    same = (F.col("first.none") == F.col("none")) & (F.col("first.id") == F.col("id")) & \
        (F.col("first.th") == F.col("th"))
    later = candidates.join(first, "g").where(~same | (F.col("i") - F.col("first.i") >= window))
    return later.groupBy(*_PLACE).agg(F.array_sort(F.collect_set("i")).alias("starts"))


def drop_repeated_lines(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_lines``, ``deleted`` (numbers of the lines
    that go, from 0, ascending) and ``text`` without them.

    A line goes if it lies in a run of at least ``window`` units that also stands at
    an earlier place - a smaller id (null last; of equal ids the smaller text hash), or
    further up in the same text, not overlapping.  At least one copy of every line
    stays, and the first ``window`` units of a run that repeats within itself.  Blank
    lines are passed over and never go.  Rows equal in id and text are one place and
    get the same result.  A null text counts as empty; an empty table gives an empty
    result; other columns are ignored.
    """
    starts = repeated_windows(docs, window, id_col, text_col)
    rows = _lines(docs, id_col, text_col, column(id_col).cast("long").alias("doc_id"))
    held = stored(starts)
    size = held.agg(F.sum(F.size("starts") * 4 + 32)).first()[0] or 0
    found = rows.join(F.broadcast(held) if size <= BROADCAST_BYTES else held, _PLACE, "left")
    covered = f"""array_distinct(transform(flatten(transform(starts, s -> sequence(s, s + {window - 1}))),
        k -> units[k - 1].n))"""
    gone = found.select("doc_id", "lines", F.expr(
        f"CASE WHEN starts IS NULL THEN cast(array() AS array<int>) ELSE array_sort({covered}) END").alias("deleted"))
    return _without(gone)


def drop_every_repeat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`drop_repeated_lines`, but every line that is not blank goes if it also
    stands at an earlier place, whatever its length and its neighbours.

    The lines of all repeated runs are among them.  What is joined to the texts are
    the lines that stay, by place, so no line's repeats ever meet in one task.
    """
    filled = F.expr("transform(lines, x -> CASE WHEN x rlike '[^ \\t-\\r]' THEN xxhash64(x) END)")
    rows = _rows(docs, id_col, text_col, column(id_col).cast("long").alias("doc_id")).withColumn("hashes", filled)
    each = _rows(docs, id_col, text_col).select(*_PLACE, F.posexplode(filled).alias("n", "h")).where("h IS NOT NULL")
    first = each.groupBy("h").agg(F.min(F.struct(*_PLACE, "n")).alias("first"))
    stay = first.groupBy(*[F.col(f"first.{c}").alias(c) for c in _PLACE]).agg(
        F.collect_list("first.n").alias("stay"))
    found = rows.join(stay, _PLACE, "left")
    numbers = "filter(sequence(0, size(lines) - 1), n -> hashes[n] IS NOT NULL)"
    return _without(found.select("doc_id", "lines", F.expr(
        f"array_except({numbers}, coalesce(stay, cast(array() AS array<int>)))").alias("deleted")))
