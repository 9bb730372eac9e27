"""Mixing sources to target weights by capped water-filling.

Targets: sources share the budget by weight; a source whose share exceeds its
maximum (epochs times its size) is clamped there and its excess is shared again
by weight, until no source is above.  Each round is one aggregate over the
per-source table; two numbers a round reach the driver.

Taking: a source's target is so many whole repetitions of all its documents
plus a fractional one.  Whole repetitions take every document; the fractional
one takes documents in the order of a seeded hash until the rest is used up.
The cut is found from totals per (source, hash range), so only the documents of
the one range in which a source's cut falls are ever ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import BROADCAST_BYTES, WORD_SPACE, column, global_offsets, shuffle_width, stored, text_of


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than blank and \\t..\\r."""
    return F.regexp_count(text, F.lit(f"[^{WORD_SPACE}]+")).cast("long")


def ranked(values: DataFrame, name: str, out: str) -> DataFrame:
    """``values`` (distinct rows) with their rank from 0 in ascending order of
    ``name``, nulls last, counted range by range."""
    width = shuffle_width(values.sparkSession)
    order = F.col(name).asc_nulls_last()
    parts = stored(values.repartitionByRange(width, order)
                   .withColumn("part", F.spark_partition_id()))
    within = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    counts = global_offsets(parts.groupBy("part").agg(F.count("*").alias("n")), "part", "n", "before")
    return (parts.withColumn("within", within).join(counts.drop("n"), "part")
            .withColumn(out, F.col("before") + F.col("within")).drop("part", "within", "before"))


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """``sources`` (columns ``source_size`` and ``weight``) with ``target``.

    A source of size 0 gets target 0.  Without any positive weight all targets
    are 0.  If the budget exceeds all maxima, every source is at its maximum.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    state = stored(sources.withColumn("clamped", F.lit(False)))
    while True:
        used, weights = state.agg(
            F.sum(F.when(F.col("clamped"), cap)), F.sum(F.when(~F.col("clamped"), F.col("weight")))
        ).first()
        level = max(0.0, budget - (used or 0.0)) / weights if weights else 0.0
        share = F.col("weight") * F.lit(level)
        over = ~F.col("clamped") & (share > cap)
        if not weights or not state.where(over).limit(1).count():
            return state.withColumn("target", F.when(F.col("clamped"), cap).otherwise(share)) \
                        .drop("clamped")
        state = stored(state.withColumn("clamped", F.col("clamped") | over))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2),
        share: float = 1.5, max_epochs: float = 2.0, seed: int = 17,
        ranges: int = 4096, partial: bool = True, carry: bool = False) -> DataFrame:
    """One row per input row: ``doc_id``, ``source``, ``size`` (words),
    ``source_size``, ``target`` (its source's, in words), ``taken`` (words,
    repetitions counted); with ``carry`` also ``times`` (whole documents taken) and
    ``row``, a struct of all columns.

    Sources in code-point order, null last, take ``weights`` in turn and share
    ``share`` times all words; no target exceeds ``max_epochs`` times its source.
    With ``partial`` the fractional repetition of a source may end inside a
    document, so a source takes its target, rounded; without, that document is
    taken if at least half of it is called for.  Reruns agree: the order is a
    hash of ``seed``, id and text; rows equal in both share what is left evenly.
    Null or empty texts have size 0 and take 0 words.  An empty table gives an
    empty result.
    """
    spark, text = docs.sparkSession, text_of(text_col)
    spot = F.xxhash64(F.lit(seed), column(id_col).cast("long"), F.xxhash64(text))
    rows = docs.select(
        column(id_col).cast("long").alias("doc_id"),
        column(source_col).cast("string").alias("source"),
        word_count(text).alias("size"), spot.alias("spot"),
        F.pmod(spot, F.lit(ranges)).cast("int").alias("slot"),
        *([F.struct(*[column(c) for c in docs.columns]).alias("row")] if carry else []))
    narrow = stored(rows.drop("row"))
    rows = rows if carry else narrow

    count = narrow.count()
    slots = stored(narrow.groupBy("source", "slot").agg(F.sum("size").alias("slot_size")), count)
    sources = slots.groupBy("source").agg(F.sum("slot_size").alias("source_size"))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    turns = F.array(*[F.lit(float(w)) for w in weights])
    sources = ranked(sources, "source", "rank").withColumn(
        "weight", F.element_at(turns, (F.col("rank") % len(weights) + 1).cast("int")))
    sources = water_fill(sources, float(share) * total, max_epochs)

    # whole repetitions, and the words of the fractional one
    goal = F.round(F.col("target")).cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("whole", whole.cast("long")).select(
        "source", "source_size", "target", "whole",
        (goal - F.col("whole") * F.col("source_size")).alias("rest"))
    cuts = stored(_cuts(narrow, slots, stored(sources)), count)

    # a proven size allows the broadcast; else the join shuffles, and AQE splits a hot source
    held = cuts.agg(F.sum(F.coalesce(F.octet_length("cut_source"), F.lit(0)) + 80)).first()[0] or 0
    out = rows.join(F.broadcast(cuts) if held <= BROADCAST_BYTES else cuts,
                    F.col("source").eqNullSafe(F.col("cut_source")), "left")
    at_cut = (F.col("slot") == F.col("cut_slot")) & (F.col("spot") == F.col("cut_spot"))
    before = (F.col("slot") < F.col("cut_slot")) | \
        ((F.col("slot") == F.col("cut_slot")) & (F.col("spot") < F.col("cut_spot")))
    part = F.floor(F.col("cut_words") / F.col("cut_rows")).cast("long")
    if not partial:
        part = F.when(part * 2 >= F.col("size"), F.col("size")).otherwise(0)
    extra = F.when(before, F.col("size")).when(at_cut, F.least(part, F.col("size"))).otherwise(0)
    times = (F.col("whole") + F.when(before | (at_cut & (part * 2 >= F.col("size"))), 1).otherwise(0)).cast("int")
    return out.select("doc_id", "source", "size", "source_size", "target",
                      (F.col("whole") * F.col("size") + extra).cast("long").alias("taken"),
                      *([times.alias("times"), "row"] if carry else []))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as many times as it is taken, in whole
    documents (see :func:`mix`); an empty text as often as its source is repeated."""
    taken = mix(docs, id_col, text_col, source_col, partial=False, carry=True, **options)
    return taken.where("times > 0").select(
        "row", F.explode(F.expr("sequence(1, times)"))).select("row.*")


def _cuts(rows: DataFrame, slots: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per source: its figures, the hash value at which its fractional
    repetition ends, the words left for that value and its number of rows."""
    def running(order):
        return Window.partitionBy("source").orderBy(order).rowsBetween(
            Window.unboundedPreceding, -1)

    def cut(parts: DataFrame, size: str, of: DataFrame) -> DataFrame:
        both = parts.alias("a").join(of.alias("b"), F.expr("a.source <=> b.source"))
        return both.where((F.col("before") <= F.col("rest"))
                          & (F.col("rest") < F.col("before") + F.col(size)))

    totals = slots.withColumn("before", F.coalesce(F.sum("slot_size").over(running("slot")), F.lit(0)))
    held = cut(totals, "slot_size", sources).select(
        "a.source", F.col("slot").alias("cut_slot"), (F.col("rest") - F.col("before")).alias("rest"))
    spots = (rows.alias("r").join(held.alias("h"), F.expr("r.source <=> h.source and slot = cut_slot"))
             .groupBy("r.source", "spot", "cut_slot")
             .agg(F.sum("size").alias("spot_size"), F.count("*").alias("cut_rows")))
    spots = spots.withColumn("before", F.coalesce(F.sum("spot_size").over(running("spot")), F.lit(0)))
    found = cut(spots, "spot_size", held.withColumnRenamed("cut_slot", "_slot")).select(
        "a.source", "cut_slot", F.col("spot").alias("cut_spot"),
        (F.col("rest") - F.col("before")).alias("cut_words"), "cut_rows")
    return sources.alias("b").join(found.alias("c"), F.expr("b.source <=> c.source"), "left").select(
        F.col("b.source").alias("cut_source"), "source_size", "target", "whole",
        "cut_slot", "cut_spot", "cut_words", "cut_rows")
