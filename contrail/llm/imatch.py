"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency ``ln(N / df)`` lies in
a band: neither words that most documents share nor words that hardly any other
has.  A term with a share ``s`` of the documents can only be one of (mean distinct
terms a document) / s, whatever the number of documents, so the lexicon stays
small; its size is measured before it is broadcast.  A document's fingerprint has
one signature for each of several random subsets of the lexicon: the hash of its
sorted distinct terms in that subset.  Subsets come in several sizes, so that
short and long documents both have subsets with a handful of their terms.  The
last signature is that of all its distinct terms, of the lexicon or not.

A text that very many documents are near copies of lifts its own terms over the band.
So a text with more terms above the band than places in the subsets has its blank
signatures filled: with the hash of its terms above the band that are in the subset.

All of it is DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import BROADCAST_BYTES, column, shuffle_width, stored, text_of

#: Subsets hold one lexicon term in 2**bits: so many subsets for each size.
SIZES = (4, 6, 8, 10)
EACH = 16
SUBSETS = EACH * len(SIZES)

#: Hex digits of a signature; a subset without a term has a blank one.
DIGITS = 8
BLANK = "-" * DIGITS


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-cased runs of letters and digits."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def _drawn(subset: Column, term: Column) -> Column:
    """The term is in the subset."""
    size = F.element_at(F.array(*[F.lit(1 << b) for b in SIZES]), F.floor(subset / EACH).cast("int") + 1)
    return F.pmod(F.xxhash64(subset, term), size) == 0


def lexicon(docs: DataFrame, text_col: str = "text",
            band: tuple[float, float] = (2.0, 7.0)) -> DataFrame:
    """(``term``, ``subset``) for the terms in the band and each of their subsets, and
    with a null ``subset`` those that stand in more documents than the band allows."""
    n = docs.count()
    counts = docs.select(F.explode(terms(text_of(text_col))).alias("term")).groupBy("term") \
        .agg(F.count("*").alias("df"))
    kept = counts.where(F.col("df") >= n * math.exp(-band[1]))
    drawn = F.filter(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda k: _drawn(k, F.col("term")))
    none = F.array(F.lit(None).cast("int"))
    return stored(kept.select("term", F.explode(
        F.when(F.col("df") <= n * math.exp(-band[0]), drawn).otherwise(none)).alias("subset")))


def _hex(value: Column) -> Column:
    return F.lower(F.right(F.lpad(F.hex(value), 16, "0"), F.lit(DIGITS)))


def signatures(rows: DataFrame, keys: list[str], texts: list[str], words: DataFrame) -> DataFrame:
    """For each row that has lexicon terms: ``keys``, ``which`` (index of the text),
    ``signed``, a map from subset to signature, and ``places``, how many its terms
    take in the subsets.  Rows with equal keys must be in one partition for this to
    need no shuffle."""
    each = rows.select(*keys, F.posexplode(F.array(*[terms(F.col(t)) for t in texts])).alias("which", "terms"))
    each = each.select(*keys, "which", F.explode("terms").alias("term"))
    held = words.count() * 24
    found = each.join(F.broadcast(words) if held <= BROADCAST_BYTES else words, "term")
    signed = found.groupBy(*keys, "which", "subset").agg(
        _hex(F.xxhash64(F.sort_array(F.collect_list("term")))).alias("signature"), F.count("*").alias("places"))
    return signed.groupBy(*keys, "which").agg(
        F.map_from_entries(F.collect_list(F.struct("subset", "signature"))).alias("signed"),
        F.sum("places").alias("places"))


def whole(found: Column) -> Column:
    """Signature of all distinct terms."""
    return _hex(F.xxhash64(F.array_sort(found)))


def fingerprint(signed: Column, places: Column, common: Column, all_terms: Column) -> Column:
    """The signatures by subset and that of all terms.  A subset without a term is
    blank, or has the signature of the ``common`` terms in it where these outnumber
    the text's ``places``."""
    def filled(k: Column) -> Column:
        drawn = F.filter(common, lambda x: _drawn(k, x))
        return F.when(F.size(drawn) > 0, _hex(F.xxhash64(F.array_sort(drawn))))

    one = F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda k: F.coalesce(
        F.try_element_at(signed, k), F.when(F.size(common) > places, filled(k)), F.lit(BLANK)))
    return F.concat_ws("", F.array_append(one, all_terms))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures among those that either fingerprint has."""
    spots = F.transform(F.sequence(F.lit(0), F.lit(SUBSETS)), lambda k: k * DIGITS + 1)
    pairs = F.transform(spots, lambda k: F.struct(
        a.substr(k, F.lit(DIGITS)).alias("a"), b.substr(k, F.lit(DIGITS)).alias("b")))
    told = F.filter(pairs, lambda p: (p["a"] != BLANK) | (p["b"] != BLANK))
    return F.size(F.filter(told, lambda p: p["a"] == p["b"])) / F.size(told)


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with the text that follows it in descending order of id, the first
    row's after the last: ``part``, ``row`` (its place), ``doc_id``, ``text``, ``next``.

    Null ids come last, rows with the same id are ordered by text.  Ranges of ids
    are cut at quantiles found first, so every use of the result agrees; a row's
    text moves once, to its range.
    """
    width, last = 4 * shuffle_width(docs.sparkSession), (1 << 63) - 1
    # ids in descending order; null as the last value, which no id takes
    rows = docs.select(F.bitwise_not(F.coalesce(column(id_col).cast("long"), F.lit(-last - 1))).alias("turned"),
                       text_of(text_col).alias("text"))
    spot = F.col("turned").cast("double")
    cuts = rows.select(spot.alias("spot")).approxQuantile(
        "spot", [k / width for k in range(1, width)], 0.25 / width)
    splits = [-math.inf, *sorted(set(cuts) or {0.0}), math.inf]
    parts = Bucketizer(splits=splits, inputCol="spot", outputCol="bucket").transform(
        rows.withColumn("spot", spot)).select("turned", "text", F.col("bucket").cast("int").alias("part"))

    # one row a range: its first id, and the number of the range that follows
    heads = stored(parts.groupBy("part").agg(F.min("turned").alias("turned")))
    all_parts = Window.orderBy("part")
    follow = heads.select("part", F.coalesce(
        F.lead("part").over(all_parts), F.min("part").over(all_parts.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    firsts = parts.join(F.broadcast(heads), ["part", "turned"]).groupBy("part").agg(F.min("text").alias("edge"))
    edge = follow.join(firsts.withColumnRenamed("part", "after"), "after").select("part", "edge")

    order = Window.partitionBy("part").orderBy("turned", "text")
    placed = parts.withColumn("row", F.row_number().over(order)).withColumn("lead", F.lead("text").over(order))
    return placed.join(edge, "part").select(
        "part", "row", F.when(F.col("turned") != last, F.bitwise_not("turned")).alias("doc_id"),
        "text", F.coalesce("lead", "edge").alias("next"))


def edited(text: Column, after: Column) -> Column:
    """``text`` whose last half is replaced by as much of the start of ``after``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(after, half))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      band: tuple[float, float] = (2.0, 7.0)) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``: the
    likeness (0 to 1) to the edited text's and to the next document's fingerprint.

    A null text counts as empty.  Equal texts have equal fingerprints; texts
    without any term have that of no term.  A table of one row is its own next.
    An empty table gives an empty result.
    """
    every = lexicon(docs, text_col, band)
    words, above = every.where("subset IS NOT NULL"), every.where("subset IS NULL")
    rows = followed(docs, id_col, text_col).withColumn("edited", edited(F.col("text"), F.col("next")))
    keys, texts = ["part", "row"], ["text", "edited", "next"]
    signed = signatures(rows, keys, texts, words)
    signed = signed.groupBy(*keys).agg(F.map_from_entries(
        F.collect_list(F.struct("which", F.struct("signed", "places")))).alias("signed"))
    # one row, of at most e**band[0] times a text's mean number of distinct terms
    above = above.agg(F.collect_list("term").alias("above"))
    narrow = rows.select(
        *keys, "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), *[terms(F.col(t)).alias(f"terms_{t}") for t in texts])
    narrow = narrow.crossJoin(F.broadcast(above)).select(
        *keys, "doc_id", "n_chars", "edited_sha256", *[whole(F.col(f"terms_{t}")).alias(f"all_{t}") for t in texts],
        *[F.array_intersect(f"terms_{t}", "above").alias(f"common_{t}") for t in texts])
    none = F.create_map().cast("map<int,string>")
    mine = [F.try_element_at("signed", F.lit(k)) for k in range(len(texts))]
    prints = narrow.join(signed, keys, "left").select("*", *[
        fingerprint(F.coalesce(m["signed"], none), F.coalesce(m["places"], F.lit(0)), F.col(f"common_{t}"),
                    F.col(f"all_{t}")).alias(f"print_{t}")
        for m, t in zip(mine, texts)])
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", F.col("print_text").alias("fingerprint"),
        F.col("print_edited").alias("edited_fingerprint"),
        likeness(F.col("print_text"), F.col("print_edited")).alias("near_edited"),
        likeness(F.col("print_text"), F.col("print_next")).alias("near_next"))
