"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages with one label.  Every passage becomes a vector of
surface figures; a small network encodes it, gives it a gated attention weight,
and the document's score is read from the weighted passage representation:

    h = tanh(A x + a)                       passage code
    g = w . (tanh(V h) * sigmoid(U h))      gated attention, soft-maxed over the bag
    score = sigmoid(c . sum(softmax(g) h) + d)

The network is fitted on the driver from a bounded sample of labelled documents, in
the order of a hash of their id: ``sample`` documents and ``most`` passages in all.  A
document is in the sample with all its passages or not at all; scoring reads every
passage of every document.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import column, pieces_of, small_batches, stored, text_of

#: Words of a passage.
PASSAGE = 64

# Byte classes: upper case, lower case, digit, sentence marks, other marks, blank, line end, rest.
_CLASSES = 8
_CLASS = np.full(256, 7, np.uint8)
for _name, _members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz",
                                  b"0123456789", b".,;:'\"-()",
                                  b"!#$%&*+/<=>?@[\\]^_`{|}~", b" \t", b"\r\n\x0b\x0c")):
    _CLASS[np.frombuffer(_members, np.uint8)] = _name
FIGURES = _CLASSES + 7


def passages(text: str) -> np.ndarray:
    """Figures of the passages of a text, one row each; of an empty text one row
    of zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros((1, FIGURES))
    starts = range(0, n, PASSAGE)
    out = np.empty((len(starts), FIGURES))
    for row, start in enumerate(starts):
        part = words[start:start + PASSAGE]
        held = " ".join(part)
        classes = np.bincount(_CLASS[np.frombuffer(held.encode(), np.uint8)], minlength=_CLASSES)
        size, count = max(1, len(held)), len(part)
        same = sum(map(operator.eq, part, part[1:]))
        first = "".join([w[0] for w in part])
        last = "".join([w[-1] for w in part])
        out[row, :_CLASSES] = classes / (size + 40)             # a short passage says little
        out[row, _CLASSES:] = (
            len(set(part)) / count,
            same / (count + 4),                                # a short passage may repeat a word
            len(set(part)) / (count + 4) + 4 / (count + 4),
            sum(map(str.isupper, part)) / (count + 4),
            (count - sum(map(str.isalnum, last))) / (count + 4),
            (count - sum(map(str.isalnum, first))) / (count + 4),
            np.log1p(size / count),
        )
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(b) for b in bags])
        x = (np.concatenate(bags) - self.mean) / self.scale
        return _forward(self.weights, np.clip(x, -8, 8), sizes)["score"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(p: dict, x: np.ndarray, sizes: np.ndarray) -> dict:
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    bag = np.repeat(np.arange(len(sizes)), sizes)
    h = np.tanh(x @ p["A"] + p["a"])
    t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    g = (t * s) @ p["w"]
    e = np.exp(g - np.maximum.reduceat(g, starts)[bag])
    attention = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(attention[:, None] * h, starts)
    return {"h": h, "t": t, "s": s, "attention": attention, "z": z, "bag": bag, "starts": starts,
            "score": _sigmoid(z @ p["c"] + p["d"][0])}


def _gradient(p: dict, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict:
    """Slope of the mean cross entropy of the bags' scores in every weight."""
    f = _forward(p, x, sizes)
    error = (f["score"] - labels) / len(labels)
    dz = error[:, None] * p["c"]
    pulled = (dz[f["bag"]] * f["h"]).sum(axis=1)               # of the loss on each attention weight
    mean = np.add.reduceat(f["attention"] * pulled, f["starts"])[f["bag"]]
    dg = f["attention"] * (pulled - mean)
    dt = dg[:, None] * p["w"] * f["s"] * (1 - f["t"] ** 2)
    ds = dg[:, None] * p["w"] * f["t"] * f["s"] * (1 - f["s"])
    dh = f["attention"][:, None] * dz[f["bag"]] + dt @ p["V"].T + ds @ p["U"].T
    du = dh * (1 - f["h"] ** 2)
    return {"A": x.T @ du, "a": du.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
            "w": (f["t"] * f["s"]).T @ dg, "c": f["z"].T @ error, "d": np.array([error.sum()])}


def fit_bags(bags: list[np.ndarray], labels: np.ndarray, codes: int = 16, gates: int = 8,
             rounds: int = 200, rate: float = 0.03, decay: float = 1e-3, seed: int = 7) -> Model:
    """Fit on bags of passage figures and labels in 0..1 by full-batch Adam.

    Without any bag every text scores 0.5; with one class only, near that class.
    """
    random = np.random.default_rng(seed)
    p = {"A": random.normal(0, 0.3, (FIGURES, codes)), "a": np.zeros(codes),
         "V": random.normal(0, 0.3, (codes, gates)), "U": random.normal(0, 0.3, (codes, gates)),
         "w": random.normal(0, 0.3, gates), "c": random.normal(0, 0.3, codes), "d": np.zeros(1)}
    if not bags:
        return Model(np.zeros(FIGURES), np.ones(FIGURES), {k: np.zeros_like(v) for k, v in p.items()})
    every, sizes = np.concatenate(bags), np.array([len(b) for b in bags])
    model = Model(every.mean(axis=0), np.maximum(every.std(axis=0), 1e-3), p)
    x = np.clip((every - model.mean) / model.scale, -8, 8)
    m, v = ({k: np.zeros_like(q) for k, q in p.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        grad = _gradient(p, x, sizes, labels)
        for k in p:
            g = grad[k] + (decay * p[k] / len(labels) ** 0.5 if k in "AVU" else 0)
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return model


def held_out(id_col: Column) -> Column:
    """Documents never learnt from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(id_col.cast("long").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = 4000, most: int = 200_000) -> Model:
    """Fit on at most ``sample`` labelled documents that are not held out, and at most
    ``most`` passages in all: the first in the order of the id's hash, each whole, up
    to the one that would go beyond (the first is always taken).

    Labels that are null are ignored; of several labels of one id the mean counts, of
    several texts of one id the smallest.  Labels without a document, or null ids, are
    ignored.
    """
    small_batches(docs.sparkSession)
    named = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label")) \
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id"))) \
        .groupBy("id").agg(F.avg("label").alias("label"))
    place = F.xxhash64("id").alias("place")
    named = named.select("id", "label", place).orderBy("place", "id").limit(sample)  # bounded: broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, text=3):
            found = [passages(t).astype("<f8").tobytes() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())],
                                             names=["place", "id", "label", "figures"])

    rows = docs.select(column(id_col).cast("long").alias("id"), text_of(text_col).alias("text")) \
        .join(F.broadcast(named), "id").groupBy("place", "id", "label").agg(F.min("text").alias("text"))
    bags = stored(rows.mapInArrow(run, "place long, id long, label double, figures binary"))
    sizes = bags.select("place", "id", F.octet_length("figures").alias("size"))   # a row a sampled document
    total, chosen = 0, []
    for r in sizes.orderBy("place", "id").collect():
        total += r["size"] // (8 * FIGURES)
        if chosen and total > most:
            break
        chosen.append(r)
    if not chosen:
        return fit_bags([], np.empty(0))
    last = F.struct(F.lit(chosen[-1]["place"]).alias("place"), F.lit(chosen[-1]["id"]).alias("id"))
    got = bags.where(F.struct("place", "id") <= last).orderBy("place", "id").collect()
    return fit_bags([np.frombuffer(r["figures"], "<f8").reshape(-1, FIGURES) for r in got],
                    np.array([r["label"] for r in got]))


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` (every row and column) with ``out``, the score of the whole text in
    0..1.  A null text counts as empty; an empty text gets the score of an empty
    passage.  An empty table gives an empty result; a column ``out`` is replaced."""
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, text=0):
            found = model.scores([passages(t) for t in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found)], names=["row", "score"])

    rows = docs.select(text_of(text_col).alias("text"), F.struct(*[column(c) for c in names]).alias("row"))
    kind = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, kind).select("row.*", F.col("score").alias(out))
