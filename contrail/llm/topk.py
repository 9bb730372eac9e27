"""Exact top-k inner products by no-random-access aggregation.

A vector's score is a sum of one part from each component, and each component has
its own list of a block's vectors sorted by value.  A query reads the lists from
the end that serves it best, some entries at a time, and never looks a vector up
in a list.  What it has read of a vector gives a lower bound (each list unread
gives at least its worst part) and an upper bound (at most the part last read
there).  It stops when all but a short list of vectors have upper bounds below the
k-th lower bound, and resolves the scores of that list; short is a list that takes
less to resolve than the lists' rest takes to read.

Queries and candidates meet as blocks: a task holds one block of each, so no row
is paired with a row outside its task's two blocks, and what leaves a task is k
rows a query.  The k best of all blocks are taken by a rank over those.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import shuffle_width, stored
from contrail.llm.vectors import EXACT, matrix, quantised

#: Parts of the lists that have been read at each look at the bounds.
DEPTHS = (1 / 16, 1 / 4, 1 / 2, 3 / 4, 7 / 8, 1)

#: Rows of a block of candidates, at least and at most, and of a block of queries.
CANDIDATES, QUERIES = (1 << 12, 1 << 16), 1 << 12


class Lists:
    """The sorted lists of a block, two for each component: its rows by falling value
    and, at the same place plus the number of components, by rising value."""

    def __init__(self, values: np.ndarray):
        self.values = values                                        # rows x components
        up = np.argsort(values, axis=0, kind="stable").T
        self.rows = np.concatenate((up[:, ::-1], up))               # lists x places
        # doubles hold these whole numbers (quantised() sees to it)
        self.parts = np.take_along_axis(np.concatenate((values.T, values.T)), self.rows, axis=1).astype(np.float64)

    def read(self, lists: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and values at places ``begin`` to ``end`` of some lists."""
        return self.rows[lists, begin:end], self.parts[lists, begin:end]


def search(query: np.ndarray, lists: Lists, k: int, own: int = -1) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of a superset of the ``k`` best rows, ties included, row
    ``own`` left out.  Whole numbers throughout, exact at any size."""
    values = lists.values
    n, size = values.shape
    used = np.flatnonzero(query)
    peak = int(np.abs(query).max(initial=0)) * int(np.abs(values).max(initial=0)) * max(1, size)
    kind = np.float64 if 4 * peak < EXACT else object   # Python's whole numbers beyond doubles
    weights = query[used].astype(kind)
    # each list is read from the end that serves the query best
    mine = used + np.where(query[used] < 0, size, 0)
    worst = weights * lists.parts[mine, -1].astype(kind)
    over = np.zeros(n, kind)                        # parts read, less those lists' worst
    seen = np.zeros((len(used), n), np.float32)
    row = np.arange(len(used))[:, None]
    rest, done = np.ones(n, bool), 0
    if own >= 0:
        rest[own] = False
    for depth in DEPTHS if len(used) and rest.sum() > 4 * k else ():
        upto = max(done + 1, int(n * depth))
        rows, parts = lists.read(mine, done, upto)
        gain = parts.astype(kind, copy=False) * weights[:, None]
        last = gain[:, -1] - worst                  # an unread list gives no more than this
        gain -= worst[:, None]
        if kind is object:
            np.add.at(over, rows.ravel(), gain.ravel())
        else:
            over += np.bincount(rows.ravel(), gain.ravel(), n)
        done = upto
        if done == n:
            break
        seen[row, rows] = 1
        lower = over[rest]
        kth = np.sort(lower)[-k] if kind is object else np.partition(lower, len(lower) - k)[-k]
        most = last.sum()
        if most >= kth:
            continue                                # vectors not met at all may still qualify
        if kind is object:
            rest &= over + most - last @ seen.astype(object) >= kth
        else:                                       # single precision, with room for its error
            slack = 2.0 ** -22 * len(used) * most + 1
            rest &= over + (most + slack) - last.astype(np.float32) @ seen >= kth
        # resolving the vectors left by looking at them is less than reading on
        if rest.sum() <= max(4 * k, (n - done) // 4):
            break
    found = np.flatnonzero(rest)
    if kind is object:
        return found, values[found].astype(object) @ query.astype(object)
    return found, (values[found].astype(np.float64) @ query.astype(np.float64)).astype(np.int64)


def _best_of_block(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"dim": [], "qb": [], "qn": [], "query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and candidates.num_rows:
            dim, qb = queries["dim"][0].as_py(), queries["qb"][0].as_py()
            theirs, values = candidates["cid"].to_pylist(), matrix(candidates["cv"], dim)
            lists = Lists(values)
            # ids as ranks, null last, so that ties sort by them
            rank = np.empty(len(theirs), np.int64)
            rank[sorted(range(len(theirs)), key=lambda i: (theirs[i] is None, theirs[i] or 0))] = \
                np.arange(len(theirs))
            at = {(key, row.tobytes()): i for i, (key, row) in enumerate(zip(theirs, values))}
            mine = matrix(queries["v"], dim)
            for query, qid, qn in zip(mine, queries["id"].to_pylist(), queries["qn"].to_pylist()):
                # the query's own row, if it is in this block
                own = at.get((qid, query.tobytes()), -1)
                rows, scores = search(query, lists, k, own)
                best = sorted(zip((-scores).tolist(), rank[rows].tolist(), rows.tolist()))[:k]
                out["score"] += [-s for s, _, _ in best]
                out["vec_id"] += [theirs[r] for _, _, r in best]
                for name, value in (("dim", dim), ("qb", qb), ("qn", qn), ("query_id", qid)):
                    out[name] += [value] * len(best)
        return pa.table([pa.array(out["dim"], pa.int32()), pa.array(out["qb"], pa.int32()),
                         *(pa.array(out[c], pa.int64()) for c in ("qn", "query_id", "vec_id", "score"))],
                        names=list(out))

    return run


def top_k(vectors: DataFrame, k: int = 10, scale: int = 1024, every: int = 100,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` rows of the
    highest inner product with each query, of ``floor(scale * x)`` of the components.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but
    the query's own; ties go to the smaller id, null ids last.  Fewer candidates than
    ``k``: all of them.  A null vector, or one with a null or non-finite component,
    takes no part; vectors of different lengths have no product and are no candidates
    of each other.  Rows equal in id and vector count once; rows that share an id
    alone are queries and candidates of their own.  A score beyond a long, or a
    component beyond 2^53, fails the job.  An empty table gives an empty result;
    other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vec_col, scale)
    # one row of each (id, vector): equal rows meet as partial aggregates, and no
    # key of what follows is hot
    rows = stored(rows.dropDuplicates(["id", "v"]).select(
        "id", "v", F.size("v").alias("dim"), F.xxhash64("id", "v").alias("hash")))
    asks = (F.col("id") % every == 0)
    n, m = rows.agg(F.count("*"), F.count_if(asks)).first()
    least, most = CANDIDATES
    block = min(most, max(least, -(-n // shuffle_width(spark))))
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-(m or 0) // QUERIES))

    def every_of(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    queries = rows.where(asks).select(
        "id", "v", "dim", F.pmod(F.hash("hash"), F.lit(query_blocks)).cast("int").alias("qb"),
        # tells queries of one id apart, whatever block of candidates they meet
        F.col("hash").alias("qn"), every_of(blocks).alias("cb"))
    # names of their own: both sides of a cogroup come from one table
    candidates = rows.select(F.col("id").alias("cid"), F.col("v").alias("cv"), F.col("dim").alias("cdim"),
                             every_of(query_blocks).alias("cqb"),
                             F.pmod("hash", F.lit(blocks)).cast("int").alias("ccb"))
    best = queries.groupBy("dim", "qb", "cb").cogroup(candidates.groupBy("cdim", "cqb", "ccb")).applyInArrow(
        _best_of_block(k), "dim int, qb int, qn long, query_id long, vec_id long, score long")
    of_query = Window.partitionBy("query_id", "dim", "qn").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (best.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
