"""Vectors as whole numbers, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import column

#: Doubles hold every whole number up to here.
EXACT = 2.0 ** 53


def whole_numbers(vec: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component, as an array of longs; a component
    beyond 2^53 fails the job, as doubles no longer hold it."""
    def one(x: Column) -> Column:
        y = F.floor(x.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(x.cast("double") * F.lit(float(scale))) < EXACT, y).otherwise(
            F.raise_error(F.lit(f"a component times {scale} passes 2^53")).cast("long"))

    return F.transform(vec, one)


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int,
              size: int | None = None) -> DataFrame:
    """Rows (``id``, ``v``: array of longs) of the vectors that are not null, hold no
    null and no non-finite component and, where ``size`` is given, have that many."""
    vec = F.col("vec")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.select(column(id_col).cast("long").alias("id"), column(vec_col).alias("vec"))
    if size is not None:
        rows = rows.where(F.size("vec") == size)
    return rows.where(vec.isNotNull() & finite).select("id", whole_numbers(vec, scale).alias("v"))


def matrix(lists: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """Lists of one length as the rows of an int64 matrix."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), size)
