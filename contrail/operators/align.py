"""Schema alignment (U1-U3), optional columns (P4) and flattening."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def widen_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Type of a column seen with types ``a`` and ``b`` in two inputs.

    Rules, in order: equal -> same; long/double -> double; either string ->
    string; both numeric -> double; anything else (null, mixed kinds) -> string.
    """
    if a == b:
        return a
    if {type(a), type(b)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(a, T.StringType) or isinstance(b, T.StringType):
        return T.StringType()
    if isinstance(a, _NUMERIC) and isinstance(b, _NUMERIC):
        return T.DoubleType()
    return T.StringType()


def unified_schema(dfs: list[DataFrame]) -> T.StructType:
    """All columns in order of first appearance, each as wide as any input has it."""
    seen: dict[str, list[T.DataType]] = {}
    for field in chain.from_iterable(df.schema.fields for df in dfs):
        seen.setdefault(field.name, []).append(field.dataType)
    return T.StructType([T.StructField(name, reduce(widen_type, kinds)) for name, kinds in seen.items()])


def _q(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def align_frames(dfs: list[DataFrame]) -> list[DataFrame]:
    """Give every frame the unified schema; missing columns become typed nulls."""
    target = unified_schema(dfs)
    return [df.select([optional_col(df, f.name, f.dataType).cast(f.dataType).alias(f.name) for f in target])
            for df in dfs]


def align_union(dfs: list[DataFrame]) -> DataFrame | None:
    """Rule-based type widening, then UNION ALL by name."""
    dfs = [d for d in dfs if d is not None]
    if not dfs:
        return None
    return reduce(lambda a, b: a.unionByName(b), align_frames(dfs))


def concat_frames(dfs: list[DataFrame]) -> DataFrame | None:
    """None -> None, one -> itself, several -> aligned union."""
    dfs = [d for d in dfs if d is not None]
    if not dfs:
        return None
    if len(dfs) == 1:
        return dfs[0]
    return align_union(dfs)


def optional_col(df: DataFrame, name: str, dtype: str | T.DataType,
                 alias: str | None = None) -> Column:
    """The column if present, else a typed null."""
    c = F.col(_q(name)) if name in df.columns else F.lit(None).cast(dtype)
    return c.alias(alias or name)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> leaf columns named ``a.b.c``; arrays untouched."""
    cols: list[Column] = []

    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f.dataType, path + [f.name])
        else:
            ref = F.col(_q(path[0]))
            for p in path[1:]:
                ref = ref.getField(p)
            cols.append(ref.alias(sep.join(path)))

    for f in df.schema.fields:
        walk(f.dataType, [f.name])
    return df.select(cols)
