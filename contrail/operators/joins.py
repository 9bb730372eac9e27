"""Dictionary (dimension) joins, J1a-J1e.

Whether a dictionary is broadcast is the planner's choice: it knows the size in
bytes, and AQE revises it at run time; a large one is joined by sort-merge with
skewed keys split.  "Last" in a dictionary is the last by file and place in the
file, where its reader has kept them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators.dedup import keep_last

# Columns by which a dictionary's rows are ordered, if it has them.
DICTIONARY_ORDER = ("file_path", "record_pos")


def dictionary_order(dim: DataFrame) -> list[str]:
    return [c for c in DICTIONARY_ORDER if c in dim.columns]


def dimension_join(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Equi-join a fact table with a (usually small) dictionary."""
    return fact.join(dim, on=on, how=how)


def airport_columns(airports: DataFrame, key: str, prefix: str,
                    with_name: bool = True) -> DataFrame:
    """Rename an airports dictionary for the departure/arrival side."""
    cols = [F.col("iata_code").alias(key)]
    if with_name:
        cols.append(F.col("name").alias(f"{prefix}_airport_name"))
    cols += [F.col("lat").cast("double").alias(f"{prefix}_lat"),
             F.col("lng").cast("double").alias(f"{prefix}_lng")]
    return airports.select(cols)


def join_airports(df: DataFrame, airports: DataFrame | None, key: str, prefix: str,
                  dedup_order: list[str] | None = None) -> DataFrame:
    """Name, lat, lng of ``key``'s airport.

    With ``dedup_order`` the dictionary is first reduced to its last row per
    code (J1e; an empty order means file order); without it duplicates fan out,
    as the silver layer does.
    """
    if airports is None:
        return (df.withColumn(f"{prefix}_airport_name", F.lit(None).cast("string"))
                  .withColumn(f"{prefix}_lat", F.lit(None).cast("double"))
                  .withColumn(f"{prefix}_lng", F.lit(None).cast("double")))
    dim = airports
    if dedup_order is not None:
        dim = keep_last(dim, ["iata_code"], dedup_order or dictionary_order(dim))
    return dimension_join(df, airport_columns(dim, key, prefix), key)


def join_airlines(df: DataFrame, airlines: DataFrame | None,
                  dedup_order: list[str] | None = None,
                  replace: bool = False) -> DataFrame:
    """J1c / J1e: ``airline_name`` by ``airline_code``.

    ``replace`` drops a stale ``airline_name`` first (P10).  An absent
    dictionary yields a null name instead of a missing column.
    """
    if replace and "airline_name" in df.columns:
        df = df.drop("airline_name")
    if airlines is None:
        if "airline_name" in df.columns:
            return df
        return df.withColumn("airline_name", F.lit(None).cast("string"))
    dim = airlines
    if dedup_order is not None:
        dim = keep_last(dim, ["iata_code"], dedup_order or dictionary_order(dim))
    dim = dim.select(F.col("iata_code").alias("airline_code"),
                     F.col("name").alias("airline_name"))
    return dimension_join(df, dim, "airline_code")


def join_fleets(df: DataFrame, fleets: DataFrame | None) -> DataFrame:
    """J1d: aircraft columns by ``reg_number``; dictionary reduced to its last
    row per registration first."""
    cols = {"aircraft_manufacturer": "string", "aircraft_model": "string",
            "aircraft_built_year": "bigint", "aircraft_age_years": "bigint"}
    if fleets is None:
        for c, t in cols.items():
            df = df.withColumn(c, F.lit(None).cast(t))
        return df
    planes = fleets.select(
        "reg_number",
        F.col("manufacturer").alias("aircraft_manufacturer"),
        F.col("model").alias("aircraft_model"),
        F.col("built").alias("aircraft_built_year"),
        F.col("age").alias("aircraft_age_years"), *dictionary_order(fleets))
    planes = keep_last(planes, ["reg_number"], dictionary_order(fleets)).drop(*DICTIONARY_ORDER)
    return dimension_join(df, planes, "reg_number")
