"""Fit rows to a target table's columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType, TimestampType


def align(df: DataFrame, target: StructType, lenient: bool = False) -> DataFrame:
    """Exactly the target's columns and types: unknown ones dropped, absent ones NULL.

    Fails when no column matches. ``lenient`` gives NULL for values that do not cast.
    """
    have = set(df.columns)
    if not have & set(target.names):
        raise ValueError("none of the columns matches the target table")

    def fit(field):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        c = F.col(field.name)
        source = df.schema[field.name].dataType
        if source == field.dataType:
            return c
        if isinstance(source, StringType) and not isinstance(field.dataType, StringType):
            if isinstance(field.dataType, (DateType, TimestampType)) or lenient:
                c = F.nullif(c, F.lit(""))
        return (c.try_cast(field.dataType) if lenient else c.cast(field.dataType)).alias(field.name)

    return df.select(*[fit(f) for f in target])


def common_columns(*frames: DataFrame) -> list[str]:
    """Sorted union of the frames' columns."""
    return sorted(set().union(*[f.columns for f in frames]))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows under the union of the columns; absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_rows(base: DataFrame, update: DataFrame, keys: list[str]) -> DataFrame:
    """Overlay ``update``'s columns on ``base`` per key; a matched row takes all of them, NULLs too."""
    marked = update.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_u_{c}") for c in update.columns if c not in keys])
    joined = base.join(marked, keys, "left")
    fresh = [c for c in update.columns if c not in keys]
    cols = [
        (
            F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c)
            if c in fresh
            else F.col(c)
        )
        for c in base.columns
    ]
    extra = [F.col(f"_u_{c}").alias(c) for c in fresh if c not in base.columns]
    return joined.select(*cols, *extra)


def map_keys_union(df: DataFrame, map_column: str) -> DataFrame:
    """Distinct keys of a map column over all rows."""
    return df.select(F.explode(F.map_keys(map_column)).alias("key")).distinct()
