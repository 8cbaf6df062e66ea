"""Heads and samples with a stated order, and set differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def head(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def seeded_sample(df: DataFrame, keys: list[str], seed: int, n: int = 5) -> DataFrame:
    """``n`` rows picked by a keyed hash: the same rows whatever the partitioning."""
    picked = F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(picked, *keys).limit(n)


def set_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def set_minus(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)
