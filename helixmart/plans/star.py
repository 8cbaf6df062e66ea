"""Dimensional load: dimensions with dense surrogate keys, then the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixmart.operators.joins import keep_one, skew_join
from helixmart.operators.numbering import number_distinct


def dimension(rows: DataFrame, natural_key: str, attributes: list[str], surrogate: str) -> DataFrame:
    """One row per natural key with a dense surrogate key."""
    members = keep_one(rows.select(natural_key, *attributes), [natural_key], null_keys=False)
    return number_distinct(members, natural_key, out=surrogate).select(surrogate, natural_key, *attributes)


def extend_dimension(
    stored: DataFrame, rows: DataFrame, natural_key: str, attributes: list[str], surrogate: str
) -> DataFrame:
    """Members not stored yet, numbered after the highest stored key."""
    highest = stored.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("m")).first()["m"]
    fresh = rows.select(natural_key, *attributes).join(stored.select(natural_key), natural_key, "left_anti")
    return dimension(fresh, natural_key, attributes, surrogate).withColumn(surrogate, F.col(surrogate) + F.lit(highest))


def fact(rows: DataFrame, dims: list[tuple[DataFrame, str, str]], measures: list[str], salts: int = 0) -> DataFrame:
    """Replace natural keys by surrogate keys: ``dims`` holds (dimension, natural key, surrogate).

    A measure row without a dimension member keeps a NULL key; see ``integrity.orphans``.
    """
    out = rows
    for dim, natural, surrogate in dims:
        out = skew_join(out, dim.select(natural, surrogate), [natural], "left", salts)
    return out.select(*[s for _, _, s in dims], *measures)
