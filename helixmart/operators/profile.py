"""Profiles of categorical columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def category_profile(
    df: DataFrame, columns: list[str], list_below: int = 30, first: int = 10, separator: str = "|"
) -> DataFrame:
    """Per column: number of distinct values, and all of them if few, else the first ones.

    Distinct values are found in long form. Only the ``list_below`` smallest per column are
    ever brought together, and the row-number limit runs before the shuffle as well.
    """
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    values = text.unpivot([], columns, "column", "value").filter(F.col("value").isNotNull()).distinct()
    sizes = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_values"))
    order = Window.partitionBy("column").orderBy("value")
    smallest = values.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= list_below)
    heads = smallest.groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("_head"))
    # Both sides read one shuffle of the distinct values. A column of NULLs only has no value, and a row all the same.
    found = sizes.join(heads, "column")
    named = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    joined = named.join(found, "column", "left").select(
        "column", F.coalesce("n_values", F.lit(0)).alias("n_values"), F.coalesce("_head", F.array().cast("array<string>")).alias("_head")
    )
    few = F.col("n_values") < list_below
    shown = F.when(few, F.col("_head")).otherwise(F.slice("_head", 1, first))
    return joined.select(
        "column", "n_values", few.alias("complete"), F.array_join(shown, separator).alias("shown_values")
    )


def approximate_profile(df: DataFrame, columns: list[str], error: float = 0.02) -> DataFrame:
    """Approximate distinct counts of many columns in one pass (for very high cardinality)."""
    counts = df.agg(*[F.approx_count_distinct(c, error).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "approx_values")
