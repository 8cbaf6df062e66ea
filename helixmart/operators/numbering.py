"""Dense row numbers without a single-task window.

Rows are dealt into fixed buckets by a digest of their value. Bucket sizes are counted first
(a small table: groups x buckets), turned into running offsets, and each row's number is its
offset plus its place within its bucket. The order is that of ``(md5(value), value)``: fixed
for a given set of values, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_distinct(
    df: DataFrame, value: str, groups: list[str] | None = None, out: str = "n", hex_digits: int = 3
) -> DataFrame:
    """Number the rows of each group 1..n; ``value`` must be distinct within its group.

    A NULL value comes last in its group. ``hex_digits`` sets the number of buckets
    (16 ** hex_digits); the default of 4,096 suits up to some 10 ** 10 values.
    """
    text = F.col(value).cast("string")
    dealt = df.select(
        "*",
        (F.struct(*groups) if groups else F.lit(0)).alias("_g"),
        F.coalesce(F.substring(F.md5(text), 1, hex_digits), F.lit("~")).alias("_b"),
    )
    # _g and _b are never NULL, so rows of NULL groups join too, and the window's partitioning
    # serves the join as well.
    sizes = dealt.groupBy("_g", "_b").count()
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_g", "_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_g", "_b").orderBy(F.md5(text), text)
    placed = dealt.withColumn("_i", F.row_number().over(within))
    return placed.join(offsets, ["_g", "_b"]).select(*df.columns, (F.col("_off") + F.col("_i")).alias(out))
