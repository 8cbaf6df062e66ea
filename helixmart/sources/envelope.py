"""JSON lines of the form ``{"table": ..., "row": {...}}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "table string, row map<string,string>"


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)


def quarantine_unrouted(envelopes: DataFrame, routed, root: str, batch: str | None = None) -> None:
    """Write envelopes of tables that are not in ``routed`` below ``root/_quarantine``, one folder per table.

    A named batch has folders of its own, which it replaces when it runs again.
    """
    lost = envelopes.filter(~F.coalesce(F.col("table").isin(list(routed)), F.lit(False)))
    kept = lost.select(F.coalesce("table", F.lit("NULL")).alias("table"), F.to_json("row").alias("row"))
    if batch is None:
        kept.write.partitionBy("table").mode("append").json(f"{root}/_quarantine")
        return
    named = kept.withColumn("_batch", F.lit(batch))
    named.write.partitionBy("table", "_batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").json(f"{root}/_quarantine")


def split_by_table(envelopes: DataFrame, folder: str) -> DataFrame:
    """Parse the envelopes once: written below ``folder``, a folder per table, so that a table's rows are read alone."""
    envelopes.select("table", "row").write.mode("overwrite").partitionBy("table").parquet(folder)
    return envelopes.sparkSession.read.schema(SCHEMA).parquet(folder)


def rows_of(envelopes: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows of one table as text columns; absent keys are NULL."""
    return envelopes.filter(F.col("table") == table).select(
        *[F.try_element_at("row", F.lit(c)).alias(c) for c in columns]
    )
