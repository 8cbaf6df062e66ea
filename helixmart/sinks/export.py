"""Exports and audit rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixmart.operators.integrity import content_audit


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).mode("errorifexists").csv(path)


def write_if_absent(df: DataFrame, path: str) -> None:
    """Leave an existing output alone."""
    df.write.mode("ignore").parquet(path)


def write_staged_json(staged: DataFrame, path: str) -> None:
    """One JSON object per staged value, as the values arrive one by one."""
    staged.select("target_table", "target_column", F.array("value").alias("values")).write.json(path)


def write_raw_counts(counts: DataFrame, path: str) -> None:
    """Long counts in one folder per sample; a sample that is loaded again replaces its folder."""
    counts.write.partitionBy("sample_id").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def append_audit(df: DataFrame, path: str, source: str, batch: str, seconds: float) -> None:
    """One audit row per batch: source, row count, checksum, duration."""
    row = content_audit(df, source).select(
        F.lit(batch).alias("batch"), "source", "n_rows", "checksum", F.lit(float(seconds)).alias("duration_s")
    )
    row.write.mode("append").parquet(path)
