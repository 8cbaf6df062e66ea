"""Sample-to-data-relationship rows and wide count matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixmart.operators.matrix import attributes_to_columns, wide_counts_to_long
from helixmart.sources.tsv import read_headerless, read_tsv

CONDENSED_SCHEMA = "study string, array string, run string, kind string, attribute string, value string, iri string"
GENE_COLUMNS = ["Gene ID", "Gene Name"]


def read_condensed(spark: SparkSession, path: str) -> DataFrame:
    return read_headerless(spark, path, CONDENSED_SCHEMA)


def characteristics_wide(sdrf: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row per study and run with the chosen characteristics, label and IRI each."""
    rows = sdrf.filter(F.col("kind") == "characteristic")
    return attributes_to_columns(rows, ["study", "run"], "attribute", "value", names, "iri")


def read_wide_counts(spark: SparkSession, path: str, header: str) -> DataFrame:
    """``(gene_id, gene_name, run, count)`` rows of a matrix with one column per run."""
    wide = read_tsv(spark, [path], header)
    long = wide_counts_to_long(wide, GENE_COLUMNS)
    return long.select(
        F.col("Gene ID").alias("gene_id"),
        F.col("Gene Name").alias("gene_name"),
        "run",
        F.col("count").cast("bigint").alias("count"),
    )
