"""Annotated-matrix stores exported as Parquet: ``<store>/obs`` and ``<store>/var`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixmart.functions.ids import clean_gene_name
from helixmart.operators.eav import mapped_columns, to_items
from helixmart.sources.tsv import first_existing

# --- fixed values -----------------------------------------------------------------------
SKIPPED_ARRAYS = frozenset({"X", "counts"})
GENE_COLUMNS = ("_index", "gene_ids", "genes", "names", "feature_name")
# ----------------------------------------------------------------------------------------


def mapped_items(spark: SparkSession, store: str, mapping: dict, skip: frozenset = SKIPPED_ARRAYS) -> DataFrame:
    """``(column, value)`` items of the mapped ``var`` and ``obs`` columns; others are not read."""
    var = spark.read.parquet(f"{store}/var")
    obs = spark.read.parquet(f"{store}/obs")
    return to_items(var, mapped_columns(var.columns, "var", mapping)).unionAll(
        to_items(obs, mapped_columns(obs.columns, "obs", mapping, skip))
    )


def raw_count_uris(obs: DataFrame, store: str) -> DataFrame:
    """One item per sample that points into the store; none without a ``sample_id`` column."""
    if "sample_id" not in obs.columns:
        return obs.sparkSession.createDataFrame([], "column string, value string")
    return obs.select(
        F.lit("zarr_uri").alias("column"),
        F.concat(F.lit(f"{store}#obs/"), F.col("sample_id").cast("string")).alias("value"),
    )


def gene_list(spark: SparkSession, stores: list[str]) -> DataFrame:
    """Cleaned gene names of the alphabetically first store."""
    if not stores:
        raise FileNotFoundError("no store given")
    var = spark.read.parquet(f"{min(stores)}/var")
    column = first_existing(var.columns, GENE_COLUMNS)
    return var.select(clean_gene_name(F.col(column).cast("string")).alias("gene_name"))


def gene_catalogue(genes: DataFrame) -> DataFrame:
    """``(gene_iri, gene_name)`` view of the Genes table."""
    return genes.select(F.col("gene_accession").alias("gene_iri"), "gene_name")
