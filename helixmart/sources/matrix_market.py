"""Matrix Market coordinate files and their label files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixmart.sources.tsv import read_headerless, with_line_index


def _banner_and_size(spark: SparkSession, path: str) -> tuple[str, str]:
    """The first line, and the first line that is neither a comment nor blank.

    ``head(1)`` starts with the file's first block and stops at the first row it finds.
    """
    lines = spark.read.text(path)
    banner = lines.head(1)
    if not banner or not banner[0]["value"].startswith("%%MatrixMarket"):
        raise ValueError(f"{path}: no Matrix Market banner")
    size = lines.filter(~F.col("value").startswith("%") & (F.trim("value") != "")).head(1)
    return banner[0]["value"], size[0]["value"]


def read_matrix_market(spark: SparkSession, path: str) -> DataFrame:
    """``(gene_index, cell_index, value)`` entries, 1-based; ``pattern`` entries have value 1.

    The size line looks like an entry. It is dropped by its text, and given back when the text
    occurs twice, i.e. when the last cell's entry happens to read the same.
    """
    banner, size = _banner_and_size(spark, path)
    kind = banner.lower().split()
    if "coordinate" not in kind:
        raise ValueError(f"{path}: only coordinate matrices are supported")
    if {"complex", "hermitian"} & set(kind):
        raise ValueError(f"{path}: complex matrices are not supported")
    lines = spark.read.text(path).filter(~F.col("value").startswith("%")).filter(F.trim("value") != "")
    same = F.col("value") == size
    repeated = (
        lines.filter(same).groupBy("value").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("value")
    )
    entries = lines.filter(~same).unionAll(repeated)
    parts = F.split(F.trim("value"), r"\s+")
    value = F.lit(1.0) if "pattern" in kind else F.get(parts, F.lit(2)).cast("double")
    coords = entries.select(
        F.get(parts, F.lit(0)).cast("bigint").alias("gene_index"),
        F.get(parts, F.lit(1)).cast("bigint").alias("cell_index"),
        value.alias("value"),
    )
    if {"symmetric", "skew-symmetric"} & set(kind):
        other = -F.col("value") if "skew-symmetric" in kind else F.col("value")
        mirrored = coords.filter("gene_index <> cell_index").select(
            F.col("cell_index").alias("gene_index"), F.col("gene_index").alias("cell_index"), other.alias("value")
        )
        coords = coords.unionAll(mirrored)
    return coords


def read_features(spark: SparkSession, path: str) -> DataFrame:
    scan = read_headerless(spark, path, "gene_id string, gene_symbol string, feature_type string")
    return with_line_index(scan.select("*", "_metadata")).drop("_metadata")


def read_barcodes(spark: SparkSession, path: str) -> DataFrame:
    scan = read_headerless(spark, path, "cell_barcode string")
    return with_line_index(scan.select("*", "_metadata")).drop("_metadata")
