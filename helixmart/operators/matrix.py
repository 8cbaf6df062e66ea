"""Sparse matrices as coordinate rows, categorical codes, and wide/long reshaping.

A matrix stays in long ``(cell, gene, value)`` form; only chosen genes become columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixmart.operators.joins import skew_join


def decode_categories(
    df: DataFrame, code: str, dictionary: DataFrame, out: str, dict_code: str = "code", dict_value: str = "category"
) -> DataFrame:
    """Replace a dictionary code by its category; -1 (missing) and unknown codes give NULL."""
    pairs = dictionary.filter(F.col(dict_code) >= 0).select(F.col(dict_code).alias(code), F.col(dict_value).alias(out))
    return df.join(pairs, code, "left")


def dictionary_rows(categories: DataFrame, array_column: str) -> DataFrame:
    """``array<string>`` dictionary -> ``(code, category)`` rows."""
    return categories.select(F.posexplode(array_column).alias("code", "category"))


def label_coordinates(
    coords: DataFrame, features: DataFrame, barcodes: DataFrame, salts: int = 0
) -> DataFrame:
    """Attach gene and cell labels to ``(gene_index, cell_index, value)`` rows by position."""
    genes = features.select(F.col("index").alias("gene_index"), "gene_id", "gene_symbol")
    cells = barcodes.select(F.col("index").alias("cell_index"), "cell_barcode")
    labelled = skew_join(coords, genes, ["gene_index"], "inner", salts)
    return skew_join(labelled, cells, ["cell_index"], "inner", salts).select(
        "cell_barcode", "gene_id", "gene_symbol", "value"
    )


def csr_to_coordinates(data: DataFrame, indptr: DataFrame, width: int = 64) -> DataFrame:
    """``data(pos, col, value)`` and ``indptr(row, start, end)`` -> ``(row, col, value)``.

    Row spans are cut at multiples of ``width`` positions, so the range condition becomes an
    equi join on the block of positions and a filter. The rows of a sparse matrix do not
    overlap: a block meets at most ``width`` spans, whatever the row lengths, and a row that
    holds a third of all entries is spread over its many blocks.
    """

    def block(pos: Column) -> Column:
        return F.floor(pos / width).cast("bigint")

    spans = indptr.filter(F.col("end") > F.col("start")).withColumn(
        "_block", F.explode(F.sequence(block(F.col("start")), block(F.col("end") - 1)))
    )
    return (
        data.withColumn("_block", block(F.col("pos")))
        .join(spans, "_block")
        .filter((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("end")))
        .select("row", "col", "value")
    )


def densify(
    coords: DataFrame, row: str, column: str, value: str, chosen: dict[str, str], all_rows: DataFrame | None = None
) -> DataFrame:
    """Chosen columns as a dense block: ``chosen`` maps a column id to its output name.

    Absent coordinates are 0. ``all_rows`` (column ``row``) adds rows without any entry.
    One map-side combined aggregation; ids, not symbols, so equal symbols stay apart.
    """
    picked = coords.filter(F.col(column).isin(list(chosen)))
    wide = picked.groupBy(row).agg(
        *[F.sum(F.when(F.col(column) == k, F.col(value))).alias(name) for k, name in chosen.items()]
    )
    if all_rows is not None:
        wide = all_rows.select(row).distinct().join(wide, row, "left")
    return wide.fillna(0, subset=list(chosen.values()))


def matrix_shape(coords: DataFrame, row: str, column: str) -> DataFrame:
    return coords.agg(F.count_distinct(row).alias("n_rows"), F.count_distinct(column).alias("n_columns"))


def wide_counts_to_long(df: DataFrame, ids: list[str], run: str = "run", count: str = "count") -> DataFrame:
    """Wide count matrix (one column per run) -> one row per gene and run."""
    runs = [c for c in df.columns if c not in ids]
    return df.unpivot(ids, runs, run, count)


def attributes_to_columns(
    df: DataFrame, keys: list[str], attribute: str, value: str, names: dict[str, str], iri: str | None = None
) -> DataFrame:
    """Attribute rows -> one row per key; ``names`` maps an attribute to its column name.

    With ``iri`` each attribute also yields ``<name>_iri``. The smallest value wins if an
    attribute repeats, so the result does not depend on row order.
    """

    def pick(attr: str, source: str, alias: str) -> Column:
        return F.min(F.when(F.col(attribute) == attr, F.col(source))).alias(alias)

    picks = [pick(a, value, n) for a, n in names.items()]
    if iri:
        picks += [pick(a, iri, f"{n}_iri") for a, n in names.items()]
    return df.groupBy(*keys).agg(*picks)
