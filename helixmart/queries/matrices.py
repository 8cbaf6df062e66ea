"""Sparse-matrix and reshaping operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixmart.operators import matrix
from helixmart.queries.base import query, table


def _coords(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") + 1).alias("gene_index"),
        (F.col("l_orderkey") + 1).alias("cell_index"),
        F.col("l_quantity").alias("value"),
    )


@query("""
SELECT 'BC' || cast(o_orderkey AS string) AS cell_barcode, 'ENSG' || cast(p_partkey AS string) AS gene_id,
       p_name AS gene_symbol, l_quantity AS value
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
""")
def matrix_coo_labels(spark, sf_dir):
    features = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("index"),
        F.concat(F.lit("ENSG"), F.col("p_partkey").cast("string")).alias("gene_id"),
        F.col("p_name").alias("gene_symbol"),
    )
    barcodes = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("index"),
        F.concat(F.lit("BC"), F.col("o_orderkey").cast("string")).alias("cell_barcode"),
    )
    return matrix.label_coordinates(_coords(spark, sf_dir), features, barcodes)


@query("""
SELECT c_custkey AS "row", o_custkey AS col, o_totalprice AS value
FROM orders JOIN customer ON o_orderkey >= c_custkey * 10 AND o_orderkey < c_custkey * 10 + c_nationkey
""")
def csr_expand(spark, sf_dir):
    data = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pos"), F.col("o_custkey").alias("col"), F.col("o_totalprice").alias("value")
    )
    spans = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("row"),
        (F.col("c_custkey") * 10).alias("start"),
        (F.col("c_custkey") * 10 + F.col("c_nationkey")).alias("end"),
    )
    return matrix.csr_to_coordinates(data, spans, width=256)


_CHOSEN = {"A": "gene_a", "N": "gene_n", "R": "gene_r"}


@query("""
SELECT l_suppkey, coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'), 0) AS gene_a,
       coalesce(sum(l_quantity) FILTER (l_returnflag = 'N'), 0) AS gene_n,
       coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS gene_r
FROM lineitem GROUP BY 1
""")
def pivot_genes(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_quantity")
    return matrix.densify(rows, "l_suppkey", "l_returnflag", "l_quantity", _CHOSEN, rows)


@query("""
SELECT l_partkey AS gene_id, 'gene_' || lower(l_returnflag) AS run, sum(l_quantity) AS count
FROM lineitem GROUP BY 1, 2
""")
def unpivot_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("gene_id"), "l_returnflag", "l_quantity")
    wide = matrix.densify(rows, "gene_id", "l_returnflag", "l_quantity", _CHOSEN)
    return matrix.wide_counts_to_long(wide, ["gene_id"]).filter("count > 0")


@query("""
SELECT count(DISTINCT l_orderkey) AS n_rows, count(DISTINCT l_partkey) AS n_columns FROM lineitem
""")
def matrix_shape(spark, sf_dir):
    return matrix.matrix_shape(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


@query("""
SELECT user_id, min(props) FILTER (event_type = 'click') AS cell_type, min(props) FILTER (event_type = 'view') AS stimulus,
       min('iri/' || cast(event_id AS string)) FILTER (event_type = 'click') AS cell_type_iri,
       min('iri/' || cast(event_id AS string)) FILTER (event_type = 'view') AS stimulus_iri
FROM events GROUP BY 1
""")
def sdrf_wide(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "user_id", "event_type", "props", F.concat(F.lit("iri/"), F.col("event_id").cast("string")).alias("iri")
    )
    return matrix.attributes_to_columns(
        rows, ["user_id"], "event_type", "props", {"click": "cell_type", "view": "stimulus"}, "iri"
    )


@query("""
WITH d AS (SELECT row_number() OVER (ORDER BY p_type) - 1 AS code, p_type FROM (SELECT DISTINCT p_type FROM part))
SELECT l_orderkey, l_linenumber, p_type AS category
FROM lineitem LEFT JOIN d ON l_linenumber - 2 = code
""")
def categorical_decode(spark, sf_dir):
    # p_type has a fixed vocabulary, so its dictionary is one short array.
    categories = table(spark, sf_dir, "part").agg(F.array_sort(F.collect_set("p_type")).alias("categories"))
    dictionary = matrix.dictionary_rows(categories, "categories")
    codes = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_linenumber") - 2).alias("code")
    )
    return matrix.decode_categories(codes, "code", dictionary, "category").drop("code")
