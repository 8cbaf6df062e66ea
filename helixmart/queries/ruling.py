"""Rule mapping, quarantine, alignment and row merges."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helixmart.functions.ids import strip_version
from helixmart.functions.registry import CURRENT
from helixmart.operators.align import align, common_columns, merge_rows
from helixmart.operators.rules import harmonize, load_rules, split_quarantine
from helixmart.queries.base import GENE_ID, TERM_ID, query, table

GENE_RULES = {
    "columns": {
        "gene_entry": {
            "regex": r"ENS[A-Z]*G\d{5,}(\.\d+)?",
            "transforms": ["strip_version"],
            "target_table": "Genes",
            "target_column": "gene_accession",
        },
        "term_entry": {
            "regex": r"(CHEBI|CL|NCBITaxon)[:_]\d+",
            "transforms": ["canonical_iri"],
            "target_table": "Genes",
            "target_column": "pathway_iri",
        },
        "statistic_entry": {
            "regex": r"exprstat:.*",
            "transforms": ["parse_expression_stat_record"],
            "target_table": "Genes",
            "target_column": "sample_id",
        },
        "colour_entry": {
            "regex": r"(red|blue) .*",
            "transforms": ["shout"],
            "target_table": "Genes",
            "target_column": "gene_name",
        },
        "unfinished_entry": {
            "regex": r"blue .*",
            "transforms": ["stub_fetch_gene_metadata"],
            "target_table": "Genes",
            "target_column": "gene_name",
        },
    }
}
_RECORD = "concat(case p_type when 'SMALL' then 'stat:' else 'exprstat:' end, 'SAMP', cast(p_size as string), ',', {0}, ',-1.5,0.04,12.25,', cast(p_size as string), ',High')".format(GENE_ID)
_ALT = "case when p_size > 25 then concat('ENSMUSG', lpad(cast(p_partkey as string), 11, '0')) else p_brand end"


def gene_cells(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr(GENE_ID).alias("accession"),
        F.col("p_name").alias("gene_name"),
        F.expr(TERM_ID).alias("pathway_iri"),
        F.expr(_RECORD).alias("record"),
        F.expr(_ALT).alias("alternative"),
    )


def mapped_genes(spark, sf_dir):
    rules = load_rules(GENE_RULES, CURRENT.extended(shout=F.upper))
    return harmonize(gene_cells(spark, sf_dir), "Genes", rules)


_MAPPED = f"""
WITH v AS (
  SELECT p_partkey, {GENE_ID} AS accession, p_name AS gene_name, {TERM_ID} AS pathway_iri, {_RECORD} AS record, {_ALT} AS alternative
  FROM part),
s AS (SELECT *, CASE WHEN record LIKE 'exprstat:%' THEN string_split(split_part(record, ':', 2), ',') END AS f FROM v)
SELECT p_partkey, accession,
       CASE WHEN regexp_full_match(gene_name, '(red|blue) .*') THEN upper(gene_name) ELSE gene_name END AS gene_name,
       CASE WHEN regexp_full_match(pathway_iri, '(CHEBI|CL|NCBITaxon)[:_]\\d+')
            THEN 'http://purl.obolibrary.org/obo/' || regexp_replace(pathway_iri, '[:_]', '_') ELSE pathway_iri END AS pathway_iri,
       record, alternative,
       CASE WHEN regexp_full_match(alternative, 'ENS[A-Z]*G\\d{{5,}}(\\.\\d+)?') THEN split_part(alternative, '.', 1)
            WHEN f IS NOT NULL THEN split_part(f[2], '.', 1)
            ELSE split_part(accession, '.', 1) END AS gene_accession,
       f[1] AS sample_id, cast(f[3] AS DOUBLE) AS log2_fc, cast(f[4] AS DOUBLE) AS p_value,
       cast(f[5] AS DOUBLE) AS base_mean, cast(f[6] AS BIGINT) AS raw_count, f[7] AS significance
FROM s
"""


@query(_MAPPED)
def rule_mapping(spark, sf_dir):
    return mapped_genes(spark, sf_dir)


_SAMPLE_CELL = "concat('SAMP', lpad(cast(o_orderkey as string), 8, case o_orderstatus when 'P' then 'x' else 'Z' end))"
_SAMPLE_RULES = {
    "columns": {
        "sample_entry": {
            "regex": r"SAMP.*",
            "transforms": ["extract_sample_id"],
            "target_table": "Samples",
            "target_column": "iri",
        }
    }
}


@query(f"""
WITH v AS (SELECT o_orderkey, {_SAMPLE_CELL} AS cell FROM orders)
SELECT cast(regexp_full_match(cell, 'SAMP[A-Z0-9]{{8}}') AS INTEGER) AS accepted, count(*) AS n_rows,
       cast(sum(o_orderkey) AS BIGINT) AS key_sum
FROM v GROUP BY 1
""")
def rule_quarantine(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_SAMPLE_CELL).alias("cell"))
    marked = harmonize(rows, "Samples", load_rules(_SAMPLE_RULES), on_error="quarantine")
    clean, rejected = split_quarantine(marked)
    both = clean.select("o_orderkey", F.lit(1).alias("accepted")).unionAll(
        rejected.select("o_orderkey", F.lit(0).alias("accepted"))
    )
    return both.groupBy("accepted").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum"))


@query("""
SELECT c_custkey, c_name FROM customer
""")
def rule_pass_through(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return harmonize(rows, "Studies", load_rules(GENE_RULES, CURRENT.extended(shout=F.upper)))


@query("""
SELECT 'E-MTAB-' || cast(c_custkey AS string) AS iri, c_name AS title, cast(NULL AS string) AS source_repo,
       cast(c_nationkey AS INTEGER) AS num_samples, cast(NULL AS string) AS contact_email
FROM customer
""")
def align_schema(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("E-MTAB-"), F.col("c_custkey").cast("string")).alias("iri"),
        F.col("c_name").alias("title"),
        F.col("c_nationkey").cast("string").alias("num_samples"),
        F.col("c_mktsegment").alias("segment"),
    )
    target = StructType.fromDDL(
        "iri string, title string, source_repo string, num_samples int, contact_email string"
    )
    return align(rows, target)


@query("""
SELECT c_custkey, c_name AS name, c_mktsegment AS segment, NULL::BIGINT AS s_suppkey FROM customer
UNION ALL
SELECT NULL, s_name, NULL, s_suppkey FROM supplier
""")
def key_union(spark, sf_dir):
    from helixmart.operators.align import union_by_name

    a = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    b = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("name"))
    return union_by_name(a, b).select(*common_columns(a, b))


@query("""
SELECT c.c_custkey, CASE WHEN o.o_custkey IS NOT NULL THEN 'seen' ELSE c.c_name END AS c_name,
       CASE WHEN o.o_custkey IS NOT NULL THEN NULL ELSE c.c_mktsegment END AS c_mktsegment,
       o.n_orders
FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) o
  ON c.c_custkey = o.o_custkey
""")
def row_merge(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    update = (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus = 'F'")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
        .select("c_custkey", F.lit("seen").alias("c_name"), F.lit(None).cast("string").alias("c_mktsegment"), "n_orders")
    )
    return merge_rows(base, update, ["c_custkey"])


def flagship(spark, sf_dir):
    """Gene slice end to end: cells -> rules -> target columns -> first row per accession."""
    from helixmart.operators.joins import keep_one
    from helixmart.plans.schemas import TABLES

    cells = gene_cells(spark, sf_dir).withColumn("gene_accession", strip_version(F.col("accession")))
    rules = load_rules(GENE_RULES, CURRENT.extended(shout=F.upper))
    return keep_one(align(harmonize(cells, "Genes", rules), TABLES["Genes"]), ["gene_accession"])
