"""Identifier functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixmart.functions import ids
from helixmart.functions.values import downgrade_significance, gene_length
from helixmart.operators.integrity import split_valid
from helixmart.queries.base import GENE_ID, STIMULUS_ID, STUDY_ID, TERM_ID, query, table

OBO = "http://purl.obolibrary.org/obo/"


@query(f"""
SELECT p_partkey, split_part({GENE_ID}, '.', 1) AS accession,
       trim(split_part(concat(' ', p_name, ' .', cast(p_size AS string)), '.', 1)) AS gene_name
FROM part
""")
def strip_version_first_dot(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        ids.strip_version(F.expr(GENE_ID)).alias("accession"),
        ids.clean_gene_name(F.expr("concat(' ', p_name, ' .', cast(p_size as string))")).alias("gene_name"),
    )


_NAMED = "concat(p_name, '.', cast(p_size as string))"


@query(f"""
SELECT p_partkey, regexp_replace({GENE_ID}, '\\.\\d+$', '') AS gene_suffix,
       regexp_replace({_NAMED}, '\\.\\d+$', '') AS name_suffix
FROM part
""")
def strip_version_suffix(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        ids.strip_version_suffix(F.expr(GENE_ID)).alias("gene_suffix"),
        ids.strip_version_suffix(F.expr(_NAMED)).alias("name_suffix"),
    )


_SHORT = "concat(case p_type when 'SMALL' then 'AT' when 'LARGE' then ' ENSG' else 'ENSMUSG' end, lpad(cast(p_partkey as string), 9, '0'), '.', cast(p_size as string))"


@query(f"""
WITH v AS (SELECT p_partkey, trim({_SHORT}) AS x, trim({_NAMED}) AS y FROM part)
SELECT p_partkey,
       CASE WHEN regexp_full_match(x, '[A-Za-z]{{2,4}}\\d{{6,}}(\\.\\d+)?')
            THEN regexp_extract(x, '^([A-Za-z]{{2,4}}\\d{{6,}})', 1) ELSE x END AS gene_id,
       CASE WHEN regexp_full_match(y, '[A-Za-z]{{2,4}}\\d{{6,}}(\\.\\d+)?')
            THEN regexp_extract(y, '^([A-Za-z]{{2,4}}\\d{{6,}})', 1) ELSE y END AS other_id
FROM v
""")
def strip_version_ensembl(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        ids.strip_ensembl_version(F.expr(_SHORT)).alias("gene_id"),
        ids.strip_ensembl_version(F.expr(_NAMED)).alias("other_id"),
    )


@query(f"""
WITH v AS (SELECT p_partkey, {TERM_ID} AS id, {GENE_ID} AS gene FROM part)
SELECT p_partkey,
       CASE WHEN regexp_matches(id, '^(CHEBI|NCBITaxon|CL|UBERON)[:_]')
                 THEN '{OBO}' || regexp_extract(id, '^([A-Za-z]+)[:_](.*)$', 1) || '_' || regexp_extract(id, '^([A-Za-z]+)[:_](.*)$', 2)
            WHEN regexp_matches(id, '^EFO[:_]')
                 THEN 'http://www.ebi.ac.uk/efo/EFO_' || regexp_extract(id, '^EFO[:_](.*)$', 1)
            ELSE id END AS iri,
       'http://identifiers.org/ensembl/' || regexp_replace(gene, '\\.\\d+$', '') AS gene_link
FROM v
""")
def canonical_iri(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        ids.canonical_iri(F.expr(TERM_ID)).alias("iri"),
        ids.ensembl_link(F.expr(GENE_ID)).alias("gene_link"),
    )


@query(f"""
WITH v AS (SELECT p_partkey, {TERM_ID} AS id FROM part),
n AS (
  SELECT p_partkey, id,
    CASE WHEN id LIKE '{OBO}CL\\_%' ESCAPE '\\' THEN 'CL'
         WHEN regexp_matches(id, '^(CL|EFO|NCBITaxon|UBERON|PATO|CHEBI|HANCESTRO|MONDO|HsapDv):') THEN split_part(id, ':', 1)
    END AS prefix,
    CASE WHEN id LIKE 'http%' THEN replace(id, '{OBO}CL_', '') ELSE substr(id, strpos(id, ':') + 1) END AS local
  FROM v)
SELECT p_partkey, prefix,
       CASE WHEN prefix IS NULL THEN NULL WHEN prefix = 'EFO' THEN 'http://www.ebi.ac.uk/efo/EFO_' || local
            ELSE '{OBO}' || prefix || '_' || local END AS iri,
       CASE WHEN prefix IS NOT NULL THEN prefix || ':' || local END AS curie,
       '/samples/' || id AS link
FROM n
""")
def ontology_normalise(spark, sf_dir):
    source = table(spark, sf_dir, "part").select("p_partkey", F.expr(TERM_ID).alias("id"))
    return source.select(
        "p_partkey",
        ids.ontology_prefix(F.col("id")).alias("prefix"),
        ids.ontology_iri(F.col("id")).alias("iri"),
        ids.ontology_curie(F.col("id")).alias("curie"),
        ids.local_link(F.col("id")).alias("link"),
    )


@query("""
SELECT p_type, count(*) AS n_ids, count(*) AS n_same
FROM part GROUP BY p_type
""")
def ontology_roundtrip(spark, sf_dir):
    curie = F.expr("concat(case p_size % 3 when 0 then 'CL:' when 1 then 'EFO:' else 'NCBITaxon:' end, cast(p_partkey as string))")
    back = ids.iri_to_curie(ids.curie_to_iri(F.col("curie")))
    return (
        table(spark, sf_dir, "part")
        .select("p_type", curie.alias("curie"))
        .groupBy("p_type")
        .agg(F.count(F.lit(1)).alias("n_ids"), F.sum((back == F.col("curie")).cast("bigint")).alias("n_same"))
    )


@query(f"""
WITH v AS (SELECT c_custkey, upper(trim({STUDY_ID})) AS accession FROM customer)
SELECT c_custkey, accession,
       CASE WHEN regexp_full_match(accession, 'GSE\\d+')
            THEN 'GSE' || cast(cast(substr(accession, 4) AS BIGINT) // 1000 AS string) || 'nnn' END AS archive
FROM v
""")
def study_accession_geo_prefix(spark, sf_dir):
    accession = ids.study_accession(F.expr(STUDY_ID))
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", accession.alias("accession"))
        .select("c_custkey", "accession", ids.geo_archive_prefix(F.col("accession")).alias("archive"))
    )


_SAMPLE = "concat('SAMP', lpad(cast(o_orderkey as string), 8, case o_orderstatus when 'P' then 'x' else 'Z' end))"


@query(f"""
WITH v AS (SELECT o_orderkey, {_SAMPLE} AS id FROM orders)
SELECT o_orderkey, id AS sample_id FROM v WHERE regexp_full_match(id, 'SAMP[A-Z0-9]{{8}}')
""")
def sample_id_valid(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_SAMPLE).alias("sample_id"))
    good, _ = split_valid(rows, ids.is_sample_id(F.col("sample_id")))
    return good


@query(f"""
WITH v AS (SELECT o_orderkey, {_SAMPLE} AS id FROM orders)
SELECT o_orderkey, id AS sample_id FROM v WHERE NOT regexp_full_match(id, 'SAMP[A-Z0-9]{{8}}')
""")
def sample_id_quarantine(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_SAMPLE).alias("sample_id"))
    _, bad = split_valid(rows, ids.is_sample_id(F.col("sample_id")))
    return bad


_TAXON = "concat('NCBITaxon:', case o_orderstatus when 'P' then 'x' else '' end, cast(o_custkey as string))"


@query(f"""
SELECT o_orderkey, try_cast(split_part({_TAXON}, ':', 2) AS INTEGER) AS taxon_id FROM orders
""")
def taxon_id(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", ids.taxon_number(F.expr(_TAXON)).alias("taxon_id"))


@query(f"""
WITH v AS (SELECT s_suppkey, {STIMULUS_ID} AS id FROM supplier)
SELECT s_suppkey, nullif(regexp_extract(id, 'CHEBI[:_](\\d+)', 1), '') AS chebi_id,
       CASE WHEN contains(id, '/') THEN regexp_extract(id, '([^/]*)$', 1) ELSE id END AS label
FROM v
""")
def chebi_id_last_segment(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.expr(STIMULUS_ID).alias("id"))
    return rows.select(
        "s_suppkey",
        ids.chebi_number(F.col("id")).alias("chebi_id"),
        ids.last_segment(F.col("id")).alias("label"),
    )


_SPECIES_GENE = "concat(case p_type when 'SMALL' then 'ENSMUSG' when 'LARGE' then 'ENSDARG' else 'ENSG' end, lpad(cast(p_partkey as string), 11, '0'))"


@query(f"""
SELECT p_partkey, CASE WHEN regexp_matches({_SPECIES_GENE}, '^ENSG\\d') THEN 9606
                       WHEN regexp_matches({_SPECIES_GENE}, '^ENSMUSG\\d') THEN 10090 END AS species_taxon_id
FROM part
""")
def species_from_prefix(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", ids.species_of_gene(F.expr(_SPECIES_GENE)).alias("species_taxon_id")
    )


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN 'NS' ELSE l_returnflag END AS significance
FROM lineitem
""")
def significance_downgrade(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        downgrade_significance(F.col("l_discount"), F.col("l_returnflag")).alias("significance"),
    )


@query("""
SELECT p_partkey,
       CASE WHEN p_size % 7 = 0 THEN NULL ELSE (p_partkey * 10 + p_size) - (p_partkey * 10) + 1 END AS gene_length_bp
FROM part
""")
def gene_length_span(spark, sf_dir):
    start = F.col("p_partkey") * 10
    end = F.when(F.col("p_size") % 7 != 0, F.col("p_partkey") * 10 + F.col("p_size"))
    return table(spark, sf_dir, "part").select("p_partkey", gene_length(start, end).alias("gene_length_bp"))


_FEATURE = "concat(upper(replace(p_name, ' ', '_')), case p_type when 'SMALL' then '-' else '_' end, 'ENSG', lpad(cast(p_partkey as string), 11, '0'))"


@query(f"""
WITH v AS (SELECT p_partkey, {_FEATURE} AS f FROM part)
SELECT p_partkey, nullif(regexp_extract(f, '^(.+)_(ENS[A-Z]*G\\d+)$', 1), '') AS symbol,
       nullif(regexp_extract(f, '^(.+)_(ENS[A-Z]*G\\d+)$', 2), '') AS accession
FROM v
""")
def feature_name_split(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", ids.split_feature_name(F.expr(_FEATURE)).alias("f"))
    return rows.select("p_partkey", "f.symbol", "f.accession")


_STIM = "concat(case s_nationkey % 4 when 0 then 'CHEBI:' when 1 then 'EFO:' when 2 then 'PUBCHEM:' else 'NONE' end, case s_nationkey % 4 when 3 then '' else cast(s_suppkey as string) end)"


@query(f"""
SELECT s_suppkey, {_STIM} AS iri FROM supplier
WHERE regexp_full_match({_STIM}, '(CHEBI:.*|EFO:.*|NONE)')
""")
def iri_prefix_check(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_STIM).alias("iri"))
    good, _ = split_valid(rows, ids.is_stimulus_iri(F.col("iri")))
    return good
