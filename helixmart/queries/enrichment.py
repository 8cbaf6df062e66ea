"""Enrichment joins. Reference tables are derived from the test tables by attribute."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixmart.operators import enrich
from helixmart.queries.base import GENE_ID, STIMULUS_ID, STUDY_ID, TERM_ID, query, table

AS_OF = "2025-06-30"
OBO = "http://purl.obolibrary.org/obo/"


def _expand(df, column, keys):
    return df.select(*keys, f"{column}.*")


def _gene_references(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("gene_accession", F.split_part(F.expr(GENE_ID), F.lit("."), F.lit(1)))
    a = part.filter(F.col("p_type").isin("SMALL", "LARGE")).select(
        "gene_accession",
        F.when(F.col("p_size") > 10, F.col("p_name")).otherwise("").alias("symbol"),
        F.col("p_brand").alias("name"),
        (F.col("p_partkey") * 10).alias("start"),
        (F.col("p_partkey") * 10 + F.col("p_size")).alias("end"),
        F.split("p_name", " ").alias("go_bp"),
    )
    b = part.filter("p_size <= 30").select(
        "gene_accession", F.col("p_type").alias("display_name"), F.lit(5).alias("start"), (F.col("p_size") + 5).alias("end")
    )
    return {"a": a, "b": b}


@query(f"""
WITH g AS (SELECT l_orderkey, l_linenumber, split_part(concat('ENSG', lpad(cast(l_partkey as string), 11, '0'), '.1'), '.', 1) AS acc FROM lineitem),
a AS (SELECT split_part({GENE_ID}, '.', 1) AS acc, CASE WHEN p_size > 10 THEN p_name ELSE '' END AS symbol, p_brand AS name,
             p_partkey * 10 AS s, p_partkey * 10 + p_size AS e, to_json(string_split(p_name, ' ')) AS go FROM part WHERE p_type IN ('SMALL', 'LARGE')),
b AS (SELECT split_part({GENE_ID}, '.', 1) AS acc, p_type AS name, 5 AS s, 5 + p_size AS e FROM part WHERE p_size <= 30)
SELECT l_orderkey, l_linenumber, g.acc AS gene_accession,
       CASE WHEN a.acc IS NOT NULL THEN coalesce(nullif(a.symbol, ''), a.name) WHEN b.acc IS NOT NULL THEN b.name
            ELSE 'Gene' || right(g.acc, 4) END AS gene_name,
       'NCBITaxon_9606' AS species_taxon_iri,
       cast(CASE WHEN a.acc IS NOT NULL THEN a.e - a.s + 1 WHEN b.acc IS NOT NULL THEN b.e - b.s + 1 END AS BIGINT) AS gene_length_bp,
       cast(NULL AS DOUBLE) AS gc_content, '[]' AS pathway_iri, coalesce(cast(a.go AS string), '[]') AS go_terms
FROM g LEFT JOIN a ON g.acc = a.acc LEFT JOIN b ON g.acc = b.acc
""")
def enrich_gene(spark, sf_dir):
    facts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr("concat('ENSG', lpad(cast(l_partkey as string), 11, '0'), '.1')").alias("id")
    )
    return _expand(enrich.gene(facts, "id", "m", _gene_references(spark, sf_dir)), "m", ["l_orderkey", "l_linenumber"])


# Half of the rows have no key, and a third have the same one.
SKEWED_PART = "CASE WHEN l_orderkey % 6 < 3 THEN NULL WHEN l_orderkey % 6 < 5 THEN 7 ELSE l_partkey END"


@query(f"""
WITH g AS (SELECT l_orderkey, l_linenumber, 'ENSG' || lpad(cast({SKEWED_PART} AS string), 11, '0') AS acc FROM lineitem),
a AS (SELECT split_part({GENE_ID}, '.', 1) AS acc, CASE WHEN p_size > 10 THEN p_name ELSE '' END AS symbol, p_brand AS name
      FROM part WHERE p_type IN ('SMALL', 'LARGE')),
b AS (SELECT split_part({GENE_ID}, '.', 1) AS acc, p_type AS name FROM part WHERE p_size <= 30)
SELECT l_orderkey, l_linenumber, g.acc AS gene_accession,
       CASE WHEN a.acc IS NOT NULL THEN coalesce(nullif(a.symbol, ''), a.name) WHEN b.acc IS NOT NULL THEN b.name
            ELSE 'Gene' || right(g.acc, 4) END AS gene_name
FROM g LEFT JOIN a ON g.acc = a.acc LEFT JOIN b ON g.acc = b.acc
""")
def enrich_skewed(spark, sf_dir):
    key = F.expr(f"concat('ENSG', lpad(cast({SKEWED_PART} as string), 11, '0'), '.1')").alias("id")
    facts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", key)
    found = enrich.gene(facts, "id", "m", _gene_references(spark, sf_dir), salts=32)
    return found.select("l_orderkey", "l_linenumber", "m.gene_accession", "m.gene_name")


@query(f"""
WITH v AS (SELECT s_suppkey, s_acctbal, s_nationkey, {STIMULUS_ID} AS raw FROM supplier),
s AS (SELECT *, CASE WHEN regexp_matches(raw, '^CHEBI[:_]') THEN '{OBO}CHEBI_' || cast(s_suppkey AS string)
                     WHEN raw LIKE 'EFO:%' THEN 'http://www.ebi.ac.uk/efo/EFO_' || cast(s_suppkey AS string) ELSE raw END AS iri FROM v),
j AS (SELECT s.*, a.s_name AS a_name, a.s_acctbal AS mass, b.s_name AS b_name
      FROM s LEFT JOIN supplier a ON s.iri LIKE '%CHEBI%' AND a.s_suppkey = s.s_suppkey AND a.s_acctbal > 5000
             LEFT JOIN supplier b ON b.s_suppkey = s.s_suppkey AND b.s_acctbal > 2000)
SELECT s_suppkey, iri, coalesce(a_name, lower(b_name), regexp_extract(iri, '([^/]*)$', 1)) AS label, '' AS class_hint,
       CASE WHEN a_name IS NOT NULL AND s_nationkey > 12 THEN 'C4H7O2-' ELSE '' END AS chem_formula, '' AS smiles,
       nullif(mass, 0) AS molecular_weight, cast(1.0 AS DOUBLE) AS default_dose, 'mM' AS dose_unit
FROM j
""")
def enrich_stimulus(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    rows = supplier.select("s_suppkey", F.expr(STIMULUS_ID).alias("id"))
    a = supplier.filter("s_acctbal > 5000").select(
        F.col("s_suppkey").cast("string").alias("chebi_id"),
        F.col("s_name").alias("ascii_name"),
        F.when(F.col("s_nationkey") > 12, F.lit("C4H7O2-")).alias("formula"),
        F.col("s_acctbal").alias("mass"),
    )
    from helixmart.functions.ids import canonical_iri

    named = supplier.filter("s_acctbal > 2000").select(F.expr(STIMULUS_ID).alias("id"), F.lower("s_name").alias("label"))
    b = named.select(canonical_iri(F.col("id")).alias("iri"), "label")
    return _expand(enrich.stimulus(rows, "id", "m", {"a": a, "b": b}), "m", ["s_suppkey"])


@query("""
SELECT o_orderkey, cast(o_custkey AS INTEGER) AS taxon_id, 'NCBITaxon_' || cast(o_custkey AS string) AS taxon_iri,
       coalesce(c.c_name, 'Species_' || cast(o_custkey AS string)) AS species_name,
       coalesce(CASE WHEN c.c_acctbal > 3000 THEN c.c_mktsegment END, 'Strain_' || cast(o_custkey AS string)) AS strain_name
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c.c_custkey
""")
def enrich_microbe(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("id"))
    a = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").cast("int").alias("taxon_id"),
        F.col("c_name").alias("scientific_name"),
        F.when(F.col("c_acctbal") > 3000, F.col("c_mktsegment")).alias("strain"),
    )
    return enrich.microbe(rows, "id", "m", {"a": a}).select(
        "o_orderkey", "m.taxon_id", "m.taxon_iri", "m.species_name", "m.strain_name"
    )


@query("""
SELECT o_orderkey, 'NCBITaxon_' || cast(o_custkey AS string) AS iri, coalesce(n.n_name, 'Bacteria') AS kingdom,
       coalesce(CASE WHEN c.c_acctbal > 3000 THEN 'genus' END, 'species') AS ranking, 'intestine' AS habitat
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c.c_custkey
            LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def enrich_taxon(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("id"))
    customer = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    nation = table(spark, sf_dir, "nation")
    a = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").cast("int").alias("taxon_id"),
        F.col("n_name").alias("division"),
        F.when(F.col("c_acctbal") > 3000, F.lit("genus")).alias("rank"),
    )
    return enrich.taxon(rows, "id", "m", {"a": a}).select("o_orderkey", "m.iri", "m.kingdom", "m.ranking", "m.habitat")


_TERM = f"concat('{OBO}', case p_size % 2 when 0 then 'CL_' else 'UBERON_' end, lpad(cast(p_partkey as string), 7, '0'))"


@query(f"""
WITH v AS (SELECT *, {_TERM} AS iri, p_retailprice > 950 AS found FROM part)
SELECT p_partkey, iri, CASE WHEN found THEN CASE WHEN p_size > 5 THEN p_name END ELSE regexp_extract(iri, '([^/]*)$', 1) END AS label,
       CASE WHEN found THEN 'CL' WHEN contains(iri, 'CL_') THEN 'CL' ELSE 'UBERON' END AS ontology,
       CASE WHEN found AND p_size > 20 THEN split_part(p_name, ' ', 1) ELSE '' END AS term_definition,
       CASE WHEN found THEN cast(to_json([p_brand, p_type]) AS string) ELSE '[]' END AS synonyms,
       CASE WHEN found THEN '' ELSE '2025-06' END AS onto_version
FROM v
""")
def enrich_term(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("iri", F.expr(_TERM))
    a = part.filter("p_retailprice > 950").select(
        "iri",
        F.when(F.col("p_size") > 5, F.col("p_name")).alias("label"),
        F.lit("CL").alias("ontology_prefix"),
        F.when(F.col("p_size") > 20, F.split("p_name", " ")).alias("description"),
        F.array("p_brand", "p_type").alias("synonyms"),
    )
    rows = part.select("p_partkey", F.col("iri").alias("id"))
    return _expand(enrich.ontology_term(rows, "id", "m", {"a": a}), "m", ["p_partkey"])


@query(f"""
WITH v AS (SELECT *, upper(trim({STUDY_ID})) AS acc FROM customer),
k AS (SELECT *, CASE WHEN acc LIKE 'E-MTAB%' AND c_acctbal > 1000 THEN 'a' WHEN acc LIKE 'GSE%' AND c_acctbal > 1000 AND c_mktsegment <> 'BUILDING' THEN 'b' ELSE 'c' END AS src FROM v)
SELECT c_custkey, acc AS iri, CASE src WHEN 'c' THEN 'Synthetic study ' || acc ELSE c_name END AS title,
       CASE src WHEN 'a' THEN 'ArrayExpress' WHEN 'b' THEN 'GEO' ELSE 'LOCAL' END AS source_repo,
       CASE src WHEN 'a' THEN '2024-03-01' WHEN 'b' THEN '' ELSE '{AS_OF}' END AS publication_date,
       'scRNA-seq' AS study_type, CASE src WHEN 'a' THEN c_nationkey WHEN 'b' THEN 0 END AS num_samples,
       CASE src WHEN 'c' THEN lower(acc) || '@example.org' ELSE '' END AS contact_email
FROM k
""")
def enrich_study(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    known = customer.filter("c_acctbal > 1000").withColumn("accession", F.upper(F.trim(F.expr(STUDY_ID))))
    a = known.select("accession", F.col("c_name").alias("title"), F.lit("2024-03-01T00:00").alias("publication_date"), F.col("c_nationkey").alias("samples"))
    b = known.select("accession", F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_name")).alias("title"))
    rows = customer.select("c_custkey", F.expr(STUDY_ID).alias("id"))
    return _expand(enrich.study(rows, "id", "m", {"a": a, "b": b}, as_of=AS_OF), "m", ["c_custkey"])


@query(f"""
WITH v AS (SELECT *, 'SAMP' || lpad(cast(o_orderkey AS string), 8, '0') AS sid, o_orderstatus = 'F' AS found FROM orders)
SELECT sid AS iri, CASE WHEN found THEN 'E-MTAB-' || cast(o_custkey AS string) ELSE 'LOCAL-STUDY' END AS study_iri,
       'CL_0000127' AS cell_type_iri, CASE WHEN found THEN o_orderpriority ELSE 'brain' END AS tissue_label,
       'NCBITaxon_9606' AS organism_iri, 'monoculture' AS growth_condition, 818 AS microbe_taxon_id,
       's3://bucket/' || sid || '.zarr' AS raw_counts_uri,
       CASE WHEN found THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '{AS_OF}' END AS collection_date, 1 AS replicate_number
FROM v
""")
def enrich_sample(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("sample_id", F.expr("concat('SAMP', lpad(cast(o_orderkey as string), 8, '0'))"))
    a = orders.filter("o_orderstatus = 'F'").select(
        "sample_id",
        F.concat(F.lit("E-MTAB-"), F.col("o_custkey").cast("string")).alias("study_iri"),
        F.col("o_orderpriority").alias("tissue_label"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("collection_date"),
    )
    return enrich.sample(orders.select("sample_id"), "sample_id", "m", {"a": a}, as_of=AS_OF).select(
        "m.iri", "m.study_iri", "m.cell_type_iri", "m.tissue_label", "m.organism_iri", "m.growth_condition",
        "m.microbe_taxon_id", "m.raw_counts_uri", "m.collection_date", "m.replicate_number",
    )


@query(f"""
WITH v AS (SELECT *, {TERM_ID} AS id FROM part),
k AS (SELECT *, CASE WHEN id LIKE 'http%' THEN 'CL' WHEN contains(id, ':') THEN split_part(id, ':', 1) END AS prefix FROM v)
SELECT p_partkey,
       CASE WHEN prefix IS NULL THEN NULL WHEN p_size > 30 THEN p_name WHEN p_size > 10 THEN p_brand END AS name,
       CASE WHEN prefix IS NOT NULL AND p_size > 30 THEN split_part(p_name, ' ', 1)
            WHEN contains(id, ':') AND id NOT LIKE 'http%' AND p_size > 20 THEN p_type END AS chem_class,
       CASE WHEN prefix IS NULL THEN NULL WHEN p_size > 30 THEN 'genus' WHEN prefix = 'NCBITaxon' AND p_size > 10 THEN 'strain' END AS ranking
FROM k
""")
def term_labels(spark, sf_dir):
    from helixmart.functions.ids import ontology_id

    part = table(spark, sf_dir, "part").withColumn("id", F.expr(TERM_ID)).withColumn("n", ontology_id(F.col("id")))
    number = F.lpad(F.col("p_partkey").cast("string"), 7, "0")
    by_curie = part.filter("n is not null and p_size > 30").withColumn("curie", F.col("n.curie"))
    by_iri = part.filter("n is not null and p_size > 10").select(F.col("n.iri").alias("iri"), F.col("p_brand").alias("label"))
    out = part.select("p_partkey", "id")
    out = enrich.term_name(out, "id", "name", {"a": by_curie.select("curie", F.col("p_name").alias("label")), "b": by_iri})
    out = enrich.chemical_class(
        out, "id", "chem_class",
        {
            "a": by_curie.select("curie", F.split("p_name", " ").alias("chebi_class")),
            "b": part.filter("p_size > 20").select(number.alias("chebi_id"), F.col("p_type").alias("ascii_name")),
        },
    )
    out = enrich.taxon_rank(
        out, "id", "ranking",
        {
            "a": by_curie.select("curie", F.lit("genus").alias("rank")),
            "b": part.filter("p_size > 10").select(number.alias("taxon_id"), F.lit("strain").alias("rank")),
        },
    )
    return out.drop("id")
