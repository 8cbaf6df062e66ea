"""Attribute-value staging, set operations, profiles, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixmart.functions.registry import LEGACY
from helixmart.operators import sampling
from helixmart.operators.eav import (
    column_rules, harmonize_items, longest_column, mapped_columns, staged_sizes, staged_values, to_items, zip_columns,
)
from helixmart.operators.integrity import split_valid
from helixmart.operators.profile import approximate_profile, category_profile
from helixmart.queries.base import query, table
from helixmart.sources.catalog import in_load_order, is_raw_like, only_loadable, route_files

MAPPING = {
    "columns": {
        "obs.p_name": {"target_table": "Stimuli", "target_column": "label", "transforms": ["shout"]},
        "obs.p_brand": {"target_table": "Genes", "target_column": "gene_id", "transforms": []},
        "var.p_type": {"target_table": "Genes", "target_column": "gene_name", "transforms": ["unknown_name"]},
        "obs.p_size": {"target_table": "Genes", "target_column": "a", "transforms": []},
        "var.p_size": {"target_table": "Genes", "target_column": "b", "transforms": []},
        "sdrf.s_name": {"target_table": "Stimuli", "target_column": "label", "transforms": ["shout"]},
    }
}
_REGISTRY = LEGACY.extended(shout=F.upper)


def _items(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_name", F.when(F.col("p_size") > 3, F.col("p_brand")).alias("p_brand"), "p_type", "p_size"
    )
    supplier = table(spark, sf_dir, "supplier").select("s_name")
    return to_items(part).unionAll(to_items(supplier))


@query("""
SELECT 'p_name' AS "column", p_name AS value FROM part
UNION ALL SELECT 'p_brand', CASE WHEN p_size > 3 THEN p_brand END FROM part
UNION ALL SELECT 'p_type', p_type FROM part
UNION ALL SELECT 'p_size', cast(p_size AS string) FROM part
UNION ALL SELECT 's_name', s_name FROM supplier
""")
def unpivot_eav(spark, sf_dir):
    return _items(spark, sf_dir)


@query("""
SELECT p_brand, p_type FROM part
""")
def mapped_column_scan(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = mapped_columns(part.columns, "obs", MAPPING, skip={"p_name", "p_size"})
    names += mapped_columns(part.columns, "var", MAPPING, skip={"p_size"})
    return part.select(*names)


_HARMONISED = """
SELECT 'Stimuli' AS target_table, 'label' AS target_column, upper(p_name) AS value FROM part
UNION ALL SELECT 'Genes', 'gene_id', CASE WHEN p_size > 3 THEN p_brand END FROM part
UNION ALL SELECT 'Genes', 'gene_name', p_type FROM part
UNION ALL SELECT 'Stimuli', 'label', upper(s_name) FROM supplier
"""


@query(_HARMONISED)
def unique_suffix(spark, sf_dir):
    # p_size has two owners in the mapping, so its items are dropped.
    assert "p_size" not in column_rules(MAPPING)
    return harmonize_items(_items(spark, sf_dir), MAPPING, _REGISTRY)


@query(f"SELECT DISTINCT target_table, target_column, value FROM ({_HARMONISED})")
def staged_sets(spark, sf_dir):
    return staged_values(harmonize_items(_items(spark, sf_dir), MAPPING, _REGISTRY))


@query(f"""
SELECT target_table, target_column, count(*) AS n_values, max(CASE WHEN value IS NULL THEN 1 ELSE 0 END) = 1 AS has_null
FROM (SELECT DISTINCT target_table, target_column, value FROM ({_HARMONISED})) GROUP BY 1, 2
""")
def staged_set_sizes(spark, sf_dir):
    return staged_sizes(staged_values(harmonize_items(_items(spark, sf_dir), MAPPING, _REGISTRY)))


@query(f"""
SELECT target_table, max(n) AS n_rows FROM (
  SELECT target_table, target_column, count(*) AS n
  FROM (SELECT DISTINCT target_table, target_column, value FROM ({_HARMONISED})) GROUP BY 1, 2) GROUP BY 1
""")
def staged_longest_column(spark, sf_dir):
    return longest_column(staged_values(harmonize_items(_items(spark, sf_dir), MAPPING, _REGISTRY)))


@query("""
WITH a AS (SELECT v, row_number() OVER (ORDER BY md5(v), v) AS n FROM (SELECT DISTINCT c_name AS v FROM customer)),
     b AS (SELECT v, row_number() OVER (ORDER BY md5(v), v) AS n FROM (SELECT DISTINCT s_name AS v FROM supplier)),
     c AS (SELECT v, row_number() OVER (ORDER BY md5(v), v) AS n FROM (SELECT DISTINCT p_name AS v FROM part))
SELECT coalesce(a.n, b.n, c.n) AS n, a.v AS title, b.v AS source_repo, c.v AS contact_email
FROM a FULL JOIN b ON a.n = b.n FULL JOIN c ON coalesce(a.n, b.n) = c.n
""")
def zip_column_sets(spark, sf_dir):
    def values_of(name, column, target):
        return table(spark, sf_dir, name).select(
            F.lit("Studies").alias("target_table"), F.lit(target).alias("target_column"), F.col(column).alias("value")
        )

    staged = staged_values(
        values_of("customer", "c_name", "title"),
        values_of("supplier", "s_name", "source_repo"),
        values_of("part", "p_name", "contact_email"),
    )
    return zip_columns(staged, "Studies", ["title", "source_repo", "contact_email"])


@query("""
SELECT p_name AS v FROM part WHERE p_size <= 30 UNION SELECT p_name FROM part WHERE p_size >= 20
""")
def set_union(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_name").alias("v"), "p_size")
    return sampling.set_union(part.filter("p_size <= 30").select("v"), part.filter("p_size >= 20").select("v"))


@query("""
SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
""")
def set_except(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), "o_orderstatus")
    return sampling.set_minus(
        orders.filter("o_orderstatus = 'F'").select("k"), orders.filter("o_orderstatus = 'P'").select("k")
    )


_NAMES = (
    "concat(case o_orderkey % 13 when 0 then 'gene_catalog' when 1 then 'taxa_catalog' when 2 then 'microbe_catalog' "
    "when 3 then 'stimulus_catalog' when 4 then 'ontology_terms' when 5 then 'study_catalog' when 6 then 'sample_microbe' "
    "when 7 then 'sample_stimulus' when 8 then 'microbe_stimulus' when 9 then concat('experiment_', cast(o_custkey as string)) "
    "when 10 then concat('S', cast(o_custkey as string), '_raw_counts') when 11 then '.hidden' else 'study.IDF' end, '.tsv')"
)
_ROUTED = f"""
WITH v AS (SELECT o_orderkey, {_NAMES} AS name FROM orders),
r AS (SELECT o_orderkey, name,
  CASE WHEN contains(name, 'gene_catalog.tsv') THEN 'Genes' WHEN contains(name, 'taxa_catalog.tsv') THEN 'Taxa'
       WHEN contains(name, 'microbe_catalog.tsv') THEN 'Microbes' WHEN contains(name, 'stimulus_catalog.tsv') THEN 'Stimuli'
       WHEN contains(name, 'ontology_terms.tsv') THEN 'OntologyTerms' WHEN contains(name, 'study_catalog.tsv') THEN 'Studies'
       WHEN contains(name, 'sample_microbe.tsv') THEN 'SampleMicrobe' WHEN contains(name, 'sample_stimulus.tsv') THEN 'SampleStimulus'
       WHEN contains(name, 'microbe_stimulus.tsv') THEN 'MicrobeStimulus' WHEN contains(name, 'experiment_') THEN 'Samples'
       WHEN contains(name, '_raw_counts.tsv') THEN 'RawCounts' END AS "table"
  FROM v)
SELECT o_orderkey, name, "table",
  CASE "table" WHEN 'Stimuli' THEN 1 WHEN 'Taxa' THEN 2 WHEN 'OntologyTerms' THEN 3 WHEN 'Studies' THEN 4 WHEN 'Microbes' THEN 5
       WHEN 'Genes' THEN 6 WHEN 'Samples' THEN 7 WHEN 'ExpressionStats' THEN 8 WHEN 'SampleMicrobe' THEN 9
       WHEN 'SampleStimulus' THEN 9 WHEN 'MicrobeStimulus' THEN 9 ELSE 100 END AS priority
FROM r
"""


def _files(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_NAMES).alias("name"))


@query(_ROUTED)
def route_files_in_order(spark, sf_dir):
    return in_load_order(route_files(_files(spark, sf_dir)), "name")


@query(f"SELECT * FROM ({_ROUTED}) WHERE name LIKE '%\\_raw\\_counts.tsv' ESCAPE '\\'")
def mode_raw_counts(spark, sf_dir):
    return route_files(_files(spark, sf_dir), "raw_counts")


@query(f"SELECT * FROM ({_ROUTED}) WHERE \"table\" IS NOT NULL AND \"table\" <> 'RawCounts'")
def loadable_files(spark, sf_dir):
    return only_loadable(route_files(_files(spark, sf_dir)))


@query(f"""
WITH v AS (SELECT o_orderkey, {_NAMES} AS name FROM orders)
SELECT o_orderkey, name FROM v WHERE NOT regexp_matches(lower(name), 'raw|count|idf') AND name NOT LIKE '.%'
""")
def attribute_files(spark, sf_dir):
    return _files(spark, sf_dir).filter(~is_raw_like(F.col("name")) & ~F.col("name").startswith("."))


@query("""
SELECT 'p_brand' AS "column", p_brand AS value FROM part WHERE p_size > 3
""")
def clean_filter(spark, sf_dir):
    items = _items(spark, sf_dir).filter("column = 'p_brand'")
    kept, _ = split_valid(items, F.col("value").isNotNull() & F.col("column").isNotNull())
    return kept


def _profile_sql(source: str, columns: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_values, count(DISTINCT {c}) < 30 AS complete, "
        f"array_to_string(CASE WHEN count(DISTINCT {c}) < 30 THEN list_sort(list(DISTINCT {c})) "
        f"ELSE list_slice(list_sort(list(DISTINCT {c})), 1, 10) END, '|') AS shown_values FROM {source}"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


@query(_profile_sql("part", ["p_name", "p_brand", "p_type"]))
def category_profile_genes(spark, sf_dir):
    return category_profile(table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"])


_ORDER_TEXT = "(SELECT o_orderstatus, o_orderpriority, cast(o_custkey AS string) AS o_custkey FROM orders)"


@query(_profile_sql(_ORDER_TEXT, ["o_orderstatus", "o_orderpriority", "o_custkey"]))
def category_profile_samples(spark, sf_dir):
    return category_profile(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query()
def category_profile_approximate(spark, sf_dir):
    return approximate_profile(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey", "l_orderkey"])


@query("""
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5
""")
def head_k(spark, sf_dir):
    return sampling.head(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"), ["o_orderdate", "o_orderkey"]
    )


@query("""
SELECT o_orderkey, o_orderpriority FROM orders
ORDER BY md5('42' || chr(31) || cast(o_orderkey AS string)), o_orderkey LIMIT 5
""")
def sample_k(spark, sf_dir):
    return sampling.seeded_sample(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderkey"], 42
    )
