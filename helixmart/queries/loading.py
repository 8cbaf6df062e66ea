"""Keyed loads, referential checks, audits, star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixmart.operators.integrity import content_audit, digest_audit, merge_audits, orphans, rows_per_table, with_parent
from helixmart.plans import star
from helixmart.plans.schemas import TABLES
from helixmart.queries.base import query, table
from helixmart.session import scratch_path
from helixmart.sinks import export, merge
from helixmart.sources.tsv import ORDER, read_tsv
from helixmart.streaming.ingest import ingest_envelopes, ingest_routed, load_envelopes_batch, stream_envelopes, stream_files

_EXISTING = "SELECT c_custkey AS sample_id, c_name AS label, cast(NULL AS string) AS day FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')"
_FIRST = """
SELECT sample_id, label, day FROM (
  SELECT o_custkey AS sample_id, o_orderpriority AS label, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderpriority) AS r
  FROM orders) WHERE r = 1
"""


def _incoming(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("sample_id"),
        F.col("o_orderpriority").alias("label"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )


def _existing(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.col("c_custkey").alias("sample_id"), F.col("c_name").alias("label"), F.lit(None).cast("string").alias("day")
    )


@query(f"""
WITH t AS ({_EXISTING}), n AS ({_FIRST})
SELECT * FROM t UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.sample_id = n.sample_id)
""")
def insert_ignore(spark, sf_dir):
    path = scratch_path(spark, "samples")
    _existing(spark, sf_dir).write.parquet(path)
    incoming = _incoming(spark, sf_dir)
    merge.insert_ignore(incoming, path, ["sample_id"], ["day"])
    return merge.read_target(spark, path, incoming.schema)


@query(f"""
WITH t AS ({_EXISTING}), n AS ({_FIRST})
SELECT 'Samples' AS "table", count(*) AS n_rows FROM n WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.sample_id = n.sample_id)
UNION ALL SELECT 'Studies', count(*) FROM customer
""")
def insert_stats(spark, sf_dir):
    fresh = merge.new_rows(_incoming(spark, sf_dir), _existing(spark, sf_dir), ["sample_id"], ["day"])
    return rows_per_table({"Samples": fresh, "Studies": table(spark, sf_dir, "customer")})


_LAST = """
SELECT o_custkey AS c_custkey, o_totalprice AS c_acctbal, o_orderpriority AS c_mktsegment FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderpriority DESC) AS r
  FROM orders WHERE o_orderstatus = 'F') WHERE r = 1
"""


@query(f"""
WITH n AS ({_LAST})
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer c WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.c_custkey = c.c_custkey)
UNION ALL
SELECT n.c_custkey, c.c_name, n.c_acctbal, n.c_mktsegment FROM n LEFT JOIN customer c ON n.c_custkey = c.c_custkey
""")
def upsert(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "studies")
    # The table is in hash buckets: the upsert reads and writes those of the changed keys.
    merge.upsert(customer, path, ["c_custkey"], buckets=8)
    changes = (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus = 'F'")
        .select(
            F.col("o_custkey").alias("c_custkey"),
            F.col("o_totalprice").alias("c_acctbal"),
            F.col("o_orderpriority").alias("c_mktsegment"),
            F.col("o_orderdate").alias("_at"),
        )
    )
    # The order column only picks the last row; it is not part of the table.
    last = merge.keep_one(changes, ["c_custkey"], ["_at"], last=True).drop("_at")
    merge.upsert(last, path, ["c_custkey"], schema=customer.schema)
    return merge.read_target(spark, path, customer.schema)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 40)
""")
def orphan_rows(spark, sf_dir):
    child = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return orphans(child, table(spark, sf_dir, "part").filter("p_size <= 40"), {"l_partkey": "p_partkey"}).select(
        *child.columns
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 40)
""")
def valid_rows(spark, sf_dir):
    child = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return with_parent(child, table(spark, sf_dir, "part").filter("p_size <= 40"), {"l_partkey": "p_partkey"}).select(
        *child.columns
    )


@query("""
SELECT l_returnflag AS source, count(*) AS n_rows, cast(sum(l_partkey) AS BIGINT) AS key_sum FROM lineitem GROUP BY 1
""")
def audit_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_partkey")
    counts = content_audit(rows, F.col("l_returnflag")).drop("checksum")
    sums = rows.groupBy(F.col("l_returnflag").alias("source")).agg(F.sum("l_partkey").alias("key_sum"))
    return counts.join(sums, "source")


@query()
def audit_checksum(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return content_audit(rows, F.col("l_returnflag"))


_EXACT = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("""
WITH t AS (SELECT l_returnflag AS source, md5(list_aggregate(list_transform([
        cast(l_orderkey AS string), cast(l_partkey AS string), cast(l_linenumber AS string),
        cast(cast(l_quantity AS DECIMAL(18, 4)) AS string), cast(cast(l_extendedprice AS DECIMAL(18, 4)) AS string),
        cast(cast(l_discount AS DECIMAL(18, 4)) AS string), cast(cast(l_tax AS DECIMAL(18, 4)) AS string), l_returnflag, l_linestatus],
        lambda x: chr(31) || coalesce(x, chr(0))), 'string_agg', '')) AS h FROM lineitem)
SELECT source, count(*) AS n_rows, cast(sum(cast('0x' || h[1:15] AS HUGEINT)) AS string) AS digest_a,
       cast(sum(cast('0x' || h[16:30] AS HUGEINT)) AS string) AS digest_b
FROM t GROUP BY 1
""")
def audit_digest(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", *[F.col(c).cast("decimal(18,4)").alias(c) for c in _EXACT], "l_returnflag", "l_linestatus"
    )
    # An audit for each batch, then one of all batches.
    batches = digest_audit(rows, F.concat_ws("/", "l_returnflag", F.col("l_linenumber").cast("string")))
    return merge_audits(batches.withColumn("source", F.substring_index("source", "/", 1)))


_DIM = """
SELECT row_number() OVER (ORDER BY md5(c_name), c_name) AS study_key, c_name, c_mktsegment FROM customer
"""


@query(_DIM)
def dimension_keys(spark, sf_dir):
    return star.dimension(table(spark, sf_dir, "customer"), "c_name", ["c_mktsegment"], "study_key")


@query("""
WITH s AS (SELECT c_name, c_mktsegment FROM customer WHERE c_acctbal > 3000),
     d AS (SELECT row_number() OVER (ORDER BY md5(c_name), c_name) AS study_key, * FROM s)
SELECT (SELECT count(*) FROM d) + row_number() OVER (ORDER BY md5(c_name), c_name) AS study_key, c_name, c_mktsegment
FROM customer WHERE NOT c_acctbal > 3000
""")
def dimension_increment(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    stored = star.dimension(customer.filter("c_acctbal > 3000"), "c_name", ["c_mktsegment"], "study_key")
    return star.extend_dimension(stored, customer, "c_name", ["c_mktsegment"], "study_key")


_DIM_GENE = "SELECT row_number() OVER (ORDER BY md5(cast(p_partkey AS string))) AS gene_key, p_partkey AS l_partkey FROM part WHERE p_size <= 45"
_DIM_STIM = "SELECT row_number() OVER (ORDER BY md5(cast(s_suppkey AS string))) AS stimulus_key, s_suppkey AS l_suppkey FROM supplier"


@query(f"""
WITH g AS ({_DIM_GENE}), s AS ({_DIM_STIM})
SELECT gene_key, stimulus_key, l_quantity, l_discount
FROM lineitem LEFT JOIN g USING (l_partkey) LEFT JOIN s USING (l_suppkey)
""")
def fact_star(spark, sf_dir):
    part = table(spark, sf_dir, "part").filter("p_size <= 45").withColumnRenamed("p_partkey", "l_partkey")
    supplier = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    genes = star.dimension(part, "l_partkey", ["p_brand"], "gene_key")
    stimuli = star.dimension(supplier, "l_suppkey", ["s_name"], "stimulus_key")
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_discount")
    return star.fact(
        rows, [(genes, "l_partkey", "gene_key"), (stimuli, "l_suppkey", "stimulus_key")], ["l_quantity", "l_discount"]
    )


@query("""
SELECT count(*) AS n_rows, count(DISTINCT o_orderdate) AS n_batches FROM orders
""")
def run_totals(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderdate").alias("n_batches")
    )


@query("""
SELECT concat('ENSG', lpad(cast(p_partkey AS varchar), 11, '0')) AS gene_accession, concat('gene ', p_name) AS gene_name,
       p_size AS gene_length_bp FROM part
""")
def load_keep_first(spark, sf_dir):
    """A full row, then a row of the same key without values: the first in file order stays."""
    full = table(spark, sf_dir, "part").select(
        F.concat(F.lit("ENSG"), F.lpad(F.col("p_partkey").cast("string"), 11, "0")).alias("gene_accession"),
        F.concat(F.lit("gene "), F.col("p_name")).alias("gene_name"),
        F.col("p_size").cast("string").alias("gene_length_bp"),
    )
    both = full.withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1))))
    both = both.withColumns({c: F.when(F.col("turn") == 0, F.col(c)) for c in ("gene_name", "gene_length_bp")})
    folder, path = scratch_path(spark, "genes-tsv"), scratch_path(spark, "genes")
    rows = both.repartition(4, "gene_accession").sortWithinPartitions("turn", "gene_accession").drop("turn")
    rows.write.option("sep", "\t").option("header", True).csv(folder)
    scan = read_tsv(spark, [folder], "\t".join(full.columns), with_order=True)
    scan = scan.withColumn("gene_length_bp", F.col("gene_length_bp").cast("int"))
    merge.insert_ignore(scan, path, ["gene_accession"], [ORDER], transient=[ORDER])
    return spark.read.parquet(path)


@query("""
SELECT concat('S', cast(l_suppkey % 20 AS varchar)) AS sample_id, concat('G', cast(l_partkey % 50 AS varchar)) AS gene_iri,
       cast(sum(l_quantity) AS bigint) AS "count" FROM lineitem GROUP BY 1, 2
""")
def raw_counts_twice(spark, sf_dir):
    """Loading the same samples again replaces them."""
    counts = table(spark, sf_dir, "lineitem").groupBy(
        F.concat(F.lit("S"), (F.col("l_suppkey") % 20).cast("string")).alias("sample_id"),
        F.concat(F.lit("G"), (F.col("l_partkey") % 50).cast("string")).alias("gene_iri"),
    ).agg(F.sum("l_quantity").cast("bigint").alias("count"))
    path = scratch_path(spark, "counts")
    for _ in range(2):
        export.write_raw_counts(counts, path)
    return spark.read.schema("gene_iri string, count bigint, sample_id string").parquet(path).select("sample_id", "gene_iri", "count")


@query("""
SELECT CASE c_custkey % 3 WHEN 0 THEN 'Studies' WHEN 1 THEN 'RawCounts' ELSE 'Nowhere' END AS "table", count(*) AS n_rows
FROM customer GROUP BY 1
""")
def envelopes_quarantine(spark, sf_dir):
    """A stream of envelopes: rows of unrouted tables are kept aside, not lost."""
    kind = F.when(F.col("c_custkey") % 3 == 0, "Studies").when(F.col("c_custkey") % 3 == 1, "RawCounts").otherwise("Nowhere")
    envelopes = table(spark, sf_dir, "customer").select(
        kind.alias("table"), F.create_map(F.lit("iri"), F.col("c_custkey").cast("string"), F.lit("title"), F.col("c_name")).alias("row")
    )
    folder, root, checkpoint = (scratch_path(spark, x) for x in ("envelopes", "envelope-root", "envelope-checkpoint"))
    envelopes.write.json(folder)
    ingest_envelopes(stream_envelopes(spark, folder), root, checkpoint).awaitTermination()
    kept = spark.read.schema("row string, table string").json(f"{root}/_quarantine").groupBy("table").agg(F.count("*").alias("n_rows"))
    return rows_per_table({"Studies": spark.read.parquet(f"{root}/Studies")}).unionByName(kept)


@query("""
WITH r AS (
  SELECT CASE c_custkey % 3 WHEN 0 THEN 'Studies' WHEN 1 THEN 'RawCounts' ELSE 'Nowhere' END AS "table", c_custkey % 7 AS part, cast(c_nationkey AS string) AS iri
  FROM customer
)
SELECT "table", iri, 1::BIGINT AS n_rows FROM r WHERE "table" = 'Studies' GROUP BY ALL
UNION ALL SELECT "table", NULL, cast(count(*) + count(*) FILTER (part < 3) AS BIGINT) FROM r WHERE "table" <> 'Studies' GROUP BY 1
""")
def stream_replay(spark, sf_dir):
    """Batches that run again, in any order, leave the same rows in the tables and in quarantine."""
    kind = F.when(F.col("c_custkey") % 3 == 0, "Studies").when(F.col("c_custkey") % 3 == 1, "RawCounts").otherwise("Nowhere")
    customer = table(spark, sf_dir, "customer").select(
        kind.alias("table"), F.create_map(F.lit("iri"), F.col("c_nationkey").cast("string"), F.lit("title"), F.col("c_name")).alias("row"),
        (F.col("c_custkey") % 7).alias("part"),
    )
    root = scratch_path(spark, "replayed")
    batches = {"a-0": customer.where("part < 3").drop("part"), "a-1": customer.drop("part")}
    for name in ("a-0", "a-0", "a-1", "a-1", "a-0"):
        load_envelopes_batch(batches[name], name, root, {"Studies": ["iri"]})
    studies = merge.read_target(spark, f"{root}/Studies", TABLES["Studies"])
    kept = spark.read.schema("row string, table string").json(f"{root}/_quarantine").groupBy("table").agg(F.count("*").alias("n_rows"))
    stored = studies.groupBy("iri").agg(F.count("*").alias("n_rows")).select(F.lit("Studies").alias("table"), "iri", "n_rows")
    return stored.unionByName(kept.select("table", F.lit(None).cast("string").alias("iri"), "n_rows"))


def _tsv_files(rows, folder, name):
    """Write ``rows`` as TSV files whose names contain ``name``, into ``folder``."""
    spark, parts = rows.sparkSession, scratch_path(rows.sparkSession, "parts")
    rows.write.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(parts)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs = path_of(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path_of(folder))
    found = sorted(s.getPath().getName() for s in fs.listStatus(path_of(parts)))
    for i, part in enumerate(p for p in found if p.startswith("part-")):
        fs.rename(path_of(f"{parts}/{part}"), path_of(f"{folder}/{name.format(i)}"))


_ROUTED_RULES = {
    "columns": {
        "gene": {"regex": "ENS.*", "transforms": ["strip_version"], "target_table": "Genes", "target_column": "gene_accession"},
    }
}


@query("""
SELECT 'Genes' AS "table", 'ENSG' || lpad(cast(p_partkey AS string), 8, '0') AS id, CASE WHEN p_partkey % 3 <> 0 THEN p_name ELSE p_brand END AS label FROM part
UNION ALL SELECT 'Studies', 'E-' || cast(c_custkey AS string), c_name FROM customer
UNION ALL SELECT 'Samples', cast(s_suppkey AS string), 'gut ' || s_name FROM supplier
""")
def stream_routed_tsv(spark, sf_dir):
    """Files of three tables and different headers arrive in two turns; each file is loaded once, the first row of a key stays."""
    accession = F.concat(F.lit("ENSG"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"))
    part, incoming, root, checkpoint = table(spark, sf_dir, "part"), *(scratch_path(spark, x) for x in ("incoming", "routed-root", "routed-checkpoint"))
    for turn in range(3):
        if turn == 0:
            first = part.where("p_partkey % 3 <> 0").select(F.concat(accession, F.lit(".2")).alias("gene_accession"), F.col("p_name").alias("gene_name"))
            _tsv_files(first, incoming, "{}_gene_catalog.tsv")
            customer = table(spark, sf_dir, "customer")
            _tsv_files(customer.select(F.col("c_name").alias("title"), F.expr("concat('E-', cast(c_custkey as string))").alias("iri")), f"{incoming}/sub", "{}_study_catalog.tsv")
        elif turn == 1:
            _tsv_files(part.select(F.col("p_brand").alias("gene_name"), accession.alias("gene_accession")), incoming, "later_{}_gene_catalog.tsv")
            _tsv_files(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("iri"), F.concat(F.lit("gut "), "s_name").alias("tissue_iri")), incoming, "experiment_{}.tsv")
        ingest_routed(stream_files(spark, incoming), _ROUTED_RULES, root, checkpoint).awaitTermination()
    shown = {"Genes": ("gene_accession", "gene_name"), "Studies": ("iri", "title"), "Samples": ("iri", "tissue_iri")}
    parts = [
        merge.read_target(spark, f"{root}/{t}", TABLES[t]).select(F.lit(t).alias("table"), F.col(key).alias("id"), F.col(label).alias("label"))
        for t, (key, label) in shown.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
