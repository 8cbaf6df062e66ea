"""Scans of files that Spark writes from the test tables, and the incremental feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixmart.operators.align import align
from helixmart.plans.schemas import TABLES
from helixmart.queries.base import GENE_ID, query, table
from helixmart.session import scratch_path
from helixmart.sinks.merge import read_target
from helixmart.sources import annotated, envelope, sdrf
from helixmart.sources.catalog import discover_files
from helixmart.sources.tsv import read_attribute_tsv, read_tsv_files, sample_of_file
from helixmart.streaming.ingest import ingest, stream_parquet


@query("""
SELECT cast(doc_id AS string) AS doc_id, replace(replace(text, chr(10), ' '), chr(9), ' ') AS title, lang, source FROM documents
""")
def tsv_scan(spark, sf_dir):
    folder = scratch_path(spark, "tsv")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.translate("text", "\n\t", "  ").alias("title"), "lang", "source"
    )
    rows.write.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return read_tsv_files(discover_files(spark, folder, (".csv",)))


_BROKEN = "replace(substr(text, 1, 300), ' ', chr(10)) || chr(9) || '\"' || lang || '\"'"


@query(f"""
SELECT cast(doc_id AS string) AS doc_id, CASE WHEN doc_id % 3 = 0 THEN {_BROKEN} ELSE replace(replace(text, chr(10), ' '), chr(9), ' ') END AS title,
       source, lang
FROM documents
""")
def tsv_multi_line(spark, sf_dir):
    # Every third row has a cell with line breaks, tabs and doubled quotes, and files have many splits.
    folder = scratch_path(spark, "tsv")
    broken = F.expr(_BROKEN.replace("||", " || "))
    plain = F.translate("text", "\n\t", "  ")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, broken).otherwise(plain).alias("title"), "source", "lang")
    rows.write.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return read_tsv_files(discover_files(spark, folder, (".csv",)))


def _write_lines(lines, folder, header):
    """Text lines under a header line, cell separators as they are."""
    lines.select(lines[0].alias(header)).write.option("header", True).option("sep", "\x01").option("quote", "").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(folder)


@query("""
SELECT cast(o_orderkey AS string) AS iri, nullif(CASE o_orderstatus WHEN 'P' THEN 'NA' ELSE o_orderpriority END, 'NA') AS label,
       CASE WHEN o_orderstatus <> 'O' THEN cast(o_custkey AS string) END AS study
FROM orders WHERE o_orderpriority <> '1-URGENT'
""")
def attribute_tsv_scan(spark, sf_dir):
    # Missing-value texts, short lines (status O) and lines with a cell too many (urgent ones).
    folder = scratch_path(spark, "attributes")
    cells = F.concat_ws(
        "\t",
        F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_orderpriority")),
        F.when((F.col("o_orderstatus") != "O") | (F.col("o_orderpriority") == "1-URGENT"), F.col("o_custkey").cast("string")),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("extra")),
    )
    header = "iri\tlabel\tstudy"
    _write_lines(table(spark, sf_dir, "orders").select(cells), folder, header)
    return read_attribute_tsv(spark, folder, header)


@query("""
SELECT 'E-1' AS study, 'ERR' || cast(user_id AS string) AS run, min(props) FILTER (event_type = 'click') AS cell_type,
       min(props) FILTER (event_type = 'view') AS growth,
       min('iri/' || cast(event_id AS string)) FILTER (event_type = 'click') AS cell_type_iri, cast(NULL AS string) AS growth_iri
FROM events WHERE value > 5 GROUP BY 2
""")
def condensed_sdrf_scan(spark, sf_dir):
    folder = scratch_path(spark, "sdrf")
    line = F.concat_ws(
        "\t",
        F.lit("E-1"),
        F.lit(""),
        F.concat(F.lit("ERR"), F.col("user_id").cast("string")),
        F.when(F.col("value") > 5, "characteristic").otherwise("factor"),
        F.when(F.col("event_type") == "click", "cell type").when(F.col("event_type") == "view", "growth condition").otherwise(F.col("event_type")),
        F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('""')), F.lit('"')),
        F.when(F.col("event_type") == "click", F.concat(F.lit("iri/"), F.col("event_id").cast("string"))),
    )
    table(spark, sf_dir, "events").select(line).write.text(folder)
    names = {"cell type": "cell_type", "growth condition": "growth"}
    return sdrf.characteristics_wide(sdrf.read_condensed(spark, folder), names)


@query("""
SELECT 'G' || cast(l_partkey AS string) AS gene_id, p_name AS gene_name, 'run_' || lower(l_returnflag) AS run,
       cast(sum(l_quantity) AS BIGINT) AS count
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
""")
def wide_counts_scan(spark, sf_dir):
    runs = {"A": "run_a", "N": "run_n", "R": "run_r"}
    sums = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        *[F.sum(F.when(F.col("l_returnflag") == k, F.col("l_quantity"))).cast("bigint").alias(n) for k, n in runs.items()]
    )
    wide = table(spark, sf_dir, "part").join(sums, F.col("p_partkey") == F.col("l_partkey")).select(
        F.concat(F.lit("G"), F.col("l_partkey").cast("string")).alias("Gene ID"), F.col("p_name").alias("Gene Name"), *runs.values()
    )
    folder = scratch_path(spark, "wide")
    wide.write.option("sep", "\t").option("header", True).csv(folder)
    return sdrf.read_wide_counts(spark, folder, "\t".join(wide.columns)).filter("count is not null")


@query("""
SELECT 'E-' || cast(c_custkey AS string) AS iri, c_name AS title, cast(NULL AS string) AS source_repo, cast(NULL AS DATE) AS publication_date,
       cast(NULL AS string) AS study_type, cast(c_nationkey AS INTEGER) AS num_samples, cast(NULL AS string) AS contact_email
FROM customer
""")
def envelope_split(spark, sf_dir):
    def wrapped(name, target, **columns):
        row = F.create_map(*[x for k, c in columns.items() for x in (F.lit(k), F.expr(c))])
        return table(spark, sf_dir, name).select(F.lit(target).alias("table"), row.alias("row"))

    both = wrapped(
        "customer", "Studies", iri="concat('E-', cast(c_custkey as string))", title="c_name", num_samples="cast(c_nationkey as string)"
    ).unionAll(wrapped("supplier", "Stimuli", iri="cast(s_suppkey as string)", label="s_name"))
    folder = scratch_path(spark, "envelopes")
    both.write.json(folder)
    # The lines are parsed once, whatever the number of tables; a table's rows are read from its own folder.
    routed = envelope.split_by_table(envelope.read_envelopes(spark, folder), scratch_path(spark, "routed"))
    rows = envelope.rows_of(routed, "Studies", TABLES["Studies"].names)
    return align(rows, TABLES["Studies"])


def _store(spark, sf_dir):
    store = scratch_path(spark, "store")
    table(spark, sf_dir, "part").select(
        F.expr(GENE_ID).alias("gene_id"), F.col("p_name").alias("feature_name"), "p_size"
    ).write.parquet(f"{store}/var")
    table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sample_id"), F.col("o_orderpriority").alias("cell_type"), F.lit(0).alias("counts")
    ).write.parquet(f"{store}/obs")
    return store


_STORE_MAPPING = {
    "columns": {
        name: {"target_table": "Genes", "target_column": "x"}
        for name in ("var.gene_id", "obs.cell_type", "obs.counts", "obs.sample_id")
    }
}


@query(f"""
SELECT 'gene_id' AS "column", {GENE_ID} AS value FROM part
UNION ALL SELECT 'sample_id', cast(o_orderkey AS string) FROM orders
UNION ALL SELECT 'cell_type', o_orderpriority FROM orders
""")
def annotated_items(spark, sf_dir):
    return annotated.mapped_items(spark, _store(spark, sf_dir), _STORE_MAPPING)


@query("""
SELECT 'zarr_uri' AS "column", 'atlas.zarr#obs/' || cast(o_orderkey AS string) AS value FROM orders
""")
def raw_count_uris(spark, sf_dir):
    return annotated.raw_count_uris(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_id")), "atlas.zarr"
    )


@query("""
SELECT trim(split_part(p_name, '.', 1)) AS gene_name FROM part
""")
def gene_list(spark, sf_dir):
    return annotated.gene_list(spark, [_store(spark, sf_dir)])


@query(f"SELECT {GENE_ID} AS gene_iri, p_name AS gene_name FROM part")
def gene_catalogue(spark, sf_dir):
    genes = table(spark, sf_dir, "part").select(
        F.expr(GENE_ID).alias("gene_accession"), F.col("p_name").alias("gene_name"), "p_size"
    )
    return annotated.gene_catalogue(genes)


_FEED_RULES = {
    "columns": {
        "kind": {"regex": "error|signup", "transforms": ["strip_version", "loud"], "target_table": "Feed", "target_column": "event_type"}
    }
}


@query("""
SELECT event_id, user_id, CASE WHEN event_type IN ('error', 'signup') THEN upper(event_type) ELSE event_type END AS event_type, value
FROM events
""")
def stream_ingest(spark, sf_dir):
    from pyspark.sql.types import StructType

    from helixmart.functions.registry import CURRENT
    from helixmart.operators.rules import load_rules

    target = StructType.fromDDL("event_id bigint, user_id bigint, event_type string, value double")
    source = table(spark, sf_dir, "events")
    stream = stream_parquet(spark, sf_dir, source.schema, "events.parquet")
    path, checkpoint = scratch_path(spark, "feed"), scratch_path(spark, "feed-checkpoint")
    rules = load_rules(_FEED_RULES, CURRENT.extended(loud=F.upper))
    ingest(stream, "Feed", rules, path, checkpoint, ["event_id"], target).awaitTermination()
    return read_target(spark, path, target)


_COUNT_FILES = "c_name || CASE c_custkey % 3 WHEN 0 THEN '_raw_counts.tsv' WHEN 1 THEN '.tsv' ELSE '_raw_counts.tsv.gz' END"


@query(f"SELECT c_custkey, replace(regexp_replace({_COUNT_FILES}, '\\.tsv$', ''), '_raw_counts', '') AS sample_id FROM customer")
def sample_from_file_name(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_COUNT_FILES).alias("name"))
    return names.select("c_custkey", sample_of_file(F.col("name")).alias("sample_id"))
