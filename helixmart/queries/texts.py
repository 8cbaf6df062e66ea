"""Text, list, JSON and record functions over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixmart.functions import records, text, values
from helixmart.queries.base import query, table

# Gives the prose some typographic marks, Greek letters and no-break spaces.
_MARKED = "replace(replace(translate(text, '.,', '·–'), 'on', 'β°'), 'er ', 'Σ ')"
_BLANKS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)"
_TIDY = "replace(replace(translate({0}, '·– ', '.- '), '°', 'deg'), '±', '+/-')"
_SLUG = (
    "nullif(lower(trim(regexp_replace(replace(replace({0}, 'β', 'beta'), 'Σ', 'sigma'), "
    "'[\\x{{09}}-\\x{{0d}}\\x{{1c}}-\\x{{20}}\\x{{85}}\\x{{a0}}]+', ' ', 'g'))), '')"
)


def _marked(spark, sf_dir):
    # A projection of its own, so that the derived text is made once per row.
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(_MARKED).alias("marked"))


@query(f"SELECT doc_id, {_TIDY.format(_MARKED)} AS tidy FROM documents")
def tidy_punct(spark, sf_dir):
    return _marked(spark, sf_dir).select("doc_id", text.tidy_punct(F.col("marked")).alias("tidy"))


@query(f"SELECT doc_id, {_SLUG.format(_MARKED)} AS slug FROM documents")
def ascii_slug(spark, sf_dir):
    return _marked(spark, sf_dir).select("doc_id", text.ascii_slug(F.col("marked")).alias("slug"))


@query(f"""
SELECT doc_id, nullif(lower(trim(regexp_replace(strip_accents({_SLUG.format(_TIDY.format(_MARKED))}),
       '[^\\x{{00}}-\\x{{7F}}]', '', 'g'))), '') AS plain
FROM documents
""")
def lowercase_ascii(spark, sf_dir):
    return _marked(spark, sf_dir).select("doc_id", text.lowercase_ascii(F.col("marked")).alias("plain"))


@query(f"""
SELECT doc_id, array_to_string([trim(t, {_BLANKS}) FOR t IN string_split(text, ',') IF trim(t, {_BLANKS}) <> ''], '|') AS tokens,
       cast(len([t FOR t IN string_split(text, ',') IF trim(t, {_BLANKS}) <> '']) AS INTEGER) AS n_tokens
FROM documents
""")
def split_tokens(spark, sf_dir):
    tokens = values.split_commas(F.col("text"))
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", tokens.alias("t"))
        .select("doc_id", F.array_join("t", "|").alias("tokens"), F.size("t").alias("n_tokens"))
    )


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber,
                  concat('tag', case l_linestatus when 'F' then ':' else ',' end, l_returnflag, ',', cast(l_partkey as string), ',', cast(l_suppkey as string)) AS x
           FROM lineitem)
SELECT l_orderkey, l_linenumber, array_to_string(string_split(regexp_replace(x, '^[^:,]*[:,]', ''), ','), '|') AS payload
FROM v
""")
def split_payload(spark, sf_dir):
    x = F.expr(
        "concat('tag', case l_linestatus when 'F' then ':' else ',' end, l_returnflag, ',', cast(l_partkey as string), ',', cast(l_suppkey as string))"
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array_join(values.split_payload(x), "|").alias("payload")
    )


@query("""
SELECT p_partkey, unnest(string_split(replace(concat(p_name, ' ', p_type), ' ', '|'), '|')) AS go_term FROM part
""")
def go_explode(spark, sf_dir):
    joined = F.expr("replace(concat(p_name, ' ', p_type), ' ', '|')")
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(values.split_go_terms(joined)).alias("go_term"))


@query("""
WITH v AS (SELECT o_orderkey, unnest(string_split(replace(concat(o_orderpriority, ' ; ;', o_orderstatus), '-', ';'), ';')) AS item FROM orders)
SELECT o_orderkey, trim(item) AS item FROM v WHERE trim(item) <> ''
""")
def bridge_rows(spark, sf_dir):
    joined = F.expr("replace(concat(o_orderpriority, ' ; ;', o_orderstatus), '-', ';')")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.explode(values.split_semicolons(joined)).alias("item")
    )


@query("""
SELECT event_id, cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
       coalesce(json_extract_string(props, '$.absent'), event_type) AS label,
       cast(to_json([cast(event_type AS string), cast(user_id AS string)]) AS string) AS list_text
FROM events
""")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        values.json_field(F.col("props"), "$.k").cast("int").alias("k"),
        values.first_filled(values.json_field(F.col("props"), "$.absent"), F.col("event_type")).alias("label"),
        values.json_list(F.array("event_type", F.col("user_id").cast("string"))).alias("list_text"),
    )


@query("""
SELECT o_orderkey, substr(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), 1, 10) AS publication_date FROM orders
""")
def date_prefix(spark, sf_dir):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf_dir, "orders").select("o_orderkey", values.date_prefix(stamp).alias("publication_date"))


_TAIL = "case l_linestatus when 'F' then ',more' else '' end"
_SM = f"concat('sm,SAMP', lpad(cast(l_orderkey as string), 8, '0'), ',NCBITaxon:', cast(l_suppkey as string), ',0.', cast(l_linenumber as string), ',', l_returnflag, {_TAIL})"
_SS = f"concat('ss,SAMP', lpad(cast(l_orderkey as string), 8, '0'), ',CHEBI:', cast(l_suppkey as string), ',', cast(l_linenumber as string), '.5,', l_returnflag, {_TAIL})"
_MS = f"concat('NCBITaxon:', cast(l_partkey as string), ',EFO_', cast(l_suppkey as string), ',0.', cast(l_linenumber as string), ',', l_returnflag, {_TAIL})"
_ES = f"concat('exprstat:SAMP', cast(l_orderkey as string), ',ENSG', lpad(cast(l_partkey as string), 11, '0'), '.2,-', cast(l_linenumber as string), '.25,0.0', cast(l_linenumber as string), ',', cast(l_suppkey as string), '.5,', cast(l_partkey as string), ',', l_returnflag, {_TAIL})"


@query(f"""
WITH v AS (SELECT string_split({_SM}, ',') AS f FROM lineitem)
SELECT CASE WHEN len(f) = 5 THEN f[2] END AS sample_id,
       CASE WHEN len(f) = 5 THEN cast(split_part(f[3], ':', 2) AS INTEGER) END AS microbe_id,
       CASE WHEN len(f) = 5 THEN f[5] END AS evidence,
       CASE WHEN len(f) = 5 THEN cast(f[4] AS DOUBLE) END AS relative_abundance
FROM v
""")
def parse_sample_microbe(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(records.sample_microbe(F.expr(_SM)).alias("r")).select(
        "r.sample_id", "r.microbe_id", "r.evidence", "r.relative_abundance"
    )


@query(f"""
WITH v AS (SELECT string_split({_SS}, ',') AS f FROM lineitem)
SELECT CASE WHEN len(f) = 5 THEN f[2] END AS sample_id,
       CASE WHEN len(f) = 5 THEN replace(f[3], 'CHEBI:', 'http://purl.obolibrary.org/obo/CHEBI_') END AS stimulus_id,
       CASE WHEN len(f) = 5 THEN cast(f[4] AS DOUBLE) END AS exposure_time_hr,
       CASE WHEN len(f) = 5 THEN f[5] END AS response_marker
FROM v
""")
def parse_sample_stimulus(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(records.sample_stimulus(F.expr(_SS)).alias("r")).select(
        "r.sample_id", "r.stimulus_id", "r.exposure_time_hr", "r.response_marker"
    )


@query(f"""
WITH v AS (SELECT string_split({_MS}, ',') AS f FROM lineitem)
SELECT CASE WHEN len(f) = 4 THEN cast(split_part(f[1], ':', 2) AS INTEGER) END AS microbe_id,
       CASE WHEN len(f) = 4 THEN replace(f[2], 'EFO_', 'http://www.ebi.ac.uk/efo/EFO_') END AS stimulus_id,
       CASE WHEN len(f) = 4 THEN f[4] END AS evidence,
       CASE WHEN len(f) = 4 THEN cast(f[3] AS DOUBLE) END AS interaction_score
FROM v
""")
def parse_microbe_stimulus(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(records.microbe_stimulus(F.expr(_MS)).alias("r")).select(
        "r.microbe_id", "r.stimulus_id", "r.evidence", "r.interaction_score"
    )


@query(f"""
WITH v AS (SELECT string_split(split_part({_ES}, ':', 2), ',') AS f FROM lineitem)
SELECT f[1] AS sample_id, split_part(f[2], '.', 1) AS gene_accession, cast(f[3] AS DOUBLE) AS log2_fc,
       cast(f[4] AS DOUBLE) AS p_value, cast(f[5] AS DOUBLE) AS base_mean, cast(f[6] AS BIGINT) AS raw_count,
       f[7] AS significance
FROM v
""")
def parse_expr_stat(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(records.expression_stat(F.expr(_ES)).alias("r")).select("r.*")


_KIND_ID = (
    "case l_linenumber when 1 then concat('ENSG', lpad(cast(l_partkey as string), 11, '0')) "
    "when 2 then concat('CHEBI:', cast(l_suppkey as string)) when 3 then concat('NCBITaxon:', cast(l_suppkey as string)) "
    "when 4 then concat('GSE', cast(l_orderkey as string)) when 5 then concat('SAMP', lpad(cast(l_orderkey as string), 8, '0')) "
    "when 6 then concat('exprstat:', l_returnflag) else concat('NCBITaxon:', cast(l_suppkey as string), ',CHEBI:', cast(l_partkey as string)) end"
)
KINDS = {
    "gene": r"ENS[A-Z]*G\d{5,}",
    "stimulus": r"CHEBI:\d+|EFO:\d+|TNFα|butyrate|none",
    "microbe": r"NCBITaxon:\d+",
    "study": r"E-MTAB-\d+|GSE\d+|LOCAL-[A-Za-z0-9_-]+",
    "sample": r"SAM[END]\d+|SRS\d+|SAMPLE_[A-Za-z0-9_-]+|SAMP[A-Z0-9]{8}",
    "link": r"NCBITaxon:\d+.*(CHEBI:\d+|EFO:\d+)",
    "statistic": r"exprstat:.*",
}
_KIND_CASE = " ".join(f"WHEN regexp_full_match(id, '{regex}') THEN '{kind}'" for kind, regex in KINDS.items())


@query(f"""
WITH v AS (SELECT l_orderkey, l_linenumber, {_KIND_ID} AS id FROM lineitem)
SELECT l_orderkey, l_linenumber, id, CASE {_KIND_CASE} ELSE 'other' END AS kind FROM v
""")
def entity_kind(spark, sf_dir):
    from helixmart.operators.rules import entity_kind as kind_of

    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_KIND_ID).alias("id"))
    return rows.withColumn("kind", kind_of(F.col("id"), KINDS, "other"))


