"""The registered queries of this subpackage, op1 to op13, and their SQL twins where SQL can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixmart.llm import additive, bpe, centroids, decontaminate, jaccard, langid, middle, pages, sharding, suffixes, topk, toxicity, warc
from helixmart.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe_file() -> str:
    """The public tokenizer file, which is installed on every worker; HELIXMART_WORD_BPE names another place."""
    if path := os.environ.get("HELIXMART_WORD_BPE"):
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.dedup(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_boosted_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op5_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.archive(table(spark, sf_dir, "pages"), path)
    return warc.replay(spark, path)


@query
def op6_jaccard_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op7_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), word_bpe_file())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op8_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_held_out(table(spark, sf_dir, "documents"))


@query
def op9_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op10_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query
def op11_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_centroid_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query
def op13_counted_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = middle.restore(middle.transform(table(spark, sf_dir, "documents")))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return coded.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output").alias("output_sha256"), digest("restored").alias("restored_sha256"))


ORACLES["op9_maxscore_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

# Five rounds, each a step of its own: a vector's nearest centroid by unnested components, then floors of the means.
_ROUND = """
d{i} AS MATERIALIZED (
  SELECT v.row, c.k, CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
  FROM v, c{i} c
), a{i} AS MATERIALIZED (
  SELECT row, k, distance FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY distance, k) AS r FROM d{i}) WHERE r = 1
)"""
_MOVE = """
s{i} AS (
  SELECT a.k, p.i, sum(v.v[p.i]) AS s, count(*) AS n
  FROM a{i} a JOIN v USING (row), (SELECT unnest(range(1, 65)) AS i) p GROUP BY ALL
), m{i} AS (
  SELECT k, list(CAST((s - ((s % n) + n) % n) / n AS BIGINT) ORDER BY i) AS v FROM s{i} GROUP BY k
), c{j} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (k)
)"""
ORACLES["op12_centroid_expressions"] = (
    """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT k - 1 AS k, v FROM (
    SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) AS k, v FROM v
  ) WHERE k <= 40
), """
    + ", ".join(_ROUND.format(i=i) + ", " + _MOVE.format(i=i, j=i + 1) for i in range(5))
    + ", "
    + _ROUND.format(i=5)
    + """
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, a.distance,
  CAST(sum(a.distance) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a5 a JOIN v USING (row) JOIN c5 c USING (k)
"""
)

ORACLES["op13_counted_middle"] = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT *, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS units FROM t
), d AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS e1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS e2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, array_to_string(list_slice(units, 1, least(e1, e2)), '') AS prefix,
    array_to_string(list_slice(units, least(e1, e2) + 1, greatest(e1, e2)), '') AS middle,
    array_to_string(list_slice(units, greatest(e1, e2) + 1, n), '') AS suffix
  FROM d
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
