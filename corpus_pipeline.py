"""The corpus pipeline: documents go through the stages in order, each written as Parquet before the next.

A stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its decisions take effect in
what it returns. All but the last return the columns of ``documents``. Rows that repeat an id are one document:
they stay or go together. Since a stage's rows are written before the next begins, the next deletes the
intermediate tables of the stages before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixmart.llm import bpe, decontaminate, jaccard, suffixes, toxicity
from helixmart.llm.common import forget, sweep
from helixmart.llm.queries import word_bpe_file
from helixmart.session import scratch_path


def _without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """``docs`` without the ids in ``bad``; rows without an id stay."""
    gone = bad.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go; learned from all labels."""
    forget()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without(docs, toxicity.score(docs, labels).where("score >= 0.5"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of 5-word-shingle sets linked by a Jaccard similarity of 0.8 or more, the smallest id stays."""
    sweep(spark)
    classes = jaccard.jaccard_components(docs, k=5, percent=80)
    return _without(docs, classes.where("component_id <> doc_id"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 100-byte strings that also start earlier are cut out of the texts; characters cut in half go, too.

    NULL texts stay NULL, and n_chars is counted anew where bytes went.
    """
    sweep(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    was_null = docs.withColumn("_null", F.col("text").isNull())
    cut = suffixes.dedup(was_null, keep=[*others, "_null"], characters=True)
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    cut = cut.withColumn("text", F.when(~F.col("_null"), text))
    if "n_chars" in others:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, word for word or re-parameterised, go."""
    sweep(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left, and digests of the ids and of the text decoded from them."""
    # This stage's job is the caller's, so the bound on a batch of texts for Python stays set.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(suffixes.BATCH))
    coded = bpe.round_trip(docs, word_bpe_file(), keep=["lang", "source"])
    return coded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]

# Votes of a classifier, suffix sorting and a tokenizer are no SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
