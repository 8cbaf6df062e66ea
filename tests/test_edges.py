"""Rows that must not be lost, doubled or changed on the way."""

import json

import pytest
from pyspark.sql import functions as F

from helixmart.functions.registry import CURRENT
from helixmart.ml import recipes
from helixmart.operators.joins import keep_one, skew_join
from helixmart.operators.profile import category_profile
from helixmart.operators.rules import REJECTED, harmonize, load_rules, split_quarantine
from helixmart.plans import pipeline
from helixmart.sources.matrix_market import read_barcodes, read_matrix_market

GENE_RULE = {"columns": {"g": {"regex": "ENSG.*", "transforms": [], "target_table": "Genes", "target_column": "gene_accession"}}}


def test_first_row_in_file_order_is_kept(spark, tmp_path):
    data, root = tmp_path / "data", str(tmp_path / "root")
    data.mkdir()
    (data / "gene_catalog.tsv").write_text("gene_accession\tgene_name\tgene_length_bp\nENSG1\tTP53\t10\nENSG1\t\t\nENSG2\t\t\nENSG2\tlate\t5\n")
    stats = pipeline.run(spark, str(data), GENE_RULE, root)
    rows = {r["gene_accession"]: (r["gene_name"], r["gene_length_bp"]) for r in spark.read.parquet(f"{root}/Genes").collect()}
    assert stats == {"Genes": 2} and rows == {"ENSG1": ("TP53", 10), "ENSG2": (None, None)}


def test_raw_counts_loaded_twice(spark, tmp_path):
    data, root = tmp_path / "data", str(tmp_path / "root")
    data.mkdir()
    (data / "s1_raw_counts.tsv").write_text("gene_iri\tcount\ng1\t4\n")
    for _ in range(2):
        pipeline.run(spark, str(data), GENE_RULE, root)
    assert spark.read.parquet(f"{root}/counts").count() == 1


def test_envelopes_without_a_key_are_kept_aside(spark, tmp_path):
    lines = [{"table": "Genes", "row": {"gene_accession": "g"}}, {"table": "RawCounts", "row": {"sample_id": "s", "count": "3"}}]
    (tmp_path / "rows.jsonl").write_text("\n".join(map(json.dumps, lines)))
    assert pipeline.load_envelopes(spark, str(tmp_path / "rows.jsonl"), str(tmp_path / "root")) == {"Genes": 1}
    assert spark.read.json(f"{tmp_path}/root/_quarantine/table=RawCounts").count() == 1


def test_keep_one_keeps_rows_with_null_keys_in_one_scan(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string")
    kept = keep_one(df, ["k"], ["v"])
    assert sorted(map(tuple, kept.collect()), key=repr) == [(1, "a"), (None, "c"), (None, "c")]
    assert kept._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1


@pytest.mark.parametrize("how", ["full", "right", "outer"])
def test_salted_joins_refuse_kinds_that_would_repeat_rows(spark, how):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        skew_join(df, df, ["k"], how, salts=3)


def test_salted_join_of_a_hot_key(spark):
    left = spark.range(300).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(0, 300, 2).select(F.col("id").alias("k")).union(spark.createDataFrame([(7,)], "k long"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain, salted = (sorted(map(tuple, skew_join(left, right, ["k"], how, salts=s).collect()), key=repr) for s in (0, 5))
        assert plain == salted


def test_quarantine_without_text_columns_and_with_bad_lookup_ids(spark):
    rules = load_rules(GENE_RULE, CURRENT)
    numbers = spark.createDataFrame([(1,)], "n int")
    clean, rejected = split_quarantine(harmonize(numbers, "Genes", rules, None, "quarantine"))
    assert clean.count() == 1 and rejected.count() == 0
    lookup = {"columns": {"m": {"regex": ".+", "transforms": ["fetch_microbe_metadata"], "target_table": "Microbes", "target_columns": ["taxon_iri", "strain_name"]}}}
    rows = spark.createDataFrame([("562",), ("abc",)], "taxon string")
    clean, rejected = split_quarantine(harmonize(rows, "Microbes", load_rules(lookup, CURRENT), None, "quarantine"))
    assert [r["taxon_iri"] for r in clean.collect()] == ["NCBITaxon_562"]
    assert [(r["taxon"], r[REJECTED]) for r in rejected.collect()] == [("abc", ["m"])]
    with pytest.raises(Exception, match="malformed"):
        harmonize(rows, "Microbes", load_rules(lookup, CURRENT)).collect()


def test_skew_symmetric_and_complex_matrices(spark, tmp_path):
    (tmp_path / "k.mtx").write_text("%%MatrixMarket matrix coordinate real skew-symmetric\n3 3 1\n2 1 5\n")
    assert sorted(map(tuple, read_matrix_market(spark, str(tmp_path / "k.mtx")).collect())) == [(1, 2, -5.0), (2, 1, 5.0)]
    (tmp_path / "c.mtx").write_text("%%MatrixMarket matrix coordinate complex general\n1 1 1\n1 1 5 2\n")
    with pytest.raises(ValueError):
        read_matrix_market(spark, str(tmp_path / "c.mtx"))


def test_labels_of_several_files_are_numbered_by_file(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.tsv").write_text("".join(f"{name}{i}\n" for i in range(3)))
    rows = read_barcodes(spark, str(tmp_path)).collect()
    assert sorted((r["cell_barcode"], r["index"]) for r in rows) == [(f"{n}{i}", i + 1) for n in "ab" for i in range(3)]


def test_profile_shows_a_column_of_nulls(spark):
    df = spark.createDataFrame([("x", None), ("y", None)], "a string, b string")
    got = {r["column"]: (r["n_values"], r["shown_values"]) for r in category_profile(df, ["a", "b"]).collect()}
    assert got == {"a": (2, "x|y"), "b": (0, "")}


def test_models_score_every_row(spark):
    rows = [(i, f"m{i % 4}", float(i % 7), None if i % 6 else ("High" if i % 4 == 0 else "Low")) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, microbe string, score double, label string")
    model = recipes.significance_model(df, ["microbe"], ["score"], "label")
    assert recipes.predict(model, df, ["id"]).count() == 60
    holes = df.select("id", F.when(F.col("id") % 5 > 0, F.col("score")).alias("a"), F.col("id").cast("double").alias("b"))
    assert recipes.principal_components(holes, ["id"], ["a", "b"]).count() == 60
