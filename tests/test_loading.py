import json

import pytest
from pyspark.sql import functions as F

from conftest import bag
from helixmart.operators.integrity import content_audit, digest_audit, merge_audits, orphans, require, split_valid, with_parent
from helixmart.operators.joins import attach, attach_guarded, heavy_keys, keep_one, skew_join
from helixmart.operators.rules import load_rules
from helixmart.plans import pipeline, star
from helixmart.plans.schemas import KEYS, TABLES
from helixmart.session import scratch_path
from helixmart.sinks import export, merge
from helixmart.streaming import ingest as streaming

MAPPING = {
    "columns": {
        "gene_entry": {
            "regex": r"ENS[A-Z]*G\d{5,}(\.\d+)?", "transforms": ["strip_version"],
            "target_table": "Genes", "target_column": "gene_accession",
        }
    }
}
GENES = "gene_accession\tgene_name\tspecies_taxon_iri\tgene_length_bp\tgc_content\tpathway_iri\tgo_terms\n"
STUDIES = "iri\ttitle\tsource_repo\tpublication_date\tstudy_type\tnum_samples\tcontact_email\n"


def raw_folder(tmp_path):
    files = {
        "gene_catalog.tsv": GENES + "ENSG00001.2\tA\tNCBITaxon_9606\t100\t41.5\tKEGG:1\tGO:1|GO:2\nENSG00001.3\tB\t\t\t\t\t\nENSG00002\tC\t\t7\t\t\t\n",
        "study_catalog.tsv": STUDIES + "E-1\tT\tGEO\t2024-01-02\tscRNA-seq\t5\tx@y\n",
        "sub/experiment_E-1.tsv": "iri\tstudy_iri\tcollection_date\tdonor_age_years\nSAMP1\tE-1\t2024-02-03\t44\n",
        "sub/SAMP1_raw_counts.tsv": "gene_iri\tcount\nENSG00001\t5\n",
        "notes.tsv": "a\nb\n",
    }
    for name, body in files.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)
    return str(tmp_path / "raw")


def test_pipeline_end_to_end_and_again(spark, tmp_path):
    data, root = raw_folder(tmp_path), str(tmp_path / "db")
    stats = pipeline.run(spark, data, MAPPING, root, audit=True)
    assert stats == {"Studies": 1, "Genes": 2, "Samples": 1}
    assert list(stats) == ["Studies", "Genes", "Samples"]
    genes = merge.read_target(spark, f"{root}/Genes", TABLES["Genes"])
    assert bag(genes.select("gene_accession", "gene_name", "gene_length_bp")) == [("ENSG00001", "A", 100), ("ENSG00002", "C", 7)]
    assert bag(spark.read.parquet(f"{root}/counts").select("sample_id", "gene_iri", "count")) == [("SAMP1", "ENSG00001", 5)]
    audit = spark.read.parquet(f"{root}/_audit")
    assert bag(audit.select("source", "n_rows")) == [("Genes", 3), ("Samples", 1), ("Studies", 1)]
    again = pipeline.run(spark, data, MAPPING, root, mode="metadata")
    assert again == {"Studies": 0, "Genes": 0, "Samples": 0}


def test_pipeline_modes(spark, tmp_path):
    data = raw_folder(tmp_path)
    assert pipeline.run(spark, data, MAPPING, str(tmp_path / "a"), mode="raw_counts") == {}
    assert merge.path_exists(spark, str(tmp_path / "a/counts"))
    pipeline.run(spark, data, MAPPING, str(tmp_path / "b"), mode="metadata")
    assert not merge.path_exists(spark, str(tmp_path / "b/counts"))


def test_pipeline_quarantine(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "experiment_1.tsv").write_text("iri\tdonor_age_years\nSAMPAAAA1111\tten\nSAMPbad\t1\n")
    mapping = {"columns": {"s": {"regex": "SAMP.*", "transforms": ["extract_sample_id"], "target_table": "Samples", "target_column": "iri"}}}
    stats = pipeline.run(spark, str(folder), mapping, str(tmp_path / "db"), on_error="quarantine")
    assert stats == {"Samples": 1}
    kept = merge.read_target(spark, str(tmp_path / "db/Samples"), TABLES["Samples"])
    assert bag(kept.select("iri", "donor_age_years")) == [("SAMPAAAA1111", None)]
    assert bag(spark.read.parquet(str(tmp_path / "db/_quarantine/Samples")).select("_rejected")) == [(["s"],)]


def test_envelope_load(spark, tmp_path):
    lines = [
        {"table": "Genes", "row": {"gene_accession": "E1", "gene_length_bp": 5, "unknown": 1}},
        {"table": "Genes", "row": {"gene_accession": "E1"}},
        {"table": "Taxa", "row": {"iri": "T", "ranking": "Species"}},
        {"table": "Taxa", "row": {"iri": "T", "ranking": "Strain"}},
    ]
    (tmp_path / "r.jsonl").write_text("\n".join(json.dumps(x) for x in lines))
    assert pipeline.load_envelopes(spark, str(tmp_path / "r.jsonl"), str(tmp_path / "db")) == {"Genes": 1, "Taxa": 2}
    (tmp_path / "bad.jsonl").write_text('{"table":"Nope","row":{}}')
    with pytest.raises(ValueError, match="Nope"):
        pipeline.load_envelopes(spark, str(tmp_path / "bad.jsonl"), str(tmp_path / "db"))


def test_insert_ignore_is_idempotent_and_keeps_first(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3), (None, "n", 1), (None, "n", 1)], "k int, v string, o int")
    assert merge.insert_ignore(rows, path, ["k"], ["o"]) == 4
    assert bag(spark.read.parquet(path).filter("k is not null")) == [(1, "a", 1), (2, "c", 3)]
    assert merge.insert_ignore(rows.filter("k is not null"), path, ["k"], ["o"]) == 0
    more = spark.createDataFrame([(2, "x", 9), (3, "y", 9)], "k int, v string, o int")
    assert merge.insert_ignore(more, path, ["k"], prune_target=True) == 1
    assert bag(spark.read.parquet(path).filter("k >= 2")) == [(2, "c", 3), (3, "y", 9)]


def test_upsert_replaces_whole_rows_nulls_included(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep")], "k int, v string, w string")
    assert merge.upsert(first, path, ["k"]) == 2
    change = spark.createDataFrame([(2, None), (3, "c"), (3, "d")], "k int, v string")
    assert merge.upsert(change, path, ["k"], schema=first.schema) == 3
    assert bag(spark.read.parquet(path)) == [(1, "a", "keep"), (2, None, "keep"), (3, "d", None)]
    assert not merge.path_exists(spark, path + merge.STAGED) and not merge.path_exists(spark, path + merge.PREVIOUS)


@pytest.mark.parametrize("complete", [True, False])
def test_interrupted_swap_is_recovered(spark, tmp_path, complete):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "old")], "k int, v string")
    old.write.parquet(path + merge.PREVIOUS)
    spark.createDataFrame([(1, "new")], "k int, v string").write.parquet(path + merge.STAGED)
    if not complete:
        (tmp_path / ("t" + merge.STAGED) / "_SUCCESS").unlink()
    assert merge.read_target(spark, path, old.schema).first()["v"] == ("new" if complete else "old")


def test_keep_one_last_and_ties(spark):
    rows = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c")], "k string, o int, v string")
    assert bag(keep_one(rows, ["k"], ["o"])) == [("k", 1, "a")]
    assert bag(keep_one(rows, ["k"], ["o"], last=True)) == [("k", 2, "c")]
    assert bag(keep_one(rows.select("k"), ["k"])) == [("k",)]


def test_salted_join_equals_plain_join(spark):
    left = spark.range(600).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("same").alias("v"))
    right = spark.createDataFrame([(7, "hot"), (10, "cold"), (10, "two")], "k long, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert bag(skew_join(left, right, ["k"], how, salts=5)) == bag(skew_join(left, right, ["k"], how)), how


def test_attach_takes_one_row_per_key(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    ref = spark.createDataFrame([("1", "b"), ("1", "a"), (None, "z")], "id string, v string")
    got = attach(df, F.col("k"), [(ref, "id string, v string, absent int", "m")])
    assert sorted(((r["k"], r["m"] and tuple(r["m"])) for r in got.collect()), key=repr) == sorted([(1, ("1", "a", None)), (None, None)], key=repr)


def test_orphans_and_valid_rows_partition_the_child(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "k int, v string")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    assert bag(orphans(child, parent, {"k": "id"}).select("v")) == [("b",), ("c",)]
    assert bag(with_parent(child, parent, {"k": "id"}).select("v")) == [("a",), ("d",)]


def test_require_and_split(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    good, bad = split_valid(df, F.col("v") == "a")
    assert bag(good) == [("a",)] and bag(bad) == [(None,)]
    assert require(good, F.col("v") == "a", "no").count() == 1
    with pytest.raises(Exception, match="no such"):
        require(df, F.col("v") == "a", "no such").collect()


def test_checksum_sees_copies_and_ignores_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "k int, v string")
    assert bag(content_audit(a, "s")) == bag(content_audit(b, "s"))
    doubled = content_audit(a.unionAll(a), "s").first()
    assert doubled["n_rows"] == 4 and int(doubled["checksum"]) == 2 * int(content_audit(a, "s").first()["checksum"])


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("c1", 4)], "cell string, A int")
    export.write_csv(df, str(tmp_path / "csv"))
    written = [p.read_text() for p in (tmp_path / "csv").glob("*.csv")]
    assert "cell,A\nc1,4\n" in written
    export.write_if_absent(df, str(tmp_path / "p"))
    export.write_if_absent(df.unionAll(df), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1
    staged = spark.createDataFrame([("T", "c", "v"), ("T", "c", None)], "target_table string, target_column string, value string")
    export.write_staged_json(staged, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_star_schema(spark):
    genes = spark.createDataFrame([("E1", "a"), ("E2", "b"), ("E1", "a")], "gene string, name string")
    dim = star.dimension(genes, "gene", ["name"], "gene_key")
    assert sorted(r["gene_key"] for r in dim.collect()) == [1, 2]
    more = star.extend_dimension(dim, spark.createDataFrame([("E1", "z"), ("E3", "c")], "gene string, name string"), "gene", ["name"], "gene_key")
    assert bag(more) == [(3, "E3", "c")]
    fact = star.fact(spark.createDataFrame([("E1", 5), ("E9", 6)], "gene string, m int"), [(dim, "gene", "gene_key")], ["m"])
    keys = {r["gene"]: r["gene_key"] for r in dim.collect()}
    assert bag(fact) == sorted([(keys["E1"], 5), (None, 6)], key=repr)


def test_stream_equals_batch(spark, tmp_path):
    data, rules = tmp_path / "in", load_rules(MAPPING)
    data.mkdir()
    header = "gene_accession\tgene_name"
    path, checkpoint = str(tmp_path / "Genes"), scratch_path(spark, "cp")
    counts = []

    def once():
        stream = streaming.stream_tsv(spark, str(data), header, files_per_batch=1)
        streaming.ingest(stream, "Genes", rules, path, checkpoint, on_inserted=lambda b, n: counts.append(n)).awaitTermination()

    (data / "g1.tsv").write_text(header + "\nENSG00001.1\tA\nENSG00002.1\tB\n")
    once()
    (data / "g2.tsv").write_text(header + "\nENSG00002.7\tB2\nENSG00003.1\tC\n")
    once()
    once()
    assert counts == [2, 1]
    got = merge.read_target(spark, path, TABLES["Genes"]).select("gene_accession", "gene_name")
    assert bag(got) == [("ENSG00001", "A"), ("ENSG00002", "B"), ("ENSG00003", "C")]


def test_envelope_stream(spark, tmp_path):
    data = tmp_path / "in"
    data.mkdir()
    (data / "a.jsonl").write_text('{"table":"Genes","row":{"gene_accession":"E1"}}\n{"table":"Taxa","row":{"iri":"T"}}\n')
    stream = streaming.stream_envelopes(spark, str(data))
    keys = {"Taxa": ["iri"], "Genes": ["gene_accession"]}
    streaming.ingest_envelopes(stream, str(tmp_path / "db"), scratch_path(spark, "cp"), keys).awaitTermination()
    assert merge.read_target(spark, str(tmp_path / "db/Genes"), TABLES["Genes"]).count() == 1
    assert set(KEYS) <= set(TABLES)


def test_routed_stream_equals_batch_load_and_takes_later_files_once(spark, tmp_path):
    data, batch, live = raw_folder(tmp_path), str(tmp_path / "batch"), str(tmp_path / "live")
    expected = pipeline.run(spark, data, MAPPING, batch)
    checkpoint, loaded = scratch_path(spark, "cp"), []

    def once():
        stream = streaming.stream_files(spark, data)
        streaming.ingest_routed(stream, MAPPING, live, checkpoint, on_loaded=lambda _, stats: loaded.append(stats)).awaitTermination()

    once()
    assert loaded == [expected]
    for table in expected:
        assert bag(merge.read_target(spark, f"{live}/{table}", TABLES[table])) == bag(merge.read_target(spark, f"{batch}/{table}", TABLES[table]))
    assert bag(spark.read.parquet(f"{live}/counts")) == bag(spark.read.parquet(f"{batch}/counts"))
    (tmp_path / "raw" / "later_gene_catalog.tsv").write_text('gene_name\tgene_accession\n"late\nline"\tENSG00003\nagain\tENSG00001.9\n')
    once()
    once()
    assert loaded == [expected, {"Genes": 1}]
    genes = merge.read_target(spark, f"{live}/Genes", TABLES["Genes"]).select("gene_accession", "gene_name")
    assert bag(genes) == [("ENSG00001", "A"), ("ENSG00002", "C"), ("ENSG00003", "late\nline")]


def test_routed_stream_keeps_rejected_rows_of_a_batch_once(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "experiment_1.tsv").write_text("iri\tdonor_age_years\nSAMPAAAA1111\tten\nSAMPbad\t1\n")
    mapping = {"columns": {"s": {"regex": "SAMP.*", "transforms": ["extract_sample_id"], "target_table": "Samples", "target_column": "iri"}}}
    root = str(tmp_path / "db")
    for _ in range(2):  # the second checkpoint is lost: the batch's name is the same, and it runs again
        checkpoint = tmp_path / "cp"
        streaming.ingest_routed(streaming.stream_files(spark, str(folder)), mapping, root, str(checkpoint), on_error="quarantine").awaitTermination()
        checkpoint.rename(tmp_path / f"lost{len(list(tmp_path.iterdir()))}")
        assert spark.read.parquet(f"{root}/_quarantine/Samples").count() == 1
        assert merge.read_target(spark, f"{root}/Samples", TABLES["Samples"]).count() == 1


def test_heavy_keys_are_those_of_many_rows(spark):
    df = spark.range(6000).selectExpr("CASE WHEN id % 6 < 3 THEN NULL WHEN id % 6 < 5 THEN 'hot' ELSE cast(id AS string) END AS k")
    assert heavy_keys(df, "k", 16) == ["hot"]
    assert heavy_keys(df.where("k is null"), "k", 16) == []
    assert heavy_keys(df.limit(0), "k", 16) == []


def test_lookup_of_heavy_and_null_keys_is_even(spark):
    df = spark.range(12000).selectExpr("id", "CASE WHEN id % 6 < 3 THEN NULL WHEN id % 6 < 5 THEN 'hot' ELSE cast(id AS string) END AS k").repartition(7, "id")
    ref = spark.createDataFrame([("hot", "x"), ("5", "y"), ("5", "z"), (None, "n"), ("unseen", "u")], "id string, v string")
    schema = "id string, v string, absent int"
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = attach(df, F.col("k"), [(ref, schema, "m")], salts=64)
        sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
        rows = bag(got.select("id", "k", "m.v"))
        plain = bag(attach(df, F.col("k"), [(ref, schema, "m")]).select("id", "k", "m.v"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and sizes[-1] < 3 * sizes[4]
    one = {None: None, "hot": "x", "5": "y"}
    expected = sorted((i, k, one.get(k)) for i in range(12000) for k in [None if i % 6 < 3 else "hot" if i % 6 < 5 else str(i)])
    assert sorted(map(tuple, rows), key=lambda r: r[0]) == expected
    assert sorted(map(tuple, plain), key=lambda r: r[0]) == expected


def test_guarded_lookups_are_one_join(spark):
    df = spark.createDataFrame([("E1",), ("G1",), ("E2",), ("X",), (None,), ("G1",)], "k string")
    a = spark.createDataFrame([("E1", "a"), ("G1", "wrong table"), ("E1", "b")], "id string, v string")
    b = spark.createDataFrame([("G1", 5), ("E2", 6)], "id string, w int")
    keys = [F.when(F.col("k").startswith(p), F.col("k")) for p in "EG"]
    for salts in (0, 4):
        got = attach_guarded(df, [(keys[0], a, "id string, v string", "x"), (keys[1], b, "id string, w int", "y")], salts)
        assert got.columns == ["k", "x", "y"]
        expected = [("E1", "a", None), ("E2", None, None), ("G1", None, 5), ("G1", None, 5), ("X", None, None), (None, None, None)]
        assert sorted(map(tuple, got.select("k", "x.v", "y.w").collect()), key=repr) == sorted(expected, key=repr)
        assert got._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1
    none = attach_guarded(df, [(keys[0], None, "id string, v string", "x"), (keys[1], b, "id string, w int", "y")])
    assert none.where("x is not null").count() == 0 and none.where("y.w = 5").count() == 2


def test_digests_of_batches_add_up(spark):
    import hashlib

    rows = [(1, "a"), (1, "a"), (2, None), (3, "\x1fb")]
    df = spark.createDataFrame(rows, "n int, `t.x` string")
    whole = digest_audit(df, "s").collect()
    hashes = [hashlib.md5("".join("\x1f" + ("\0" if c is None else str(c)) for c in r).encode()).hexdigest() for r in rows]
    assert [tuple(r) for r in whole] == [("s", 4, str(sum(int(h[:15], 16) for h in hashes)), str(sum(int(h[15:30], 16) for h in hashes)))]
    parts = digest_audit(df.where("n = 1"), "s").unionAll(digest_audit(df.where("n > 1"), "s"))
    assert merge_audits(parts).collect() == whole
    assert digest_audit(df.limit(0), "s").count() == 0
    # Moving a value to the next column shows.
    moved = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert len({r["digest_a"] for r in digest_audit(moved, F.coalesce("x", F.lit("z"))).collect()}) == 2
