"""Each stage of the pipeline on a small corpus, and the whole."""

import random
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from helixmart.llm import bpe, toxicity
from helixmart.llm.queries import word_bpe_file
from helixmart.session import scratch_path
from test_text_operators import components_by_force, dedup_by_force, words

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).repartition(3)


def test_near_copies_and_repeats(spark):
    rng = random.Random(21)
    shared = words(rng, 70)
    rows = [(i, f"{words(rng, 30)} {shared if i % 3 == 0 else ''} {words(rng, 30)}") for i in range(30)]
    rows += [(30, rows[4][1]), (31, rows[4][1] + " end"), (32, None), (33, ""), (34, "é" * 80 + shared)]
    path = scratch_path(spark, "pipeline-test")
    STAGES["jaccard_join"](spark, frame(spark, rows), SF_DIR).write.parquet(path)
    kept = spark.read.parquet(path)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = {i for i, _, least in components_by_force(rows, 5, 80) if i == least}
    assert {r["doc_id"] for r in kept.collect()} == want
    cut = STAGES["suffix_dedup"](spark, kept, SF_DIR).collect()
    left = [(i, t) for i, t in rows if i in want]
    bytes_left = {i: n - gone for i, n, gone, *_ in dedup_by_force(left)}
    for r in cut:
        assert r["text"] is None if r["doc_id"] == 32 else len(r["text"].encode()) in (bytes_left[r["doc_id"]], bytes_left[r["doc_id"]] - 1)
        assert r["n_chars"] == len(r["text"] or "")
    assert sum(shared in (r["text"] or "") for r in cut) == 1


def test_replacement_characters_of_a_text_stay(spark):
    shared = words(random.Random(4), 50)
    rows = [(1, "a " + shared + "é end"), (2, "b \ufffd one " + shared + "è two \ufffd"), (3, "no cut \ufffd")]
    cut = {r["doc_id"]: r["text"] for r in STAGES["suffix_dedup"](spark, frame(spark, rows), SF_DIR).collect()}
    assert cut == {1: rows[0][1], 2: "b \ufffd one two \ufffd", 3: rows[2][1]}


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")
def test_whole_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, labels).collect()}
    assert all(scores[i] < 0.5 for i in rows)
    clean = {r["doc_id"]: r["text"] for r in docs.collect() if scores[r["doc_id"]] < 0.5}
    left = {i for i, _, least in components_by_force(sorted(clean.items()), 5, 80) if i == least}
    assert set(rows) <= left and len(rows) >= 0.8 * len(left)
    vocab = bpe.vocabulary(word_bpe_file())
    untouched = [i for i in rows if rows[i]["n_tokens"] and vocab.encode(clean[i]) == b"".join(x.to_bytes(4, "little") for x in rows[i]["ids"])]
    assert len(untouched) > 0.5 * len(rows)


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")
def test_contract_columns(spark):
    want = {
        "op2_": "doc_id n_bytes n_removed n_spans kept_sha256", "op3_": "doc_id held_out score predicted", "op4_": "page_id url text n_chars", "op5_": "page_id payload_bytes payload_digest record_type refers_to",
        "op6_": "doc_id n_shingles component_id", "op7_": "doc_id n_tokens ids_sha256 decoded_sha256", "op8_": "doc_id held_out lang_pred score", "op9_": "query_id rank vec_id score",
        "op10_": "doc_id size text_crc32 law shard slot grown_shard",
    }
    for name, fn in entry.queries().items():
        for start, columns in want.items():
            if name.startswith(start):
                assert set(columns.split()) <= set(fn(spark, SF_DIR).columns), name
