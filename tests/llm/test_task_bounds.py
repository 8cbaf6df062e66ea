"""What a task holds at a time is bounded, and results stay whole."""

import random
import types

import pyarrow as pa
from pyspark.sql import types as T

from helixmart.llm import bpe, common, jaccard, toxicity
from helixmart.llm.queries import word_bpe_file
from test_text_operators import components_by_force, words


def test_regions_are_dealt_by_their_rows(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, words(rng, 30)) for i in range(40)]
    rows += [(40 + i, rows[i][1] + " end") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    parts, dealt = [], jaccard._dealt

    def spy(regions, n):
        out = dealt(regions, n)
        parts.append((regions.count(), n, out.rdd.getNumPartitions()))
        return out

    monkeypatch.setattr(jaccard, "TASK_ROWS", 10)
    monkeypatch.setattr(jaccard, "_dealt", spy)
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs, k=3, percent=80).collect())
    assert found == sorted(components_by_force(rows, 3, 80))
    ((seen, counted, n),) = parts
    assert seen == counted and n == -(-seen // 10) > 4


def test_texts_go_to_toxicity_workers_in_small_batches(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"words {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    name, seen, settle = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, toxicity.settle

    def spy(df, label, *more):
        seen[label] = int(spark.conf.get(name))
        return settle(df, label, *more)

    before = spark.conf.get(name)
    monkeypatch.setattr(toxicity, "settle", spy)
    assert toxicity.score(docs, labels).count() == 20
    assert seen["toxicity-counts"] <= 1000
    assert spark.conf.get(name) == before


def held_mb() -> float:
    with open("/proc/self/status") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("RssAnon")) / 1024


def test_a_task_gives_back_what_it_took():
    pins = []

    def run(batches):
        for batch in batches:
            taken = [bytes(1000) for _ in range(200_000)]
            pins.extend(taken[::20_000])  # what stays on top of the heap keeps the C library from giving back the rest
            pins.append(bytes(1000))
            del taken
            yield batch

    batch = pa.RecordBatch.from_arrays([pa.array([1])], names=["id"])
    before = held_mb()
    assert [b.num_rows for b in common.lean(run)(iter([batch]))] == [1]
    assert held_mb() - before < 100


def test_a_worker_forgets_the_tables_of_other_operators():
    # A table that hands out the function it would send to the workers.
    texts = types.SimpleNamespace(schema={"id": types.SimpleNamespace(dataType=T.LongType())}, mapInArrow=lambda run, schema: run)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([b"three words here"])], names=["id", "text"])
    bpe.vocabulary(word_bpe_file()).encode("words")
    bpe.offset_table(word_bpe_file())
    (out,) = jaccard._sets(texts, 3)(iter([batch]))
    assert out.column("n_shingles").to_pylist() == [1]
    assert bpe.vocabulary.cache_info().currsize == bpe.offset_table.cache_info().currsize == 0


def test_a_worker_keeps_the_tables_of_its_operator():
    vocabulary = bpe.vocabulary(word_bpe_file())
    kept = common.lean(lambda batches: batches, bpe.__name__)
    assert list(kept(iter([]))) == []
    assert bpe.vocabulary(word_bpe_file()) is vocabulary


def test_pairs_of_tokens_are_remembered_up_to_a_bound(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdefghijkl", k=9)) for _ in range(300)]
    expected = list(map(bpe.Vocabulary(word_bpe_file()).encode, texts))
    monkeypatch.setattr(bpe, "MOST_PAIRS", 50)
    vocabulary = bpe.Vocabulary(word_bpe_file())
    assert list(map(vocabulary.encode, texts)) == expected
    assert len(vocabulary.fits) < 200
