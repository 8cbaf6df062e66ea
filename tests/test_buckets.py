"""Bucketed upserts and batches with an index of keys."""

import json
import random

import pytest
from conftest import bag
from pyspark.sql import functions as F

from helixmart.plans.schemas import TABLES
from helixmart.sinks import buckets, merge
from helixmart.streaming.ingest import load_envelopes_batch

ROWS = "k long, v string, w string"


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in sorted(path.rglob("*.parquet"))}


def bucket_folder(spark, key, n):
    row = spark.createDataFrame([(key,)], "k long").select(buckets.bucket_of(["k"], n)).first()
    return f"_bucket={row[0]}/"


def test_upsert_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    path = tmp_path / "t"
    first = spark.createDataFrame([(i, f"v{i}", "keep") for i in range(500)], ROWS)
    assert merge.upsert(first, str(path), ["k"], buckets=16) == 500
    before = files_of(path)
    assert len(before) == 16
    change = spark.createDataFrame([(7, "new"), (7, "newer"), (9999, "more")], "k long, v string")
    assert merge.upsert(change, str(path), ["k"], schema=first.schema) == 501
    after = files_of(path)
    hit = {bucket_folder(spark, 7, 16), bucket_folder(spark, 9999, 16)}
    assert {f: t for f, t in after.items() if not any(h in f for h in hit)} == {f: t for f, t in before.items() if not any(h in f for h in hit)}
    got = {r["k"]: (r["v"], r["w"]) for r in merge.read_target(spark, str(path), first.schema).collect()}
    assert got[7] == ("newer", "keep") and got[9999] == ("more", None) and got[8] == ("v8", "keep") and len(got) == 501


def test_random_upserts_equal_a_dictionary(spark, tmp_path):
    rng, path, expected, nulls = random.Random(4), str(tmp_path / "t"), {}, 0
    for turn in range(4):
        rows = [(rng.choice([None, *range(30)]), rng.randrange(100), f"{turn}-{i}") for i in range(40)]
        rows += [(3, rng.randrange(100), f"{turn}-hot-{i}") for i in range(60)]  # one key with most rows
        df = spark.createDataFrame(rows, "k long, o int, v string")
        merge.upsert(df, path, ["k"], ["o"], buckets=5)
        for k, o, v in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1], r[2])):
            expected[k] = (o, v)
        nulls += sum(r[0] is None for r in rows)
    got = merge.read_target(spark, path, df.schema).collect()
    assert {r["k"]: (r["o"], r["v"]) for r in got if r["k"] is not None} == expected
    assert sum(r["k"] is None for r in got) == nulls and len(got) == nulls + len(expected)


def test_a_plain_table_becomes_bucketed_and_keys_must_agree(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, "a", "b") for i in range(20)], ROWS)
    merge.upsert(rows, path, ["k"])
    assert buckets.read_layout(spark, path) is None
    merge.upsert(rows.limit(0), path, ["k"], buckets=4)
    assert buckets.read_layout(spark, path) == {"buckets": 4, "keys": ["k"]}
    assert bag(merge.read_target(spark, path, rows.schema)) == bag(rows)
    assert merge.upsert(rows.limit(0), path, ["k"]) == 20
    with pytest.raises(ValueError):
        merge.upsert(rows, path, ["v"])


@pytest.mark.parametrize("complete", [True, False])
def test_interrupted_swap_of_buckets(spark, tmp_path, complete):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, "old", "x") for i in range(50)], ROWS)
    merge.upsert(rows, path, ["k"], buckets=4)
    new = rows.withColumn("v", F.lit("new")).withColumn(buckets.BUCKET, buckets.bucket_of(["k"], 4))
    new.write.partitionBy(buckets.BUCKET).parquet(path + buckets.CHANGED)
    if complete:  # one bucket is in place already, the old version of another is gone
        (tmp_path / f"t{buckets.CHANGED}/_bucket=0").rename(tmp_path / "gone")
        for old in (tmp_path / "t/_bucket=0").iterdir():
            old.unlink()
        for part in (tmp_path / "gone").glob("*.parquet"):
            part.rename(tmp_path / "t/_bucket=0" / part.name)
    else:
        (tmp_path / f"t{buckets.CHANGED}/_SUCCESS").unlink()
    got = merge.read_target(spark, path, rows.schema)
    assert {r["v"] for r in got.select("v").collect()} == {"new" if complete else "old"} and got.count() == 50
    assert not merge.path_exists(spark, path + buckets.CHANGED)


def test_batches_keep_first_and_may_run_again(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.insert_ignore(spark.createDataFrame([(1, "stored", "s")], ROWS), path, ["k"])  # a plain table with a row
    one = spark.createDataFrame([(1, "a", "1"), (2, "b", "2"), (2, "a", "1"), (None, "n", "n")], ROWS)
    two = spark.createDataFrame([(2, "z", "z"), (3, "c", "3")], ROWS)
    assert buckets.insert_batch(one, path, ["k"], "s-0", ["w"], buckets=8) == 2
    assert buckets.insert_batch(two, path, ["k"], "s-1") == 1
    expected = sorted([(1, "stored", "s"), (2, "a", "1"), (None, "n", "n"), (3, "c", "3")], key=repr)
    assert bag(merge.read_target(spark, path, one.schema)) == expected
    for df, name, n in ((one, "s-0", 2), (two, "s-1", 1)):
        assert buckets.insert_batch(df, path, ["k"], name, ["w"]) == n
        assert bag(merge.read_target(spark, path, one.schema)) == expected
    buckets.compact_index(spark, path, one.schema)
    assert buckets.insert_batch(two, path, ["k"], "s-2") == 0
    assert bag(merge.read_target(spark, path, one.schema)) == expected
    with pytest.raises(ValueError):
        buckets.insert_batch(one, path, ["k"], "../x")


def test_a_batch_lost_between_its_writes_is_made_good(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(i, "a", "1") for i in range(20)], ROWS)
    buckets.insert_batch(one, path, ["k"], "s-0", buckets=4)
    # Rows of s-1 were written, its keys were not.
    more = spark.createDataFrame([(i, "b", "2") for i in range(15, 40)], ROWS)
    more.where("k >= 20").write.parquet(f"{path}/_batch=s-1")
    assert buckets.insert_batch(more, path, ["k"], "s-1") == 20
    got = merge.read_target(spark, path, one.schema)
    assert got.count() == 40 and got.select("k").distinct().count() == 40


def test_a_batch_reads_keys_of_its_own_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, "a", "1") for i in range(200)], ROWS)
    buckets.insert_batch(rows, path, ["k"], "s-0", buckets=16)
    known = buckets.index_of(spark, path, rows.schema, ["k"], [3, 5], "s-1")
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = known.select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all("_bucket=3/" in r["f"] or "_bucket=5/" in r["f"] for r in read)
    assert "v" not in known.columns


def test_replayed_envelopes(spark, tmp_path):
    lines = [{"table": "Taxa", "row": {"iri": "T"}}, {"table": "Genes", "row": {"gene_accession": "E1"}}, {"table": None, "row": {"a": "b"}}, {"table": "No", "row": {}}]
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(x) for x in lines))
    batch = spark.read.schema("table string, row map<string,string>").json(str(tmp_path / "a.jsonl"))
    keys = {"Taxa": ["iri"], "Genes": ["gene_accession"]}
    for _ in range(2):
        assert load_envelopes_batch(batch, "s-0", str(tmp_path / "db"), keys) == {"Taxa": 1, "Genes": 1}
        assert merge.read_target(spark, str(tmp_path / "db/Taxa"), TABLES["Taxa"]).count() == 1
        assert spark.read.json(str(tmp_path / "db/_quarantine")).count() == 2
