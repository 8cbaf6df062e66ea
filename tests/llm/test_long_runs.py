"""Long runs of names or marks: decontamination must not take stack for each of them, or the executor ends."""

import random

from pyspark.sql import functions as F

from helixmart.llm import decontaminate

ITEM = "a farmer near the old mill has 14 kg of apples and gives 3 kg to his neighbour at the market"


def plain(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", decontaminate.plain(F.col("t")).alias("r"))
    return [r["r"] for r in rows.orderBy("i").collect()]


def test_runs_of_marks_of_other_widths(spark):
    marks = "\U0001f600=" * 20_000
    assert plain(spark, [f"{marks}Word", f"word {marks}", f"{marks}-5"]) == ["word", f"word {marks}", "-5"]


def test_marks_go_as_one_by_one(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("aB5+−-=. '\U0001f600é٣", k=rng.randint(1, 12))) for _ in range(3000)]
    # Each mark that goes is none of a number's sign.
    before = r"(?<![^ ])(?:(?![+−-]?\p{N})[^\p{L}\p{M}\p{N} ])+(?=[\p{L}\p{M}\p{N}+−-])"
    after = r"(?<=[\p{L}\p{M}\p{N}])[^\p{L}\p{M}\p{N} ]+(?![^ ])"
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    want = rows.select("i", F.regexp_replace(F.lower("t"), f"{before}|{after}", "").alias("r")).orderBy("i").collect()
    assert plain(spark, texts) == [r["r"] for r in want]


def test_runs_of_capitalised_words(spark):
    names = "Alpha Élan O’Neil \U00010400\U00010428 " * 10_000
    texts = [f"{names}and {ITEM.replace('14', '25')} {names}", f"said {names}", names]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    read = decontaminate.template(docs.select("doc_id", decontaminate.spaced(F.col("text")).alias("w")), "w")
    assert [r["template"] for r in read.where("doc_id > 0").orderBy("doc_id").collect()] == ["said ⟨p⟩", "⟨p⟩"]
    found = decontaminate.contaminated(docs, spark.createDataFrame([(7, ITEM)], "item_id long, text string"))
    assert [(r["doc_id"], r["item_id"], r["kind"]) for r in found.collect()] == [(0, 7, "reparameterised")]
