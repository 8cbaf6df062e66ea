"""Scripts without blanks are found without a look-up for every character."""

import time

from pyspark.sql import functions as F

from helixmart.llm.decontaminate import UNSPACED

SCRIPTS = "Han Hiragana Katakana Thai Lao Khmer Myanmar".split()


def test_same_characters_as_the_scripts(spark):
    points = spark.range(1, 0x110000).where("id < 55296 or id > 57343")
    c = F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')")
    found = points.select(c.rlike(f"[{UNSPACED}]").alias("found"), F.expr(" or ".join(rf"{{c}} rlike r'\p{{{{Is{s}}}}}'" for s in SCRIPTS).format(c="decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')")).alias("want"))
    assert found.where("found <> want").count() == 0
    assert found.where("found").count() > 90_000


def test_other_characters_cost_a_comparison(spark):
    rows = spark.range(0, 200, 1, 1).select(F.expr("repeat('Plain words, 12 of them. ', 4000)").alias("text")).cache()
    rows.count()

    def seconds(pattern):
        best = 1e9
        for _ in range(3):
            began = time.perf_counter()
            assert rows.where(F.col("text").rlike(pattern)).count() == 0
            best = min(best, time.perf_counter() - began)
        return best

    assert seconds(f"[{UNSPACED}]") < 6 * seconds(r"[\x{E00}-\x{10FFFF}]")
    rows.unpersist()
