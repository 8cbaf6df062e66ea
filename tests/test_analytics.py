import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import bag
from helixmart.ml import recipes
from helixmart.operators import matrix, sampling
from helixmart.operators.numbering import number_distinct
from helixmart.operators.profile import approximate_profile, category_profile
from helixmart.plans import analytics


def benjamini_hochberg(ps):
    """Straight definition: min over equal or larger p of p * m / rank."""
    ordered = sorted(ps)
    m = len(ordered)
    rank = {p: i + 1 for i, p in enumerate(ordered)}  # highest rank of each distinct p
    distinct = sorted(rank)
    out, low = {}, 1.0
    for p in reversed(distinct):
        low = min(low, p * m / rank[p])
        out[p] = low
    return out


P_VALUES = [0.0, 0.0, 1.0, 1.0, 0.5, 0.25, 0.125, 0.125, 1e-300, 5e-324, 0.1, math.nextafter(0.25, 0), math.nextafter(0.5, 1)]


@pytest.mark.parametrize("slices", [1, 4, 1024])
def test_adjusted_p_matches_definition(spark, slices):
    rng = random.Random(7)
    groups = {"a": P_VALUES, "b": [rng.random() ** 4 for _ in range(300)], None: [0.2, 0.2, 0.01]}
    rows = [(g, p) for g, ps in groups.items() for p in ps] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, p double")
    got = {(r["g"], r["p"]): r["fdr"] for r in analytics.adjusted_p(df, "p", ["g"], slices).collect()}
    expected = {(g, p): v for g, ps in groups.items() for p, v in benjamini_hochberg(ps).items()}
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k], rel=1e-12, abs=0) for k in expected)


def test_bucket_order_follows_p(spark):
    rng = random.Random(3)
    ps = sorted({2.0**-k * f for k in range(60) for f in (1, 1 - 1e-16, 1 + 1e-15, 1.5)} | {rng.random() for _ in range(500)} | {0.0})
    df = spark.createDataFrame([(p,) for p in ps], "p double").select("p", analytics._bucket(F.col("p"), 1024).alias("b"))
    buckets = [r["b"] for r in df.orderBy("p").collect()]
    assert buckets == sorted(buckets)


def test_volcano_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 2.0, 0.01), (None, 0.1, 0.01), ("a", -3.0, 0.9)], "g string, fc double, p double")
    assert bag(analytics.volcano(df, "fc", "p", 1.0, 0.05, ["g"])) == [(None, 2.0, 0.01, 0.01)]


def test_numbering_is_dense_and_independent_of_partitioning(spark):
    rows = [(g, f"v{i}") for g in ("a", None) for i in range(40)] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v string")
    one, two = number_distinct(df.coalesce(1), "v", ["g"]), number_distinct(df.repartition(7), "v", ["g"], hex_digits=1)
    assert bag(one) == bag(two)
    assert sorted(r["n"] for r in one.collect() if r["g"] == "a") == list(range(1, 42))
    assert [r["n"] for r in one.filter("g = 'a' and v is null").collect()] == [41]


def test_fold_change(spark):
    df = spark.createDataFrame([("g", "t", 7.0), ("g", "t", 7.0), ("g", "c", 1.0), ("h", "t", 1.0)], "gene string, c string, v double")
    assert bag(analytics.fold_change(df, ["gene"], "c", "t", "c", "v")) == [("g", 7.0, 1.0, 2.0), ("h", 1.0, None, None)]


def test_similarity_has_no_pair_rows(spark):
    df = spark.createDataFrame(
        [(f"g{i}", t, float(i * k)) for i in range(5) for t, k in (("gut", 1), ("brain", 2), ("organoid", -1))], "f string, t string, v double"
    )
    got = {(r[0], r[1]): round(r[2], 9) for r in analytics.profile_similarity(df, "f", "t", "v", ["organoid"], ["gut", "brain"]).collect()}
    assert got == {("organoid", "gut"): -1.0, ("organoid", "brain"): -1.0}


def test_rolling_and_flows(spark):
    hits = spark.createDataFrame([(["p", "q"], "d1"), (["p"], "d1"), (["p"], "d2")], "w array<string>, d string")
    daily = analytics.hits_per_day(hits, F.col("w"), F.col("d"))
    assert bag(analytics.rolling_hits(daily, 1)) == [("p", "d1", 2, 2.0), ("p", "d2", 1, 1.5), ("q", "d1", 1, 1.0)]
    links = spark.createDataFrame([("m1", "s1"), ("m1", "s1"), ("m2", "s2")], "microbe string, sample string")
    samples = spark.createDataFrame([("s1", "astrocyte", "x"), ("s2", "astrocyte", "y")], "sample string, cell string, stim string")
    stims = spark.createDataFrame([("x", "SCFA"), ("y", "SCFA")], "stim string, metabolite string")
    paths = analytics.flows(links, [(samples, ["sample"]), (stims, ["stim"])], ["microbe", "metabolite", "cell"])
    assert bag(paths.select("microbe", "metabolite", "cell", "n_links")) == [("m1", "SCFA", "astrocyte", 2), ("m2", "SCFA", "astrocyte", 1)]
    assert bag(analytics.edges(paths, "metabolite", "cell")) == [("SCFA", "astrocyte", 3)]


def test_top_hits(spark):
    df = spark.createDataFrame([("STAT3", "a", 1.0), ("STAT3", "b", 3.0), ("X", "c", 9.0), ("STAT3", "d", 3.0)], "g string, s string, fc double")
    assert [r["s"] for r in analytics.top_hits(df, F.col("g") == "STAT3", "fc", ["s"], 2).collect()] == ["b", "d"]


def test_profile_limits(spark):
    df = spark.createDataFrame([(f"v{i:03d}", "x") for i in range(40)] + [(None, "y")], "a string, b string")
    got = {r["column"]: r for r in category_profile(df, ["a", "b"]).collect()}
    assert got["a"]["n_values"] == 40 and got["a"]["shown_values"] == "|".join(f"v{i:03d}" for i in range(10))
    assert got["b"]["complete"] and got["b"]["shown_values"] == "x|y"
    edge = category_profile(df.filter("a < 'v030'"), ["a"]).first()
    assert (edge["n_values"], edge["complete"], len(edge["shown_values"].split("|"))) == (30, False, 10)
    assert dict(approximate_profile(df, ["b"]).collect()) == {"b": 2}


def test_categories_decode_missing_to_null(spark):
    dictionary = matrix.dictionary_rows(spark.createDataFrame([(["x", "y"],)], "c array<string>"), "c")
    df = spark.createDataFrame([(0,), (1,), (-1,), (5,)], "code int")
    assert bag(matrix.decode_categories(df, "code", dictionary, "v")) == sorted([(0, "x"), (1, "y"), (-1, None), (5, None)], key=repr)


@pytest.mark.parametrize("width", [1, 3, 65536])
def test_csr(spark, width):
    indptr = [0, 2, 2, 9, 10]
    data = spark.createDataFrame([(p, p % 4, float(p)) for p in range(10)], "pos long, col int, value double")
    spans = spark.createDataFrame([(r, indptr[r], indptr[r + 1]) for r in range(4)], "row int, start long, end long")
    expected = sorted(((r, p % 4, float(p)) for r in range(4) for p in range(indptr[r], indptr[r + 1])), key=repr)
    assert bag(matrix.csr_to_coordinates(data, spans, width)) == expected


def test_unpivot_and_pivot_conserve_rows(spark):
    wide = spark.createDataFrame([("g1", 1, 0), ("g2", 5, 7)], "gene string, r1 int, r2 int")
    long = matrix.wide_counts_to_long(wide, ["gene"])
    assert long.count() == 4
    assert bag(matrix.densify(long, "gene", "run", "count", {"r1": "r1", "r2": "r2"})) == [("g1", 1, 0), ("g2", 5, 7)]


def test_seeded_sample_is_stable(spark):
    df = spark.range(200)
    a = sampling.seeded_sample(df.repartition(9), ["id"], 42).collect()
    assert a == sampling.seeded_sample(df.coalesce(1), ["id"], 42).collect()
    assert a != sampling.seeded_sample(df, ["id"], 43).collect()


def test_recipes(spark, tmp_path):
    from helixmart.sinks.merge import insert_ignore

    # A counted write leaves an observer in the session; models must still score afterwards.
    insert_ignore(spark.createDataFrame([(1,)], "k int"), str(tmp_path / "t"), ["k"])
    rows = spark.createDataFrame([(i, f"m{i % 3}", f"s{i % 2}", float(i % 7), "High" if i % 3 == 0 else "Low") for i in range(120)], "id int, m string, s string, x double, y string")
    model = recipes.significance_model(rows, ["m", "s"], ["x"], "y", trees=5, width=32)
    scored = recipes.predict(model, rows, ["id", "y"]).collect()
    assert sum((r["predicted"] == 0) == (r["y"] == "High") for r in scored) > 110
    assert recipes.principal_components(rows, ["id"], ["id", "x"], 2).columns == ["id", "pc1", "pc2"]
