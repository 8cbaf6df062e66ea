import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixmart.llm import additive, centroids, middle

# ---------------------------------------------------------------- additive model


def words_of(text):
    return re.findall(r"[^ \t\x0b\x0c\n\r]+", text)


def test_features_equal_plain_counts():
    texts = ["", "One two two three.\nOne two", "A" * 50, "é ü\n\nß?", "### $$$ a### 12", " \n ", "a b " * 40]
    x = additive.features([t.encode() for t in texts])
    name = {f: i for i, f in enumerate(additive.FEATURES)}
    for row, text in zip(x, texts, strict=True):
        words = words_of(text)
        n = len(words)
        assert row[name["size"]] == pytest.approx(np.log1p(len(text.encode())))
        assert row[name["distinct_words"]] == pytest.approx(len(set(words)) / n if n else 0)
        assert row[name["top_word"]] == pytest.approx(max((words.count(w) for w in words), default=0) / n if n else 0)
        assert row[name["twins"]] == pytest.approx(sum(a == b for a, b in zip(words, words[1:], strict=False)) / n if n else 0)
        assert row[name["word_length"]] == pytest.approx(sum(len(w.encode()) for w in words) / n if n else 0)
        pairs = list(zip(words, words[1:], strict=False))
        assert row[name["distinct_pairs"]] == pytest.approx(len(set(pairs)) / len(pairs) if pairs else 0)
        eights = [tuple(words[i : i + 8]) for i in range(n - 7)]
        assert row[name["distinct_eights"]] == pytest.approx(len(set(eights)) / len(eights) if eights else 0)
        lines = [s for s in re.split(r"[\n\r]+", text) if s]
        assert row[name["distinct_lines"]] == pytest.approx(len(set(lines)) / len(lines) if lines else 0)
        assert row[name["symbol_ends"]] == pytest.approx(sum(w[-1] in "#$%&*@|" for w in words) / n if n else 0)


def test_features_do_not_depend_on_pieces_or_neighbours():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab# .\n") for _ in range(rng.randrange(0, 400))) for _ in range(60)]
    raw = [t.encode() for t in texts]
    whole = additive.features(raw)
    assert np.allclose(whole, np.concatenate([additive.features([r]) for r in raw]))
    # Cut after white space, only lines may be counted in two parts.
    cut = additive.features(raw, piece=40)
    kept = [i for i, f in enumerate(additive.FEATURES) if f != "distinct_lines"]
    assert np.allclose(whole[:, kept], cut[:, kept])


def test_model_learns_steps_and_interactions():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 4))
    y = (((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) | (x[:, 2] > 0.9)).astype(float)
    model = additive.AdditiveModel().fit(x, y, np.ones(len(y)))
    assert (0, 1) in model.pairs or (1, 0) in model.pairs
    new = rng.random((2000, 4))
    truth = ((new[:, 0] > 0.5) ^ (new[:, 1] > 0.5)) | (new[:, 2] > 0.9)
    assert ((model.score(new) > 0.5) == truth).mean() > 0.95
    # The score is a sum of table entries.
    one = new[:1]
    total = model.start + sum(t[np.searchsorted(c, v)] for t, c, v in zip(model.tables, model.cuts, one[0], strict=True))
    total += sum(t[np.searchsorted(model.coarse[i], one[0, i]), np.searchsorted(model.coarse[j], one[0, j])] for t, (i, j) in zip(model.pair_tables, model.pairs, strict=True))
    assert model.margin(one)[0] == pytest.approx(total)


def quality_docs(n=600):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("abcdehinorst") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(5, 80))]
        good = i % 4 != 0
        text = " ".join(words) + "." if good else (" ".join(w + "###" for w in words) if i % 8 else (words[0] + " ") * 40)
        rows.append((i, text, int(good)))
    return rows


def test_quality_is_learned_from_other_folds(spark):
    rows = quality_docs()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], None) for r in rows], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in additive.score_held_out(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, _, good in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.3)
    held = [r for r in rows if got[r[0]]["held_out"]]
    assert sum(got[i]["predicted"] == good for i, _, good in held) >= 0.95 * len(held)
    # Labels of the held-out fold teach nothing.
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in additive.score_held_out(docs, turned).collect()}
    assert again == {i: got[i]["score"] for i in again}


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "a b", "y"), (None, "", "z"), (2, "word " * 30000, None)], "doc_id long, text string, label string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in additive.score(docs, none).collect()] == [0.0] * 4
    ones = spark.createDataFrame([(1, 1), (1, None), (9, 0), (None, 0)], "doc_id long, quality int")
    assert {r["score"] for r in additive.score(docs, ones).collect()} == {1.0}
    both = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    scores = [r["score"] for r in additive.score(docs, both).collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    assert additive.score(docs.limit(0), both).count() == 0


# ---------------------------------------------------------------- centroid clustering


def brute_clusters(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centers = [v for _, v in start]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centers))
    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        centers = [[sum(col) // len(col) for col in zip(*(v for (_, v), j in zip(kept, of, strict=True) if j == c), strict=True)] or centers[c] for c in range(len(centers))]
    out = [(i, *reversed(nearest(v))) for i, v in kept]
    own = {}
    for _, c, d in out:
        own[c] = own.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, c, d, own[c], sum(own.values()), sha[c]) for i, c, d in out), key=repr)


@pytest.mark.parametrize("big", [1, 10**4])
def test_clusters_equal_brute_force(spark, big):
    rng = random.Random(big)
    rows = [(i, [float(np.float32(rng.gauss(0, 1) * big)) for _ in range(6)]) for i in range(120)]
    rows += [(500 + i, rows[0][1]) for i in range(60)]  # one vector many times
    rows += [(7, rows[9][1]), (None, rows[3][1]), (900, None), (901, [1.0]), (902, [None] * 6), (903, [float("nan")] * 6), (904, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, cluster int")
    got = centroids.cluster(df, k=8, rounds=3, dimensions=6)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_clusters(rows, 8, 3, 6)


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, -0.5]), (1, [0.5, -0.5]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert sorted((tuple(r) for r in centroids.cluster(df, k=40, dimensions=2).collect()), key=repr) == brute_clusters([tuple(r) for r in df.collect()], 40, 5, 2)
    empty = centroids.cluster(df.limit(0), dimensions=2)
    assert empty.collect() == [] and empty.columns == centroids.cluster(df, dimensions=2).columns
    assert empty.dtypes == centroids.cluster(df, dimensions=2).dtypes


def test_vectors_beyond_exact_range_raise(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(ArithmeticError):
        centroids.cluster(df, dimensions=2)


# ---------------------------------------------------------------- fill in the middle


def brute_middle(doc_id, text, percent=100, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in middle.MARKERS) or h[2] % 100 >= percent:
        return doc_id, len(units), "plain", text, None, None, text
    prefix, mid, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return doc_id, len(units), "spm", f"<S>{suffix}<P>{prefix}<M>{mid}", len(prefix), len(mid), text
    return doc_id, len(units), "psm", f"<P>{prefix}<S>{suffix}<M>{mid}", len(prefix), len(mid), text


def middle_rows():
    rng = random.Random(17)
    alphabet = ["a", "\n", "\n", "é", "😀", "<", "P", "S>", "M", ">", "<S", "$1", "\\", "\r", " ", " "]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    return [*rows, (300, None), (301, ""), (302, "\n"), (303, "x <P> y\nz"), (None, "a\nb\nc"), (5, rows[5][1]), (304, "line\n" * 200_000), (305, "x" * 1_000_000)]


@pytest.mark.parametrize("percent", [100, 40])
def test_middle_equals_brute_force_and_comes_back(spark, percent):
    rows = middle_rows()
    df = spark.createDataFrame([(i, t, "w") for i, t in rows], "doc_id long, text string, output string")
    got = middle.restore(middle.transform(df, percent=percent)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute_middle(i, t, percent) for i, t in rows), key=repr)


def test_middle_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert middle.restore(middle.transform(empty)).collect() == []


def test_middle_with_words_and_other_markers(spark):
    df = spark.createDataFrame([(i, f"one two  three {i} four") for i in range(40)], "doc_id long, text string")
    names = ("[pre$]", "[suf\\]", "[mid]")
    words = (r"\S+\s*|\s+", r"\S++\s*+|\s++")
    got = middle.restore(middle.transform(df, words, names), markers=names).collect()
    assert all(r["restored"] == f"one two  three {r['doc_id']} four" for r in got)
    assert {r["form"] for r in got} == {"psm", "spm"} and {r["n"] for r in got} == {5}
