"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, and calibrated votes."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixmart.llm.common import arrow_batches, bucket, lean, settle, ship

# The bounded sample of labelled rows, and the bound of the vocabulary drawn from it.
EXAMPLES = 12_000
TERMS = 3_000
# A term speaks for label 1 if so many examples with it have the label, and the likelihood ratio (G squared) is so large.
LEAST_EXAMPLES = 5
LEAST_RATIO = 30.0
# Word beginnings of these lengths are terms beside the words.
STEMS = (4, 5, 6, 7)
NEIGHBOURS = 15
BLOCK = 512
MOST_WORDS = 150_000
# Rows of text in a batch for Python.
BATCH = 1000
WORD = re.compile(r"[^\W\d_]+")


def forms(word: str) -> list[str]:
    """The terms of a word: itself, and its beginnings, marked with ``*``."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def words(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


class Counted:
    """Term frequencies of chosen terms; remembers what words stand for."""

    def __init__(self, terms: list[str]):
        self.place = {t: i for i, t in enumerate(terms)}
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, text: str | None) -> tuple[dict[int, int], int]:
        """({term: frequency}, number of words)."""
        found = words(text)
        known, out, total = self.known, {}, 0
        if len(known) > MOST_WORDS:
            known.clear()
        for word, n in found.items():
            total += n
            hits = known.get(word)
            if hits is None:
                hits = known[word] = tuple(self.place[f] for f in forms(word) if f in self.place)
            for t in hits:
                out[t] = out.get(t, 0) + n
        return out, total


class Index:
    """Examples' postings in blocks, each block of a term with its largest weight."""

    def __init__(self, idf: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: list):
        self.idf, self.labels, self.ids = idf, labels, ids
        self.blocks = max(1, -(-len(vectors) // BLOCK))
        rows = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors]).astype(np.int64)
        terms = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, dtype=np.int64)
        weights = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        order = np.lexsort((rows, terms))
        self.rows, self.weights = rows[order], weights[order]
        cells = terms[order] * self.blocks + self.rows // BLOCK
        self.starts = np.searchsorted(cells, np.arange(len(idf) * self.blocks + 1))
        self.most = np.zeros(len(idf) * self.blocks)
        np.maximum.at(self.most, cells, self.weights)
        self.most = self.most.reshape(len(idf), self.blocks)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine (ties: the first examples) among those that share a term; never ``skip``."""
        bounds = weights @ self.most[terms]
        order = np.argsort(-bounds, kind="stable")
        rows, scores = np.zeros(0, dtype=np.int64), np.zeros(0)
        for b in order:
            # No example of this block or a later one can enter.
            if bounds[b] <= 0 or (len(scores) == k and bounds[b] < scores[-1] - 1e-12):
                break
            sums = np.zeros(BLOCK)
            for t, w in zip(terms, weights, strict=True):
                a, e = self.starts[t * self.blocks + b], self.starts[t * self.blocks + b + 1]
                if a < e:
                    sums[self.rows[a:e] % BLOCK] += w * self.weights[a:e]
            if skip // BLOCK == b:
                sums[skip % BLOCK] = 0
            hit = np.flatnonzero(sums)
            rows, scores = np.concatenate([rows, hit + b * BLOCK]), np.concatenate([scores, sums[hit]])
            best = np.lexsort((rows, -scores))[:k]
            rows, scores = rows[best], scores[best]
        return rows, scores

    def vector(self, terms: np.ndarray, counts: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights of length 1. The words without a term stand as one more direction, the last of idf."""
        rest = self.idf[-1] * (1 + math.log1p(max(0, total)))
        weights = self.idf[terms] * (1 + np.log(counts))
        return terms, weights / math.sqrt(float(weights @ weights) + rest * rest)

    def vote(self, rows: np.ndarray, scores: np.ndarray, prior: float) -> float:
        """Share of label 1 among the neighbours, weighted by cosine, with one vote at the rate of all examples."""
        return float((scores @ self.labels[rows] + prior) / (scores.sum() + 1))


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def calibrate(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic curve from leave-one-out votes to label rates; weak pull to the identity keeps it finite."""
    a, b = 1.0, 0.0
    x = np.array([_logit(v) for v in votes])
    for _ in range(25 if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p)
        gradient = np.array([((p - labels) * x).sum() + (a - 1), (p - labels).sum() + b])
        curve = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
        step = np.linalg.solve(curve, gradient)
        a, b = a - step[0], b - step[1]
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


class Model:
    def __init__(self, index: Index, prior: float, plain: float, curve: tuple[float, float]):
        self.index, self.prior, self.plain, self.curve = index, prior, plain, curve

    def score(self, terms: list[int], counts: list[int], total: int) -> tuple[float, list, list[float]]:
        """(score, neighbours' ids, their cosines). Without a term of the index: the label rate of such examples."""
        if not len(terms):
            return self.plain, [], []
        index = self.index
        rows, cosines = index.nearest(*index.vector(np.asarray(terms, dtype=np.int64), np.asarray(counts, dtype=np.float64), total), NEIGHBOURS)
        z = self.curve[0] * _logit(index.vote(rows, cosines, self.prior)) + self.curve[1]
        return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0))), [index.ids[r] for r in rows], cosines.tolist()


def _ratio(a: Column, b: Column, p, n):
    """Likelihood ratio of a term in a of p examples with label 1 and b of n others."""
    total = p + n
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    share = (a + b) / total
    return 2 * (part(a, share * p) + part(b, share * n) + part(p - a, p - share * p) + part(n - b, n - share * n))


def choose_terms(examples: DataFrame) -> list[str]:
    """Terms that speak for label 1 in examples(text, label)."""
    count = examples.groupBy().agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n")).first()
    if not count["p"] or not count["n"]:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[label].update({f for w in words(text) for f in forms(w)})
            terms = list({**found[0], **found[1]})
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([found[1][t] for t in terms], pa.int64()), pa.array([found[0][t] for t in terms], pa.int64())], names=["term", "a", "b"])

    counts = examples.select("text", F.col("label").cast("int")).mapInArrow(lean(run), "term string, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    p, n = F.lit(float(count["p"])), F.lit(float(count["n"]))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    fit = counts.where(F.col("a") >= LEAST_EXAMPLES).where(a / p > b / n).withColumn("ratio", _ratio(a, b, p, n)).where(F.col("ratio") >= LEAST_RATIO)
    return sorted(r["term"] for r in fit.orderBy(F.desc("ratio"), "term").limit(TERMS).collect())


def count_terms(docs: DataFrame, terms: list[str]) -> DataFrame:
    """docs(id, text) -> (id, terms array<int>, counts array<int>, total)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = Counted(terms)
        for batch in batches:
            found = [counted.of(t) for t in batch.column(1).to_pylist()]
            keys = [sorted(f) for f, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.list_(pa.int32())), pa.array([[f[t] for t in k] for k, (f, _) in zip(keys, found, strict=True)], pa.list_(pa.int32())), pa.array([n for _, n in found], pa.int64())],
                names=["id", "terms", "counts", "total"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(lean(run), f"id {kind}, terms array<int>, counts array<int>, total long")


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, score, neighbours, cosines) of every row of ``docs``, learned from ``labels``.

    Examples are the texts of at most EXAMPLES labelled ids, drawn by hash. Terms are words and word beginnings
    that speak for label 1 among the examples; their document frequencies are counted over all of ``docs``.
    A document's neighbours are the examples of largest TF-IDF cosine among those that share a term. Votes
    weighted by cosine pass a logistic curve fitted to leave-one-out votes; neighbours and cosines are the evidence.

    Edge cases: documents without such a term (NULL and empty texts too) have the label rate of examples
    without one; with no label of either kind every score is the rate of label 1, 0 without labels. Labels that
    are NULL, and labels of ids that ``docs`` lacks, teach nothing; an id labelled twice has its larger label.
    Repeated rows are scored each, and are one example. Other columns are not looked at.
    """
    ship(docs.sparkSession)
    drawn = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("label"))
    drawn = settle(drawn.orderBy(F.xxhash64("id"), "id").limit(EXAMPLES), "toxicity-drawn")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # EXAMPLES ids at most: bounded, so they may be broadcast.
    examples = settle(source.join(F.broadcast(drawn), "id").dropDuplicates(["id"]), "toxicity-examples").repartition(12, "id")
    with arrow_batches(docs.sparkSession, BATCH):
        terms = choose_terms(examples)
        counted = settle(count_terms(source, terms), "toxicity-counts")
        model = _fit(counted, examples, terms)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.score(*x) for x in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
            near = pa.array([f[1] for f in found], pa.list_(batch.schema.field(0).type))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.float64()), near, pa.array([f[2] for f in found], pa.list_(pa.float64()))], names=["id", "score", "neighbours", "cosines"])

    return counted.mapInArrow(lean(run), f"id {kind}, score double, neighbours array<{kind}>, cosines array<double>").withColumnRenamed("id", id_col)


def _fit(counted: DataFrame, examples: DataFrame, terms: list[str]) -> Model:
    total = counted.count()
    seen = {r["t"]: r["count"] for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}  # a row per chosen term
    idf = np.array([math.log((total + 1) / (seen.get(i, 0) + 1)) + 1 for i in range(len(terms))] + [1.0])
    labels = {r["id"]: r["label"] for r in examples.select("id", "label").collect()}
    rows = sorted(count_terms(examples.select("id", "text"), terms).collect(), key=lambda r: str(r["id"]))
    prior = sum(labels.values()) / len(labels) if labels else 0.0
    bare = [labels[r["id"]] for r in rows if not r["terms"]]
    plain = (sum(bare) + prior) / (len(bare) + 1)
    rows = [r for r in rows if r["terms"]]
    index = Index(idf, [], np.zeros(0), [])
    vectors = [index.vector(np.array(r["terms"], dtype=np.int64), np.array(r["counts"], dtype=np.float64), r["total"]) for r in rows]
    index = Index(idf, vectors, np.array([labels[r["id"]] for r in rows], dtype=np.float64), [r["id"] for r in rows])
    votes = [index.vote(*index.nearest(*v, NEIGHBOURS, skip=i), prior) for i, v in enumerate(vectors)]
    return Model(index, prior, plain, calibrate(np.array(votes), index.labels))


def score_held_out(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """Learn from labels outside a fold of doc_id, score all: doc_id, held_out, score, predicted, neighbours, cosines."""
    scored = score(docs, labels.where(bucket("doc_id", folds) != fold))
    return scored.select("doc_id", (bucket("doc_id", folds) == fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours", "cosines")
