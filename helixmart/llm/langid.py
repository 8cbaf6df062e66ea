"""Language identification by cross-parsing: the language whose text needs the fewest phrases wins."""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixmart.llm.common import bucket, settle, ship

# The bounded training sample: letters for each language, texts it is taken from, and the length of texts preferred.
LETTERS = 30_000
TEXTS = 64
SHORT = 5_000
# Texts are parsed in stretches of this many symbols, so that all lanes are equally long; a phrase ends with its stretch.
STRETCH = 512
RESTART = np.int32(1 << 30)


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring of ``symbols``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in symbols:
        now = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = now
            p = link[p]
        if p >= 0:
            q = moves[p][s]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return moves


class Model:
    """All languages' automata in one table of moves; a move that ends a phrase carries a flag."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in samples]
        points = [self._clean(_points(text)) for _, text in samples]
        alphabet = sorted({int(p) for x in points for p in np.unique(x) if p})
        # Codes: 0 not a letter, 1 a letter of no sample, 2 and up the letters, and the last for filling up.
        self.code = _letters().astype(np.int32)
        for i, p in enumerate(alphabet):
            self.code[p] = i + 2
        self.width = len(alphabet) + 3
        tables, self.starts, at = [], [], 0
        for x in points:
            moves = suffix_automaton(self.code[x].tolist())
            fresh = len(moves)  # one more state: before a text and after a strange symbol, where any symbol starts a phrase
            table = np.full((fresh + 1, self.width), -1, dtype=np.int32)
            for state, row in enumerate(moves):
                table[state, list(row)] = list(row.values())
            # No move: the phrase ends and the next begins with this symbol; a strange symbol is a phrase itself.
            again = np.where(table[0] >= 0, table[0], fresh) | RESTART
            table = np.where(table >= 0, table, again[None, :])
            table[:, -1] = np.arange(fresh + 1)
            tables.append(table + at)
            self.starts.append(at + fresh)
            at += fresh + 1
        self.table = np.concatenate(tables).ravel()
        self.bits = np.array([np.log2(max(2, len(x))) for x in points])

    @staticmethod
    def _clean(points: np.ndarray) -> np.ndarray:
        """0 for everything that is no letter, and one 0 in a row."""
        x = np.where(_letters()[points], points, 0)
        return x[(x != 0) | (np.concatenate([[1], x[:-1]]) != 0)]

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases needed of each language (texts x languages), and the symbols parsed."""
        lanes, owner, sizes = [], [], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            points = _points(text or "")
            codes = self.code[points]
            codes = codes[(codes != 0) | (np.concatenate([[1], codes[:-1]]) != 0)]
            if not codes.any():
                continue
            sizes[i] = len(codes)
            n = -(-len(codes) // STRETCH)
            padded = np.full(n * STRETCH, self.width - 1, dtype=np.int32)
            padded[: len(codes)] = codes
            lanes.append(padded.reshape(n, STRETCH))
            owner += [i] * n
        out = np.zeros((len(texts), len(self.names)), dtype=np.int64)
        if lanes:
            steps = np.ascontiguousarray(np.concatenate(lanes).T)
            owner = np.array(owner)
            for k, start in enumerate(self.starts):
                state = np.full(steps.shape[1], start, dtype=np.int32)
                count = np.zeros(steps.shape[1], dtype=np.int32)
                for row in steps:
                    move = self.table[state * self.width + row]
                    count += move >> 30
                    state = move & (RESTART - 1)
                out[:, k] = np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)
        return out, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        phrases, sizes = self.phrases(texts)
        # Bits to name the phrases' places in the sample, a symbol: the cross-parsing estimate of the entropy.
        entropy = phrases * self.bits / np.maximum(sizes, 1)[:, None]
        best = entropy.argmin(axis=1)
        gap = (entropy - entropy.min(axis=1, keepdims=True)) * np.minimum(sizes, 100)[:, None]
        score = 1 / np.exp(-np.minimum(gap, 700)).sum(axis=1)
        names = [self.names[b] if n else "und" for b, n in zip(best, sizes, strict=True)]
        return names, [float(s) if n else 0.0 for s, n in zip(score, sizes, strict=True)]


@functools.lru_cache(maxsize=2)
def _model(samples: tuple[tuple[str, str], ...]) -> Model:
    """Built once in a worker: the samples are small, the tables are not."""
    return Model(samples)


def training_sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[tuple[str, str], ...]:
    """About LETTERS characters of text for each language, of at most TEXTS rows drawn by hash, shorter texts first."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("draw"), (F.length(text_col) > SHORT).alias("long"), F.length(text_col).alias("size")
    )
    order = Window.partitionBy("lang").orderBy("long", "draw")
    drawn = rows.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= TEXTS)
    sofar = Window.partitionBy("lang").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    drawn = settle(drawn.withColumn("before", F.coalesce(F.sum("size").over(sofar), F.lit(0))).where(F.col("before") < LETTERS).select("lang", "draw", "turn"), "langid-drawn")
    texts = labelled.select(F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("draw"), F.col(text_col).alias("text"))
    # TEXTS rows a language: bounded, so it may be broadcast, and its texts collected.
    found = texts.join(F.broadcast(drawn), ["lang", "draw"]).dropDuplicates(["lang", "draw"]).orderBy("lang", "turn").collect()
    samples: dict[str, str] = {}
    for r in found:
        samples[r["lang"]] = (samples.get(r["lang"], "") + " " + r["text"])[: 2 * LETTERS]
    return tuple(sorted(samples.items()))


def identify(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, lang_pred, score) of every text of ``docs``, learned from text and language of ``labelled``.

    Each language has a suffix automaton of its sample. A text is parsed into the longest phrases that the
    sample contains; phrases times the bits that name a place in the sample, per symbol, estimate the cross
    entropy, and the least wins (ties: the first name). Upper case and what stands between letters don't count.
    The score is the winner's share of weights exp(-gap), gap in bits over up to 100 symbols: near 1 if the others are far behind.

    Edge cases: NULL, empty and letterless texts give ``und`` with score 0, and so does everything if nothing
    is labelled; a letter that no sample has is a phrase by itself; texts are parsed to the end, in stretches
    of 512 symbols; repeated rows are answered each. Other columns are not looked at.
    """
    ship(docs.sparkSession)
    samples = training_sample(labelled, id_col, text_col, lang_col)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if not samples:
        return source.select(F.col("id").alias(id_col), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                names, scores = model.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def identify_held_out(docs: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """Learn from rows outside a fold of doc_id, predict all: doc_id, held_out, lang_pred, score."""
    labelled = docs.where(bucket("doc_id", folds) != fold)
    return identify(docs, labelled).select("doc_id", (bucket("doc_id", folds) == fold).alias("held_out"), "lang_pred", "score")
