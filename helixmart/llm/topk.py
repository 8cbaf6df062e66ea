"""Exact top-k inner products with MaxScore bounds, over shards of integer vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixmart.llm.common import settle, ship

# Queries sent to the tasks at a time: the bound of what a job broadcasts.
QUERIES_PER_BLOCK = 2048
# Candidates in one matrix, and dimensions probed between two tests.
SHARD_ROWS = 16_384
PROBE = 8


def quantise(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(n, id, v): n a row number of its own, v = floor(scale * x). Vectors with a NULL or non-finite component go."""
    x = F.col(vector_col)
    broken = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    whole = vectors.where(x.isNotNull() & F.col(id_col).isNotNull()).where(~broken)
    return whole.select(
        F.monotonically_increasing_id().alias("n"),
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"),
    )


class Queries:
    """A block of queries of one length, with the best scores found so far as thresholds."""

    def __init__(self, rows: list[tuple[int, int, list[int]]], k: int):
        self.k = k
        self.n = [r[0] for r in rows]
        self.ids = [r[1] for r in rows]
        self.v = np.array([r[2] for r in rows], dtype=np.int64).reshape(len(rows), -1)
        self.best: list[list[tuple[int, int, int]]] = [[] for _ in rows]  # (-score, id, n), best first

    def search(self, n: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        """Meet one shard: x holds a posting list of all candidates in each row (dimension)."""
        low, high = x.min(axis=1), x.max(axis=1)
        largest = float(np.abs(self.v).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, len(x))
        kind = np.float64 if largest < 2**53 else np.int64  # exact in either
        postings = x.astype(kind)
        for i, q in enumerate(self.v):
            bounds = np.maximum(q * low, q * high)
            order = np.argsort(-bounds, kind="stable")
            rest = np.concatenate([np.cumsum(bounds[order][::-1])[::-1], [0]])  # what the terms from here on can add
            self.best[i] = self._one(q.astype(kind), postings, order, rest, n, ids, i)

    def _one(self, q, postings, order, rest, n, ids, i) -> list[tuple[int, int, int]]:
        best, k = self.best[i], self.k
        # Seed: the leaders of the first terms, scored in full, give a first threshold.
        first = min(PROBE, len(order))
        part = q[order[:first]] @ postings[order[:first]]
        if len(best) < k and len(part) > 4 * k:
            seeds = np.argpartition(-part, 2 * k)[: 2 * k]
            seeds = seeds[n[seeds] != self.n[i]]
            scores = np.sort(q @ postings[:, seeds])[::-1]
            floor = scores[k - 1] if len(scores) >= k else -np.inf
        else:
            floor = -best[-1][0] if len(best) >= k else -np.inf
        # Essential terms: as many as it takes until the others alone cannot reach the threshold.
        essential = first
        while essential < len(order) and rest[essential] >= floor:
            essential = min(essential + PROBE, len(order))
        if essential > first:
            part = part + q[order[first:essential]] @ postings[order[first:essential]]
        alive = np.flatnonzero(part + rest[essential] >= floor)
        part = part[alive]
        # The others are probed for candidates that can still compete.
        for at in range(essential, len(order), PROBE):
            terms = order[at : at + PROBE]
            part = part + q[terms] @ postings[np.ix_(terms, alive)]
            keep = part + rest[min(at + PROBE, len(order))] >= floor
            if not keep.all():
                alive, part = alive[keep], part[keep]
        own = n[alive] != self.n[i]
        alive, part = alive[own], part[own]
        if len(alive) > k:
            least = np.partition(part, len(part) - k)[len(part) - k]
            alive, part = alive[part >= least], part[part >= least]
        found = [(-int(s), int(c), int(m)) for s, c, m in zip(part, ids[alive], n[alive], strict=True)]
        return sorted([*best, *found])[:k]


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
) -> DataFrame:
    """The k best candidates of every row for which the column ``is_query`` holds: query_id, rank, vec_id, score.

    Scores are integer inner products of floor(scale * x); ties go to the smaller id. Candidates are all
    rows but the query's own row, of the query's length. Queries go out in blocks of bounded size; every
    task runs MaxScore over its own shard and keeps k rows a query, and the shards' rows are merged.

    Edge cases: NULL vectors or ids, and vectors with NULL or non-finite components, take no part. Repeated
    rows are candidates each (a repeated query row is answered twice); an empty table gives no rows; empty
    vectors score 0 with each other. Scores must fit in 64 bits.
    """
    ship(vectors.sparkSession)
    marked = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v"), is_query.alias("_q"))
    rows = settle(quantise(marked.withColumnRenamed("_id", id_col).withColumnRenamed("_v", vector_col), id_col, vector_col, scale), "topk-rows")
    asked = rows.join(marked.where("_q").select(F.col("_id").cast("long").alias("id")).distinct(), "id", "left_semi")
    asked = settle(asked, "topk-queries")
    blocks = -(-asked.count() // QUERIES_PER_BLOCK)
    schema = "query_n long, query_id long, vec_id long, score long, n long"
    found = rows.sparkSession.createDataFrame([], schema)
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("n"), F.lit(blocks)) == b)
        sent = rows.sparkSession.sparkContext.broadcast([(r["n"], r["id"], list(r["v"])) for r in block.collect()])

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            yield from _search(batches, sent.value, k)

        found = found.union(settle(rows.mapInArrow(run, schema), "topk-found"))
    order = Window.partitionBy("query_n").orderBy(F.desc("score"), "vec_id", "n")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def _search(batches: Iterator[pa.RecordBatch], queries: list, k: int) -> Iterator[pa.RecordBatch]:
    by_length: dict[int, list] = {}
    for q in queries:
        by_length.setdefault(len(q[2]), []).append(q)
    sets = {size: Queries(rows, k) for size, rows in by_length.items()}
    waiting: dict[int, list] = {size: [] for size in sets}

    def meet(size: int) -> None:
        parts, waiting[size] = waiting[size], []
        if parts:
            n, ids, x = (np.concatenate(a) for a in zip(*parts, strict=True))
            sets[size].search(n, ids, np.ascontiguousarray(x.T))

    for batch in batches:
        lists = batch.column(2)
        lengths = np.diff(lists.offsets.to_numpy())
        flat, starts = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])
        n, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for size in np.unique(lengths):
            if int(size) in sets:
                at = np.flatnonzero(lengths == size)
                x = flat[(starts[at][:, None] + np.arange(size)).astype(np.int64)]
                waiting[int(size)].append((n[at], ids[at], x))
                if sum(len(p[0]) for p in waiting[int(size)]) >= SHARD_ROWS:
                    meet(int(size))
    for size in sets:
        meet(size)
    rows = [(s.n[i], s.ids[i], c, -score, m) for s in sets.values() for i in range(len(s.n)) for score, c, m in s.best[i]]
    if rows:
        names = ["query_n", "query_id", "vec_id", "score", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in zip(*rows, strict=True)], names=names)
