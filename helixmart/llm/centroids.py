"""Centroid clustering of integer vectors in built-in expressions: zip_with and aggregate against literal centroids."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from helixmart.llm.common import settle

# Integer components up to this size have squared distances that fit a long, in up to 64 dimensions.
LARGEST = 1 << 27


def integer_vectors(vectors: DataFrame, scale: int, dimensions: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<long>): floor(scale * x) of the components, of vectors that are whole and finite."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(F.col(vector_col), lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    kept = vectors.where((F.size(vector_col) == dimensions) & whole)
    return kept.select(F.col(id_col).alias("id"), F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e)).alias("v"))


def _nearest(v: Column, centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid, the first of equally near ones."""

    def far(c: Column, k: Column) -> Column:
        squares = F.zip_with(v, c, lambda x, y: (x - y) * (x - y))
        return F.struct(F.aggregate(squares, F.lit(0).cast("long"), lambda a, b: a + b).alias("distance"), k.cast("int").alias("cluster"))

    literal = F.array(*[F.expr(f"array({','.join(f'{x}L' for x in c)})") for c in centroids])
    return F.array_min(F.transform(literal, far))


def _digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, dimensions: int = 64, seed: int = 2,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of ``dimensions`` numbers.

    Components become floor(scale * x). Centroids start as the k vectors whose sha256 of ``seed:id`` is smallest.
    A round gives every vector to its nearest centroid (ties: the smaller number) and moves each centroid that has
    vectors to their componentwise floor(sum / count). In between, k rows of sums go to the driver, and nothing else.

    Edge cases: vectors that are NULL, of another length, or hold a NULL or a non-finite number are not in the
    result; a NULL id is hashed as the empty text; repeated ids are rows of their own, and start in the order of
    their components; with fewer than k vectors there are as many clusters; an empty table gives no rows.
    Components beyond 2^27 have squared distances beyond a long: an ArithmeticError says so. Other columns are not
    looked at.
    """
    rows = settle(integer_vectors(vectors, scale, dimensions, id_col, vector_col), "centroids-vectors")
    largest = rows.agg(F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("m")).first()["m"] or 0
    if largest > LARGEST * 64 // max(64, dimensions):
        raise ArithmeticError(f"components of {largest} are too large for exact squared distances")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    starts = rows.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()  # k rows
    centroids = [[int(x) for x in r["v"]] for r in sorted(starts, key=lambda r: (r["h"], r["v"]))]
    if not centroids:
        schema = f"{id_col} {rows.schema['id'].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return rows.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        placed = rows.select("v", _nearest(F.col("v"), centroids)["cluster"].alias("cluster"))
        sums = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dimensions)])
        centroids = _moved(centroids, sums.collect(), dimensions)
    near = settle(rows.select("id", _nearest(F.col("v"), centroids).alias("near")).select("id", "near.cluster", "near.distance"), "centroids-nearest")
    parts = {r["cluster"]: r["s"] for r in near.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    about = F.array(*[F.struct(F.lit(parts.get(i, 0)).cast("long").alias("part"), F.lit(_digest(c)).alias("sha")) for i, c in enumerate(centroids)])
    own = about[F.col("cluster")]
    return near.select(
        F.col("id").alias(id_col), "cluster", "distance", own["part"].alias("cluster_inertia"),
        F.lit(sum(parts.values())).cast("long").alias("inertia"), own["sha"].alias("centroid_sha256"),
    )


def _moved(centroids: list[list[int]], sums: list[Row], dimensions: int) -> list[list[int]]:
    moved = list(centroids)
    for r in sums:
        moved[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dimensions)]
    return moved
