"""Exact Jaccard join of word-shingle sets in metric space: regions, pivots and triangle-inequality windows.

Jaccard distance is a metric, but nearly all pairs of documents are at distance 1, where pivots chosen at random
separate nothing. Regions are therefore opened where sets can be close at all: two linked sets share one of their
rarest shingles, the smaller set among its first few (the window of its size), so every set belongs to the regions
of its rarest shingles, and no link leaves them. Each region has a pivot; a set is measured against the pivot with
which it shares most regions. What that leaves apart is joined inside the regions: small ones directly, large
ones once more in metric space: sets are known by their differences from the region's pivot, whose number is the
distance to it; two linked sets must share differences, by the triangle inequality the more the further out they
are, so they meet in inner regions of rare differences, with pivots and windows again. Before whole sets are
compared, a parity sketch gives a lower bound of their distance.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixmart.llm.common import arrow_batches, components, drop_settled, lean, partitions, settle, ship

# Counters of how often shingles occur: 2 to this power, whatever the input's size, in slices.
COUNTER_BITS = 20
SLICES = 16
# Regions of so many sets are joined directly, larger ones by differences from their pivot.
SMALL = 48
# Turns in which the first sets of classes are measured before all sets that are left.
TURNS = 4
MOST_WORDS = 150_000
# Rows in a batch for Python: sets are wide, and both sides hold a batch and what is made of it.
BATCH = 1000
# Rows of regions aimed at in a task: packed, they are too small for Spark to tell what sorting and hashing them takes.
TASK_ROWS = 100_000
# Names of sets that a task remembers, so as to write the copies it meets once.
MOST_NAMES = 500_000
MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class Shingler:
    """Sets of hashed word shingles; remembers word hashes."""

    def __init__(self, k: int):
        self.k = k
        self.known: dict[bytes, int] = {}
        rng = np.random.default_rng(20240229)
        self.odd = rng.integers(0, 2**63, size=k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def words(self, raw: bytes) -> np.ndarray:
        """Hashes of the words: A-Z in lower case, cut at ASCII white space."""
        words = raw.lower().split()
        known = self.known
        try:
            return np.array([known[w] for w in words], dtype=np.uint64)
        except KeyError:
            if len(known) > MOST_WORDS:
                known.clear()
            for w in set(words):
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            return np.array([known[w] for w in words], dtype=np.uint64)

    def shingles(self, raw: bytes) -> np.ndarray:
        """Sorted distinct 64-bit shingles; with fewer than k words the sequence is one shingle."""
        w = self.words(raw)
        if not len(w):
            return w
        size = min(len(w), self.k)
        mixed = np.full(len(w) - size + 1, size, dtype=np.uint64) * MULTIPLIERS[4]
        for i in range(size):
            mixed += w[i : len(w) - size + 1 + i] * self.odd[i]
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed * MULTIPLIERS[0])


def most_apart(a: int, b: int, percent: int) -> int:
    """Largest symmetric difference of linked sets of these sizes: 100 I >= p U  <=>  (100 + p) D <= (100 - p) (a + b)."""
    return (a + b) * (100 - percent) // (100 + percent)


def prefixes(size: int, percent: int) -> tuple[int, int]:
    """How many of a set's rarest shingles hold one that it shares with any linked set: (as the smaller one, as the larger one).

    Linked sets of sizes a and b share (a + b) p / (100 + p) shingles at least, and the first one that they share
    stands behind no more than what the partner lacks.
    """
    shared = lambda other: -(-percent * (size + other) // (100 + percent))
    return size - shared(size) + 1, size - shared(-(-percent * size // 100)) + 1


def counter(items: np.ndarray) -> np.ndarray:
    return (items * MULTIPLIERS[1] >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def parity(items: np.ndarray) -> bytes:
    """Bits that say whether an odd number of items falls on them: twice as many as items, and a power of two, 64 at least.

    Each item that only one of two sets has turns one bit, so the sketches differ in no more bits than the sets in items.
    """
    bits = 1 << max(6, int(2 * len(items) - 1).bit_length())
    counts = np.bincount((items * MULTIPLIERS[2] >> np.uint64(32)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((counts & 1).astype(bool), bitorder="little").tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """Lower bound of the symmetric difference, from the sketches; the longer one is folded to the other's length."""
    x, y = (np.frombuffer(s, dtype=np.uint64) for s in sorted((a, b), key=len))
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _lists(arrays: list[np.ndarray | None]) -> pa.Array:
    missing = [a is None for a in arrays]
    arrays = [np.zeros(0, dtype=np.uint64) if a is None else a for a in arrays]
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)), mask=pa.array(missing))


def _sets(texts: DataFrame, k: int) -> DataFrame:
    """texts(id, text) -> (id, n_shingles, name, items, parity).

    A set is named by a 64-bit hash of its shingles. Items and sketch are NULL where the task wrote the set before,
    and for empty sets, which have no name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, written = Shingler(k), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingler.shingles(t) for t in part.column(1).to_pylist()]
                names = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
                fresh = []
                for name in names:
                    fresh.append(name is not None and name not in written)
                    if len(written) > MOST_NAMES:
                        written.clear()
                    written.add(name)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()),
                        _lists([s if f else None for s, f in zip(sets, fresh, strict=True)]),
                        pa.array([parity(s) if f else None for s, f in zip(sets, fresh, strict=True)], pa.binary()),
                    ],
                    names=["id", "n_shingles", "name", "items", "parity"],
                )

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(lean(run), f"id {kind}, n_shingles long, name long, items array<long>, parity binary")


def _items(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    return [x.values.to_numpy().view(np.uint64) for x in batch.column(column)]


def count_shingles(items: DataFrame) -> np.ndarray:
    """How often shingles occur in items(items), by hash, in 2^COUNTER_BITS counters; summed up in slices, in two steps."""
    width = (1 << COUNTER_BITS) // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy().view(np.uint64)
            np.add.at(total, counter(flat), 1)
        part = TaskContext.get().partitionId() % 64
        packed = [zlib.compress(total[i * width : (i + 1) * width].tobytes(), 1) for i in range(SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([part] * SLICES, pa.int32()), pa.array(packed, pa.binary())], names=["slice", "part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, dtype=np.int64)
        for packed in table.column("counts"):
            total += np.frombuffer(zlib.decompress(packed.as_py()), dtype=np.int64)
        return table.slice(0, 1).set_column(2, "counts", pa.array([zlib.compress(total.tobytes(), 1)], pa.binary()))

    kind = "slice int, part int, counts binary"
    counts = items.mapInArrow(lean(count), kind).groupBy("slice", "part").applyInArrow(add, kind).groupBy("slice").applyInArrow(add, kind)
    table = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    for r in counts.collect():  # SLICES rows
        table[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(zlib.decompress(bytes(r["counts"])), dtype=np.int64)
    return table


def _regions(sets: DataFrame, counts, percent: int) -> DataFrame:
    """sets(name, items) -> (key, name, n, place): a row for each region, and where its shingle stands in the set's order.

    Any fixed order of shingles is exact; rarest first keeps regions small.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = [], []
            for x in _items(batch, 1):
                keys.append(x[np.lexsort((x, counts.value[counter(x)]))[: prefixes(len(x), percent)[1]]])
                sizes.append(len(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), _lists(keys)], names=["name", "n", "keys"])

    first = sets.mapInArrow(lean(run), "name long, n int, keys array<long>")
    return first.select("name", "n", F.posexplode("keys").alias("place", "key")).select("key", "name", "n", "place")


def _dealt(regions: DataFrame, rows: int) -> DataFrame:
    """``regions``, of so many rows, by key: over more partitions than set where these would hold more than TASK_ROWS."""
    n = -(-rows // TASK_ROWS)
    return regions.repartition(n, "key") if n > partitions(regions.sparkSession) else regions.repartition("key")


class Sets:
    """The written sets, found by name: whole, or as sketches."""

    def __init__(self, rows: DataFrame, percent: int):
        self.percent = percent
        self.whole = rows.where("items is not null").select("name", "items")
        sketches = rows.where("items is not null").groupBy("name").agg(F.min(F.struct("n_shingles", "parity")).alias("s"))
        self.sketches = settle(sketches.select("name", "s.n_shingles", "s.parity"), "jaccard-sketches")

    def possible(self, pairs: DataFrame) -> DataFrame:
        """pairs(a, b) without those that sizes or sketches show to be too far apart."""
        percent = self.percent
        side = lambda c: self.sketches.select(F.col("name").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("parity").alias(f"p_{c}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = [batch.column(i).to_pylist() for i in range(2, 6)]
                near = [least_apart(x, y) <= most_apart(m, n, percent) for m, n, x, y in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(near, pa.bool_()))

        return both.select("a", "b", "n_a", "n_b", "p_a", "p_b").mapInArrow(lean(run), "a long, b long")

    def _joined(self, pairs: DataFrame) -> DataFrame:
        """pairs(a, b) with the sets of both; only sets that stand in a pair are moved."""
        needed = pairs.select(F.col("a").alias("name")).union(pairs.select(F.col("b").alias("name"))).distinct()
        found = settle(self.whole.join(needed, "name", "left_semi").dropDuplicates(["name"]), "jaccard-needed")
        # The set that may stand in many pairs is joined while rows are narrow; the wide join is by the other one.
        left = pairs.join(found.select(F.col("name").alias("b"), F.col("items").alias("items_b")), "b")
        return left.join(found.select(F.col("name").alias("a"), F.col("items").alias("items_a")), "a")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The linked ones of pairs(a, b), exact."""
        near = settle(self.possible(pairs), "jaccard-possible")
        both = self._joined(near).select("a", "b", F.size("items_a").alias("m"), F.size("items_b").alias("n"), F.size(F.array_intersect("items_a", "items_b")).alias("shared"))
        return both.where(100 * F.col("shared") >= self.percent * (F.col("m") + F.col("n") - F.col("shared"))).select("a", "b")

    def measure(self, pairs: DataFrame) -> DataFrame:
        """pairs(a, b) -> (a, b, link, size_a, size_b, apart), exact; ``apart`` holds what only one of the two has."""
        own, other = F.array_except("items_a", "items_b"), F.array_except("items_b", "items_a")
        sized = self._joined(pairs).select("a", "b", F.size("items_a").alias("size_a"), F.size("items_b").alias("size_b"), F.concat(own, other).alias("apart"))
        close = (100 + self.percent) * F.size("apart") <= (100 - self.percent) * (F.col("size_a") + F.col("size_b"))
        return sized.select("a", "b", close.alias("link"), "size_a", "size_b", "apart")


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of documents under links of Jaccard similarity of at least ``percent`` per cent.

    A row per input row: id, n_shingles, component_id (the smallest id reachable by links, itself included).
    Equal sets are one vertex, however many rows have them; shingles and sets are known by 64-bit hashes.

    Edge cases: NULL and empty texts and texts of white space have an empty set, link with nothing and are
    their own component; fewer than k words are one shingle; repeated rows are copies; rows with a NULL id take
    part and get the smallest id of their class, NULL if it has none; an empty table gives no rows. Other
    columns are not looked at.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    with arrow_batches(docs.sparkSession, BATCH):
        rows = settle(_sets(texts, k), "jaccard-rows")
        edges = _edges(rows, percent)
    classes = components(edges, "jaccard-cc")
    ids = rows.select("id", "n_shingles", "name").join(classes.select(F.col("id").alias("name"), "root"), "name", "left")
    ids = settle(ids.select("id", "n_shingles", F.coalesce("root", "name").alias("class")), "jaccard-classes")
    drop_settled(rows)
    least = ids.where("class is not null").groupBy("class").agg(F.min("id").alias("least"))
    return ids.join(least, "class", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")
    )


def _edges(rows: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between names that hold all classes of the graph of linked sets together."""
    sets = Sets(rows, percent)
    counts = rows.sparkSession.sparkContext.broadcast(count_shingles(sets.whole.select("items")))
    # Dealt by key once: copies of a set fall together, regions are counted, and members learn of their region.
    width = F.col("n_shingles") - F.ceil(percent * (F.col("n_shingles") + F.ceil(percent * F.col("n_shingles") / 100)) / (100 + percent)) + 1
    total = rows.where("items is not null").agg(F.sum(width)).first()[0]
    dealt = _dealt(_regions(sets.whole, counts, percent), total or 0).distinct()
    regions = dealt.groupBy("key").agg(F.min("name").alias("pivot"), F.max("name").alias("last"), F.count(F.lit(1)).alias("m")).where("pivot <> last")
    members = settle(dealt.join(regions.drop("last"), "key"), "jaccard-members")
    # A set's own pivot: the one it shares most regions with.
    met = members.where("name <> pivot").groupBy("name", "pivot").agg(F.count(F.lit(1)).alias("times"))
    own = met.groupBy(F.col("name").alias("a")).agg(F.max(F.struct("times", "pivot")).alias("best")).select("a", F.col("best.pivot").alias("b"))
    edges = settle(sets.links(own), "jaccard-edges")
    # Regions whose sets are not all of one class yet.
    roots = components(edges, "jaccard-turn")
    named = settle(_named(members, roots, "name", "class"), "jaccard-named")
    drop_settled(members)
    mixed = named.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("key")
    left = settle(named.join(mixed, "key"), "jaccard-open")
    drop_settled(named)
    # Small regions: sizes are within the window, and what follows the first shared shingle in either order is enough for a link.
    x, y = left.where((F.col("m") <= SMALL) & (F.col("place") < _early(F.col("n"), percent))).alias("x"), left.where(F.col("m") <= SMALL).alias("y")
    shared = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    meet = (
        (F.col("x.key") == F.col("y.key")) & (F.col("x.class") != F.col("y.class"))
        & (F.struct("x.n", "x.name") < F.struct("y.n", "y.name")) & (100 * F.col("x.n") >= percent * F.col("y.n"))
        & (F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) >= shared)
    )
    near = x.join(y, meet).select(F.col("x.name").alias("a"), F.col("y.name").alias("b")).distinct()
    edges = settle(edges.union(sets.links(near)), "jaccard-edges")
    around = settle(left.where((F.col("m") > SMALL) & (F.col("name") != F.col("pivot"))).select(F.col("name").alias("a"), F.col("pivot").alias("b")).distinct(), "jaccard-around")
    drop_settled(left)
    return edges if around.isEmpty() else _inner(around, sets, edges, percent)


def _named(table: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    """Add the class of the set in ``column``."""
    return table.join(roots.select(F.col("id").alias(column), "root"), column, "left").withColumn(name, F.coalesce("root", column)).drop("root")


def _early(size: Column, percent: int) -> Column:
    """As prefixes, for the smaller set."""
    return size - F.ceil(2 * percent * size / (100 + percent)) + 1


def _most(size: Column, percent: int) -> Column:
    """Most differences between a set of this size and a linked one, which has size * 100 / percent at most."""
    return F.floor((size + F.floor(size * 100 / percent)) * (100 - percent) / (100 + percent)).cast("int")


def _rare_first(measured: DataFrame, percent: int) -> DataFrame:
    """Replace ``apart`` by its size ``far`` and by ``edge``, its rarest elements: one more than a's linked sets may lack."""
    counts = measured.sparkSession.sparkContext.broadcast(count_shingles(measured.select(F.col("apart").alias("items"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _items(batch, 5)
            edges = [x[np.lexsort((x, counts.value[counter(x)]))[: most + 1]] for x, most in zip(found, batch.column(6).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array([len(x) for x in found], pa.int32()), _lists(edges)], names=["a", "b", "link", "size_a", "size_b", "far", "edge"])

    source = measured.select("a", "b", "link", "size_a", "size_b", "apart", _most(F.col("size_a"), percent).alias("most"))
    return source.mapInArrow(lean(run), "a long, b long, link boolean, size_a int, size_b int, far int, edge array<long>")


def _spread(rows: DataFrame) -> DataFrame:
    """A row for each element of ``edge``, if there still is such a column."""
    if "edge" not in rows.columns:
        return rows
    return rows.select(*[c for c in rows.columns if c != "edge"], F.posexplode("edge").alias("place", "element"))


def _inner(around: DataFrame, sets: Sets, edges: DataFrame, percent: int) -> DataFrame:
    """``edges`` and those between sets a of around(a, b) that share a pivot b."""
    measured = settle(sets.measure(around), "jaccard-measured", "zstd")
    edges = settle(edges.union(measured.where("link").select("a", "b")), "jaccard-edges")
    roots = components(edges, "jaccard-turn")
    # Two linked sets with x and y differences from the pivot, of which one is not linked to it, share at least
    # (x + y - d) / 2 of them, d the most differences they may have: so they share one among their first few.
    # The one with fewer differences needs a shorter beginning than the other.
    most = _most(F.col("size_a"), percent)
    out = F.floor((F.floor(F.col("size_a") * percent / 100) + F.col("size_b")) * (100 - percent) / (100 + percent)).cast("int") + 1
    beyond = F.when(F.col("link"), F.greatest("far", out)).otherwise(F.col("far"))
    share = F.greatest(F.lit(1), F.ceil((F.col("far") + beyond - most) / 2).cast("int"))
    inner = _rare_first(measured, percent).where("far > 0")
    inner = settle(inner.select("a", "b", "link", "size_a", "far", (F.col("far") - share + 1).alias("short"), "edge"), "jaccard-inner")
    drop_settled(measured)
    # Inner regions: sets that share such a difference. In each turn the first set of every class of a region is measured
    # against the first of them, until no turn finds a link.
    for _ in range(TURNS):
        # Classes are looked up once a set and pivot, before its differences become rows.
        named = settle(_spread(_named(inner, roots, "a", "class")), "jaccard-named")
        drop_settled(inner)
        mixed = named.groupBy("b", "element").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("b", "element")
        members = settle(named.join(mixed, ["b", "element"]), "jaccard-open")
        drop_settled(named)
        inner = members.drop("class")
        firsts = members.groupBy("b", "element", "class").agg(F.min("a").alias("a"))
        pivots = firsts.groupBy("b", "element").agg(F.min("a").alias("pivot"))
        stars = firsts.join(pivots, ["b", "element"]).where("a <> pivot").select("a", F.col("pivot").alias("b")).distinct()
        found = settle(sets.links(stars), "jaccard-found")
        if found.isEmpty():
            break
        edges = settle(edges.union(found), "jaccard-edges")
        roots = components(edges, "jaccard-turn")
    # What is left: sets of different classes in one inner region, within the windows of size and distance, if what
    # follows the first difference that they share in either order is enough for a link.
    members = _named(inner, roots, "a", "class")
    x, y = members.where("place < short").alias("x"), members.alias("y")
    larger, smaller = F.greatest("x.size_a", "y.size_a"), F.least("x.size_a", "y.size_a")
    lacking = F.floor((F.col("x.size_a") + F.col("y.size_a")) * (100 - percent) / (100 + percent))
    shared = (F.col("x.far") + F.col("y.far") - lacking) / 2
    meet = (
        (F.col("x.b") == F.col("y.b")) & (F.col("x.element") == F.col("y.element")) & (F.col("x.class") != F.col("y.class")) & ~(F.col("x.link") & F.col("y.link"))
        & (F.struct("x.far", "x.a") < F.struct("y.far", "y.a")) & (100 * smaller >= percent * larger)
        & (F.col("y.far") - F.col("x.far") <= lacking) & (F.least(F.col("x.far") - F.col("x.place"), F.col("y.far") - F.col("y.place")) >= shared)
    )
    near = x.join(y, meet).select(F.col("x.a").alias("a"), F.col("y.a").alias("b")).distinct()
    return settle(edges.union(sets.links(near)), "jaccard-edges")
