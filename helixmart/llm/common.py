"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixmart.session import scratch_path

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once in an application, so that functions sent to tasks find their modules."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="helixmart-")) / "helixmart_package.zip"
        with zipfile.ZipFile(target, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        context.addPyFile(str(target))
        _SHIPPED.add(context.applicationId)


_SETTLED: list[str] = []


def forget() -> None:
    """Leave the tables written so far alone: ``sweep`` deletes later ones only."""
    _SETTLED.clear()


def sweep(spark: SparkSession) -> None:
    """Delete the tables that ``settle`` wrote since ``forget``. Results that still read them must have been written."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    while _SETTLED:
        path = path_of(_SETTLED.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", compression).parquet(path)
    _SETTLED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_settled(df: DataFrame) -> None:
    """Delete the table that ``settle`` returned as ``df``. What was made of it must have been written."""
    spark, mine = df.sparkSession, {p.rstrip("/").rsplit("/", 2)[-2] for p in df.inputFiles()}
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    for path in [p for p in _SETTLED if p.rsplit("/", 1)[-1] in mine]:
        _SETTLED.remove(path)
        path_of(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path_of(path), True)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most so many rows in a batch sent to Python, for jobs that run inside: bounds what wide rows take there and on the way."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_TABLES: list = []


def table_of_worker(make: Callable) -> Callable:
    """``make``, called once in a worker: its table stays from task to task, until a task of another operator begins."""
    kept = functools.lru_cache(maxsize=4)(make)
    _TABLES.append(kept)
    return kept


def hand_back(keep: tuple[str, ...] = ()) -> None:
    """Forget the tables that other modules made, and return to the system what this process no longer uses."""
    for table in _TABLES:
        if table.__module__ not in keep:
            table.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *keep: str) -> Callable:
    """``run`` for ``mapInArrow``; keeps the tables of the modules in ``keep``.

    Workers outlive their tasks, and one goes on holding the most memory that any operator took in it, beside a JVM
    that grows in another. So a task gives back what is left over when it begins, and what it took when it ends.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back(keep)
        try:
            yield from run(batches)
        finally:
            hand_back(keep)

    return tidy


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket(column: str, modulus: int):
    """crc32 of the id as text, modulo: the folds that the contracts name. A NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def number_rows(df: DataFrame, group: str, order: list[str], rows_per_bucket: int = 200_000) -> DataFrame:
    """Add ``_rank``: 0, 1, 2 ... within each value of ``group``, in no task more than a bucket of rows.

    Rows are dealt to buckets by hash; bucket counts become offsets. ``order`` must be unique.
    """
    total = df.count()
    n = max(1, -(-total // rows_per_bucket))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n)))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(group, "_bucket")
        .count()
        .select(group, "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    placed = dealt.withColumn("_in", F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order)))
    return placed.join(offsets, [group, "_bucket"]).select(*df.columns, (F.col("_before") + F.col("_in") - 1).alias("_rank"))


def components(edges: DataFrame, label: str = "cc", most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (id, root), root the smallest id that links reach.

    Every vertex hooks its root onto the smallest root among its neighbours, then the roots jump to
    their roots, so long chains shrink by more than half in a round. Each round is a written table.
    Edges whose ends have met are dropped.
    """
    edges = settle(edges.select("a", "b").where("a <> b").distinct(), f"{label}-edges")
    ids = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    roots = settle(ids.select("id", F.col("id").alias("root")), f"{label}-roots")
    for _ in range(most_rounds):
        if edges.isEmpty():
            return roots
        hooks = (
            edges.select(F.greatest("a", "b").alias("root"), F.least("a", "b").alias("to"))
            .groupBy("root")
            .agg(F.min("to").alias("to"))
        )
        hooks = settle(hooks, f"{label}-hooks")
        while True:  # pointer jumping among the roots: every hook goes to a smaller id, so there is no cycle
            up = hooks.select(F.col("root").alias("to"), F.col("to").alias("up"))
            jumped = settle(hooks.join(up, "to", "left").select("root", F.coalesce("up", "to").alias("to"), F.col("up").isNotNull().alias("moved")), f"{label}-jump")
            hooks = jumped.select("root", "to")
            if jumped.where("moved").isEmpty():
                break
        roots = settle(roots.join(hooks, "root", "left").select("id", F.coalesce("to", "root").alias("root")), f"{label}-roots")
        of = hooks.select(F.col("root").alias("_r"), F.col("to").alias("_t"))
        edges = edges.join(of, F.col("a") == F.col("_r"), "left").select(F.coalesce("_t", "a").alias("a"), "b")
        edges = edges.join(of, F.col("b") == F.col("_r"), "left").select("a", F.coalesce("_t", "b").alias("b"))
        edges = settle(edges.where("a <> b").distinct(), f"{label}-edges")
    raise RuntimeError("components did not settle")
