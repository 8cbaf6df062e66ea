"""Keyed writes into Parquet tables.

``insert_ignore`` only appends, so running it again after a lost job inserts nothing twice.
``upsert`` writes new versions beside the table and then swaps folders: the buckets that change of a table in
hash buckets, else the whole table. An interrupted swap is finished or undone by :func:`recover`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helixmart.operators.joins import keep_one
from helixmart.sinks.buckets import BATCH, BUCKET, build, finish, read_layout, upsert_buckets

STAGED, PREVIOUS = "__staged", "__previous"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, to_path = _fs(spark, path)
    return fs.exists(to_path(path))


def recover(spark: SparkSession, path: str) -> None:
    """Finish a swap that stopped half-way: the table folder is missing, both others exist; or buckets wait."""
    fs, to_path = _fs(spark, path)
    finish(spark, path)
    if fs.exists(to_path(path)) or not fs.exists(to_path(path + PREVIOUS)):
        return
    complete = fs.exists(to_path(f"{path}{STAGED}/_SUCCESS"))
    fs.rename(to_path(path + (STAGED if complete else PREVIOUS)), to_path(path))


def publish(spark: SparkSession, path: str) -> None:
    fs, to_path = _fs(spark, path)
    fs.delete(to_path(path + PREVIOUS), True)
    if fs.exists(to_path(path)):
        fs.rename(to_path(path), to_path(path + PREVIOUS))
    fs.rename(to_path(path + STAGED), to_path(path))
    fs.delete(to_path(path + PREVIOUS), True)


def read_target(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, or no rows while nothing has been written."""
    recover(spark, path)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    # Buckets and batches are folders of the table, not columns.
    layout = [c for c in (BUCKET, BATCH) if c not in schema.names]
    return spark.read.schema(schema).parquet(path).drop(*layout)


def new_rows(
    incoming: DataFrame, target: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """Incoming rows an insert-ignore would add: first per key, key not in the target.

    Of the target only the key columns are read. Columns of ``order_by`` that the target lacks serve the order only.
    """
    stored = [c for c in incoming.columns if c in target.columns or c not in (order_by or [])]
    return keep_one(incoming, keys, order_by).join(target.select(*keys), keys, "left_anti").select(*stored)


def merged_rows(
    incoming: DataFrame, target: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """The table after an upsert: the last incoming row per key replaces the target's row.

    Target columns the incoming rows lack keep their stored value.
    """
    last = keep_one(incoming, keys, order_by, last=True)
    absent = [c for c in target.columns if c not in incoming.columns]
    if absent:
        last = last.join(target.select(*keys, *absent), keys, "left")
    kept = target.join(last.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(last.select(*target.columns))


def _counted_write(df: DataFrame, path: str, mode: str, rows_per_file: int | None) -> int:
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return seen.get["rows"]


def within_key_range(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Target rows whose ``key`` lies between the incoming rows' smallest and largest one.

    The bounds become literals of a pushed-down filter, so Parquet statistics skip the files
    and row groups a small, recent batch cannot collide with.
    """
    bounds = incoming.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    return target.filter(F.col(key).between(F.lit(bounds["lo"]), F.lit(bounds["hi"])))


def insert_ignore(
    incoming: DataFrame,
    path: str,
    keys: list[str],
    order_by: list[str] | None = None,
    rows_per_file: int | None = None,
    prune_target: bool = False,
    transient: list[str] | None = None,
) -> int:
    """Append rows with new keys; returns how many were inserted.

    ``transient`` names columns of ``order_by`` that are not stored.

    ``prune_target`` reads the incoming rows once more to narrow the target scan: worth it for
    small batches of ascending keys, not for bulk loads.
    """
    spark = incoming.sparkSession
    stored = StructType([f for f in incoming.schema if f.name not in (transient or [])])
    target = read_target(spark, path, stored)
    if prune_target:
        target = within_key_range(target, incoming, keys[0])
    return _counted_write(new_rows(incoming, target, keys, order_by), path, "append", rows_per_file)


def upsert(
    incoming: DataFrame,
    path: str,
    keys: list[str],
    order_by: list[str] | None = None,
    schema: StructType | None = None,
    rows_per_file: int | None = None,
    buckets: int | None = None,
) -> int:
    """Insert or replace rows by key; returns the table's row count afterwards.

    With ``buckets`` the table is kept in so many hash buckets of the key from then on, and later calls, with or
    without it, rewrite only the buckets that hold incoming keys.
    """
    spark = incoming.sparkSession
    recover(spark, path)
    layout, schema = read_layout(spark, path), schema or incoming.schema
    if layout is not None:
        upsert_buckets(incoming, path, keys, order_by, schema, layout, rows_per_file)
        return read_target(spark, path, schema).count()
    target = read_target(spark, path, schema)
    if buckets:
        build(incoming, target, path + STAGED, keys, order_by, buckets)
        publish(spark, path)
        return read_target(spark, path, schema).count()
    rows = _counted_write(merged_rows(incoming, target, keys, order_by), path + STAGED, "overwrite", rows_per_file)
    publish(spark, path)
    return rows
