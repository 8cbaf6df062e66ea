"""Tables in hash buckets of their key.

An upsert rewrites the buckets that hold changed keys and no others. A batch of inserts looks its keys up in a
narrow index, in its own buckets only, and carries its name, so that running it again leaves everything as it was.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from helixmart.operators.joins import keep_one

BUCKET, BATCH = "_bucket", "_batch"
# What stands beside a table: rows on their way in, buckets about to be swapped in, the index of keys.
INCOMING, CHANGED, KEYS = "__incoming", "__changed", "__keys"
LAYOUT = "_layout"
# Name of the batch that holds what a table held before it got an index.
START = "start"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def read_layout(spark: SparkSession, path: str) -> dict | None:
    """{"buckets": n, "keys": [...]} of a bucketed table or an index, None for any other folder."""
    fs, to_path = _fs(spark, path)
    file = to_path(f"{path}/{LAYOUT}")
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_layout(spark: SparkSession, path: str, keys: list[str], buckets: int) -> None:
    fs, to_path = _fs(spark, path)
    stream = fs.create(to_path(f"{path}/{LAYOUT}"), True)
    try:
        stream.write(bytearray(json.dumps({"buckets": buckets, "keys": keys}).encode()))
    finally:
        stream.close()


def has_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Bucket of a row. Rows with a NULL in the key never meet another, so they are dealt out evenly."""
    spread = F.when(has_null(keys), F.monotonically_increasing_id()).otherwise(F.xxhash64(*keys))
    return F.pmod(spread, F.lit(buckets)).cast("int")


def _touched(rows: DataFrame) -> list[int]:
    return sorted(r[BUCKET] for r in rows.select(BUCKET).distinct().collect())  # as many as there are buckets at most


def merged(incoming: DataFrame, target: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """``target`` after an upsert of ``incoming`` (one row per key), both with BUCKET: one pass over the tagged union.

    Of a key's rows the incoming one wins as a whole; columns that incoming rows lack keep their stored value.
    """
    names = [c for c in target.columns if c != BUCKET]
    given = [c for c in names if c not in keys and c in incoming.columns]
    absent = [c for c in names if c not in keys and c not in incoming.columns]
    shape = lambda df, tag: df.select(
        BUCKET, *[F.col(k).cast(target.schema[k].dataType).alias(k) for k in keys], F.lit(tag).alias("_tag"),
        *[F.col(c).cast(target.schema[c].dataType).alias(c) for c in given],
        *[(F.col(c) if tag == 0 else F.lit(None).cast(target.schema[c].dataType)).alias(c) for c in absent],
    )
    both = shape(target, 0).unionByName(shape(incoming, 1))
    both = both.withColumn("_own", F.when(has_null(keys), F.monotonically_increasing_id()))
    # Dealt by bucket once: the grouping needs no other shuffle, and each bucket is written by one task.
    grouped = both.repartition(BUCKET).groupBy(BUCKET, *keys, "_own").agg(
        F.max(F.struct("_tag", *given)).alias("_row"), *[F.first(c, ignorenulls=True).alias(c) for c in absent]
    )
    picked = {**{c: F.col("_row").getField(c) for c in given}, **{c: F.col(c) for c in [*keys, *absent]}}
    return grouped.select(*[picked[c].alias(c) for c in names], BUCKET)


def _with_bucket(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BUCKET, IntegerType())])


def publish_buckets(spark: SparkSession, path: str) -> None:
    """Put complete new buckets in the place of old ones, one folder after another.

    Spark's dynamic overwrite deletes a partition before it renames the new one and cannot go on after a lost
    driver; here the new bucket stays below CHANGED until it is in place, so :func:`finish` can repeat the step.
    """
    fs, to_path = _fs(spark, path)
    for status in fs.listStatus(to_path(path + CHANGED)):
        name = status.getPath().getName()
        if name.startswith(f"{BUCKET}="):
            fs.delete(to_path(f"{path}/{name}"), True)
            fs.rename(status.getPath(), to_path(f"{path}/{name}"))
    fs.delete(to_path(path + CHANGED), True)


def finish(spark: SparkSession, path: str) -> None:
    """Finish an interrupted swap of buckets; forget one that had not written all of them."""
    fs, to_path = _fs(spark, path)
    if not fs.exists(to_path(path + CHANGED)):
        return
    if fs.exists(to_path(f"{path}{CHANGED}/_SUCCESS")):
        publish_buckets(spark, path)
    else:
        fs.delete(to_path(path + CHANGED), True)


def upsert_buckets(
    incoming: DataFrame, path: str, keys: list[str], order_by: list[str] | None, schema: StructType, layout: dict, rows_per_file: int | None = None
) -> None:
    """Upsert into a bucketed table: incoming rows are read once, and of the table only the buckets they fall into."""
    spark = incoming.sparkSession
    if sorted(layout["keys"]) != sorted(keys):
        raise ValueError(f"the table is kept by {layout['keys']}, not by {keys}")
    keys = layout["keys"]
    typed = incoming.withColumns({k: F.col(k).cast(schema[k].dataType) for k in keys})
    last = keep_one(typed, keys, order_by, last=True).withColumn(BUCKET, bucket_of(keys, layout["buckets"]))
    last.write.mode("overwrite").parquet(path + INCOMING)
    last = spark.read.schema(last.schema).parquet(path + INCOMING)
    buckets = _touched(last)
    if buckets:
        target = spark.read.schema(_with_bucket(schema)).parquet(path).where(F.col(BUCKET).isin(buckets))
        writer = merged(last, target, keys).write.mode("overwrite").partitionBy(BUCKET)
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        writer.parquet(path + CHANGED)
        publish_buckets(spark, path)
    fs, to_path = _fs(spark, path)
    fs.delete(to_path(path + INCOMING), True)


def build(incoming: DataFrame, target: DataFrame, path: str, keys: list[str], order_by: list[str] | None, buckets: int) -> None:
    """Write ``target`` with ``incoming`` upserted as a bucketed table at ``path``."""
    typed = incoming.withColumns({k: F.col(k).cast(target.schema[k].dataType) for k in keys})
    last = keep_one(typed, keys, order_by, last=True).withColumn(BUCKET, bucket_of(keys, buckets))
    stored = target.withColumn(BUCKET, bucket_of(keys, buckets))
    merged(last, stored, keys).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    write_layout(incoming.sparkSession, path, keys, buckets)


# ---------------------------------------------------------------- batches of inserts


def _index_schema(rows: StructType, keys: list[str]) -> StructType:
    return StructType([*[rows[k] for k in keys], StructField(BUCKET, IntegerType()), StructField(BATCH, StringType())])


def _write_index(rows: DataFrame, path: str, keys: list[str], buckets: int, batch: str) -> None:
    named = rows.where(~has_null(keys)).select(*keys, bucket_of(keys, buckets).alias(BUCKET), F.lit(batch).alias(BATCH))
    named.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, BATCH).parquet(path + KEYS)


def index_of(spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: list[int], without: str) -> DataFrame:
    """Keys of the table in the given buckets, without those of one batch. The plan lists no other bucket's files."""
    index = spark.read.schema(_index_schema(schema, keys)).parquet(path + KEYS)
    return index.where(F.col(BUCKET).isin(buckets) & (F.col(BATCH) != without)).select(BUCKET, *keys)


def adopt(spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int) -> dict:
    """Give the table at ``path`` an index, building it from the rows that are there already; the layout in use."""
    if (layout := read_layout(spark, path + KEYS)) is not None:
        return layout
    fs, to_path = _fs(spark, path)
    start = f"{path}/{BATCH}={START}"
    if fs.exists(to_path(path)):
        files = [s.getPath() for s in fs.listStatus(to_path(path)) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
        fs.mkdirs(to_path(start))
        for file in files:
            fs.rename(file, to_path(f"{start}/{file.getName()}"))
        if fs.listStatus(to_path(start)):
            _write_index(spark.read.schema(schema).parquet(start).select(*keys), path, keys, buckets, START)
    fs.mkdirs(to_path(path + KEYS))
    write_layout(spark, path + KEYS, keys, buckets)  # last: until it is there, this can be repeated
    return {"buckets": buckets, "keys": keys}


def insert_batch(
    incoming: DataFrame, path: str, keys: list[str], batch: str, order_by: list[str] | None = None, buckets: int = 64, transient: list[str] | None = None
) -> int:
    """Append rows with new keys as one named batch; returns how many.

    The first row of a key stays, as with ``insert_ignore``. Of the table only the index is read, and only in the
    batch's own buckets. A batch that runs again replaces its own rows and keys by the same ones. ``transient``
    names columns of ``order_by`` that are not stored.
    """
    if not re.fullmatch(r"[\w.-]+", batch) or batch == START:
        raise ValueError(f"{batch!r} cannot name a batch")
    spark = incoming.sparkSession
    stored = StructType([f for f in incoming.schema if f.name not in (transient or [])])
    layout = adopt(spark, path, stored, keys, buckets)
    keys = layout["keys"]
    rows = keep_one(incoming, keys, order_by).withColumn(BUCKET, bucket_of(keys, layout["buckets"]))
    # A batch is small beside the table: keep it while its buckets are looked up.
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known = index_of(spark, path, stored, keys, _touched(rows), batch)
        fresh = rows.join(known, [BUCKET, *keys], "left_anti").select(*stored.names)
        seen, folder = Observation(), f"{path}/{BATCH}={batch}"
        fresh.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(folder)
        written = spark.read.schema(stored).parquet(folder)
        _write_index(written.select(*keys), path, keys, layout["buckets"], batch)
        return seen.get["rows"]
    finally:
        rows.unpersist()


def compact_index(spark: SparkSession, path: str, schema: StructType) -> None:
    """Bring each bucket's keys of all finished batches together in one file. No batch may be running."""
    from helixmart.sinks.merge import STAGED, publish, recover

    recover(spark, path + KEYS)
    layout = read_layout(spark, path + KEYS)
    if layout is None:
        return
    index = spark.read.schema(_index_schema(schema, layout["keys"])).parquet(path + KEYS).withColumn(BATCH, F.lit(START))
    index.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET, BATCH).parquet(path + KEYS + STAGED)
    write_layout(spark, path + KEYS + STAGED, layout["keys"], layout["buckets"])
    publish(spark, path + KEYS)
